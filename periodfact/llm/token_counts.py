"""Operator 4: token counts by batch encoding in an Arrow function, lengths only.

White space is dropped by this vocabulary and no word crosses it, and neither
the normaliser (NFC, lower case) nor a special string reaches over it: every
run of ASCII white space is a safe boundary.  Texts, long ones too, are split
there; the words of pieces that the worker hasn't met are encoded in batches
balanced by bytes, and only their lengths are kept.  A text's count is the sum.

Defined results: a null text counts as empty (0 bytes, 0 tokens).  Null or
repeated ``doc_id``: one row out for each row in.  A text without white space
is one piece.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import slices, text_of

LIMIT = 2048
#: Bytes of text handed to the library at once.
BATCH_BYTES = 256 << 10
MEMO_ENTRIES = 500_000

#: str.split() also cuts at these, which the vocabulary's white space lacks (1C-1F) or may hold in other places.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_RUN = re.compile(r"[^ \t-\r]+")
#: Fixed values of the vocabulary: its words in lowered text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_COUNTERS: dict = {}


def split_safe(text: str) -> list[str]:
    return _RUN.findall(text) if _ODD_SPACE.search(text) else text.split()


def by_bytes(pieces: list[str], limit: int) -> list[list[str]]:
    """Batches of about ``limit`` bytes, pieces of like length together."""
    out: list[list[str]] = []
    room = 0
    for piece in sorted(pieces, key=len):
        size = len(piece.encode())
        if not out or size > room:
            out.append([])
            room = limit
        out[-1].append(piece)
        room -= size
    return out


class TokenCounter:
    """Counts of whole texts by a memo of pieces and, below it, of words.

    A piece of ASCII and Latin-1 letters is first lowered and cut into the
    vocabulary's words (for these characters normalising is lowering, letter
    by letter); other pieces, and those that may hold a special string, go to
    the library as they are.
    """

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = regex.compile(WORDS).findall
        self.batch_bytes, self.pieces, self.words = batch_bytes, {}, {}

    def parts(self, piece: str) -> list[str]:
        if "<|" in piece or not (piece.isascii() or max(piece) <= "\xff"):
            return [piece]
        return self.cut(piece.lower())

    def __call__(self, texts: list[str]) -> list[int]:
        split = [split_safe(t) for t in texts]
        if len(self.pieces) > MEMO_ENTRIES:
            self.pieces = {}
        if len(self.words) > MEMO_ENTRIES:
            self.words = {}
        new = {p: self.parts(p) for p in set(chain.from_iterable(split)).difference(self.pieces)}
        unseen = list(set(chain.from_iterable(new.values())).difference(self.words))
        for batch in by_bytes(unseen, self.batch_bytes):
            found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            self.words.update(zip(batch, map(len, found)))
        length = self.words.__getitem__
        self.pieces.update((p, sum(map(length, words))) for p, words in new.items())
        out = [sum(map(self.pieces.__getitem__, pieces)) for pieces in split]
        for memo, keys in ((self.words, unseen), (self.pieces, new)):
            for key in [k for k in keys if len(k) > 256]:  # hardly repeat
                del memo[key]
        return out


def counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    def run(batches):
        count = counter(tokenizer_path)
        for batch in slices(batches):
            found = pa.array(count(batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), found],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       F.octet_length(text_of()).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
