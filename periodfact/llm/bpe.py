"""Operator 5: BPE encoding and decoding with a minimal acyclic transducer lexicon.

The most frequent words of the corpus (counted by Spark over all rows, the top
``LEXICON_WORDS`` of them kept) are merged once and compiled into a minimal
acyclic automaton that shares suffixes as well as prefixes.  Each arc carries
the number of words before it, so the arcs' outputs add up to a word's number,
which leads to its ids: a transducer from words to id lists.  It is one block
of bytes (bounded by the number of words), broadcast, written by each Python
worker to an unnamed file and memory-mapped.  A word that it lacks is merged
exactly by the vocabulary's ranks.  A bounded memo of recent words stands
in front of both.  How a text falls into words depends on tables of characters:
a text that holds one of the few that this pattern module classes otherwise than
the library (``OTHER_CLASS``) is cut by the vocabulary's own merge code instead.

Defined results: a null text is empty (no ids; the digests are those of the
empty string).  Null or repeated ``doc_id``: one row out for each row in.  The
special string inside a text is its one id and decodes to itself.  An empty
table gives an empty lexicon and an empty result.
"""

from __future__ import annotations

import hashlib
import mmap
import re
import struct
import tempfile
from array import array
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, slices, text_of
from periodfact.llm.vocab import SPECIAL, SPECIAL_ID, id_encoder, merge_core

#: Words in the lexicon (a bound on what is collected and broadcast, about 3 MB).
LEXICON_WORDS = 65_536
#: Longer words stay out of the lexicon and the memo.
LEXICON_BYTES = 48
MEMO_ENTRIES = 350_000

#: Fixed value of the vocabulary: how a text falls into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Characters (hexadecimal) newer than the library's tables, so that the module here classes them otherwise.
OTHER_CLASS = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
    10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
    187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
    1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
    2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""


def other_class():
    """Finds a character of ``OTHER_CLASS``."""
    spans = [part.partition("-") for part in OTHER_CLASS.split()]
    return re.compile("[" + "".join(f"{chr(int(a, 16))}-{chr(int(b or a, 16))}" for a, _, b in spans) + "]")


def words_pattern():
    import regex
    return regex.compile(WORDS)


def merger(ranks_path: str) -> Callable[[bytes], list[int]]:
    """Exact ids of one word: the adjacent pair of the lowest rank is joined first, again and again."""
    return merge_core(ranks_path)._core_bpe.encode_single_piece


# -- the transducer ---------------------------------------------------------

def compile_lexicon(words: Iterable[bytes], ids_of: Callable[[bytes], list[int]]) -> bytes:
    """Minimal acyclic automaton of the words, with their ids, as one block of bytes.

    Words are added in sorted order; the states of the last word's path that the
    next one leaves are final in shape and replaced by an equal state, if any.
    """
    ordered = sorted(set(words))
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    sizes: list[int] = []
    path: list[list] = [[False, []]]  # of the last word: final?, arcs [label, state or None]

    def settle(node: list) -> int:
        key = (node[0], tuple(map(tuple, node[1])))
        if key not in known:
            known[key] = len(states)
            states.append(key)
            sizes.append(node[0] + sum(sizes[t] for _, t in node[1]))
        return known[key]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = settle(path.pop())
            path[-1][1][-1][1] = state

    last = b""
    for word in ordered:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for byte in word[common:]:
            path[-1][1].append([byte, None])
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = settle(path[0])
    label, target, skip, final = [], [], [], []
    for state, (is_final, arcs) in enumerate(states):
        final.append(is_final)
        passed = int(is_final)
        for byte, to in arcs:  # sorted by byte, so arcs are sorted by (state, byte)
            label.append(state << 8 | byte)
            target.append(to)
            skip.append(passed)
            passed += sizes[to]
    lists = [ids_of(word) for word in ordered]
    at = np.cumsum([0, *map(len, lists)])
    blocks = [np.asarray(x, "<u4").tobytes() for x in (label, target, skip, final, at, [i for ids in lists for i in ids])]
    return struct.pack("<7I", root, *map(len, blocks)) + b"".join(blocks)


class Lexicon:
    """The compiled words, memory-mapped; looks up many words at once."""

    def __init__(self, block: bytes) -> None:
        file = tempfile.TemporaryFile()  # unnamed: gone with the worker
        file.write(block)
        file.flush()
        self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        file.close()
        self.root, *sizes = struct.unpack_from("<7I", self.map)
        starts = 28 + np.cumsum([0, *sizes])
        self.label, self.target, self.skip, self.final, self.at, self.ids = (
            np.frombuffer(self.map, "<u4", size // 4, int(at)) for at, size in zip(starts, sizes))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in sorted order, or -1: all words walk the automaton side by side."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.label):
            return out
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(words), np.uint8)
        live = np.flatnonzero((size > 0) & (size <= LEXICON_BYTES))
        state, number = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        step = 0
        while len(live):
            key = state[live] << 8 | raw[start[live] + step]
            arc = np.minimum(np.searchsorted(self.label, key), len(self.label) - 1)
            there = self.label[arc] == key
            live, arc, step = live[there], arc[there], step + 1
            number[live] += self.skip[arc]
            state[live] = self.target[arc]
            ended = size[live] == step
            done = live[ended]
            done = done[self.final[state[done]] == 1]
            out[done] = number[done]
            live = live[~ended]
        return out

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.at[number]:self.at[number + 1]].tobytes()

    def states(self) -> int:
        return len(self.final)


def frequent_words(docs: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of all texts that occur twice or more: at most ``words`` rows reach the driver.

    A histogram of the counts (sixteen steps for each doubling) tells from which
    step on no more than ``words`` words are left; only those are collected.
    """
    counted = checkpointed(docs.select(F.explode(F.split(text_of(), "[ \\t-\\r]+")).alias("word"))
                           .where(F.octet_length("word").between(1, LEXICON_BYTES))
                           .groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
                           .withColumn("step", F.floor(F.log2("n") * 16)))
    left, least = words, None
    for row in sorted(counted.groupBy("step").agg(F.count("*").alias("n")).collect(), reverse=True):  # at most 1,024 rows
        left -= row["n"]
        if left < 0:
            break
        least = row["step"]
    if least is None:
        return []
    cut, found = words_pattern().findall, {}
    for word in counted.where(F.col("step") >= least).select("word").toArrow().column(0).to_pylist():
        for part in cut(" " + word):
            found[part.encode()] = None
    return sorted(found)


# -- encoding ---------------------------------------------------------------

class Codec:
    """Encodes and decodes whole texts.

    Words that were met before come from a bounded memo; a slice's new words
    walk the automaton side by side, and those that it lacks are merged.
    """

    def __init__(self, ranks_path: str, block: bytes) -> None:
        core = merge_core(ranks_path)
        self.merge, self.lexicon, self.cut = merger(ranks_path), Lexicon(block), words_pattern().findall
        self.other, self.plain = other_class().search, id_encoder(ranks_path)
        tokens = [core.decode_single_token_bytes(k) for k in range(SPECIAL_ID + 1)]
        self.token_size = np.fromiter(map(len, tokens), np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.memo: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        raw = [w.encode() for w in new]
        for word, code, number in zip(new, raw, self.lexicon.numbers(raw).tolist()):
            self.memo[word] = self.lexicon.ids_of(number) if number >= 0 else array("I", self.merge(code)).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = {}
        other = [i for i, text in enumerate(texts) if not text.isascii() and self.other(text)]
        if other:
            out = self.encode([text if i not in other else "" for i, text in enumerate(texts)])
            for i in other:
                out[i] = self.plain(texts[i])
            return out
        cut = [[self.cut(part) for part in text.split(SPECIAL)] for text in texts]
        new = list(set(chain.from_iterable(chain.from_iterable(cut))).difference(self.memo))
        self.learn(new)
        ids = self.memo.__getitem__
        out = [_SPECIAL.join([b"".join(map(ids, part)) for part in parts]) for parts in cut]
        for word in new:
            if len(word) > LEXICON_BYTES:  # hardly repeats
                del self.memo[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids: their bytes, gathered from the token table."""
        number = np.frombuffer(ids, "<u4")
        size = self.token_size[number]
        place = np.repeat(self.token_start[number] - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        return self.token_bytes[place].tobytes().decode("utf-8", "replace")


_SPECIAL = struct.pack("<I", SPECIAL_ID)
_CODECS: dict = {}


def codec(ranks_path: str, block: bytes) -> Codec:
    """One for each Python worker and lexicon."""
    key = (ranks_path, hashlib.sha256(block).digest())
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks_path, block)
    return _CODECS[key]


def lexicon_of(docs: DataFrame, ranks_path: str, words: int = LEXICON_WORDS):
    """The compiled lexicon of a corpus, broadcast (bounded by ``words``)."""
    block = compile_lexicon(frequent_words(docs, words), merger(ranks_path))
    return docs.sparkSession.sparkContext.broadcast(block)


def encode(docs: DataFrame, ranks_path: str, lexicon) -> DataFrame:
    """doc_id, ids (array of int) of every row."""
    def run(batches):
        code = codec(ranks_path, lexicon.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.frombuffer(i, "<i4") for i in code.encode(batch.column(1).to_pylist())], pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, lexicon) -> DataFrame:
    """doc_id, text of every row of ``encode``'s shape; null ids give an empty text."""
    def run(batches):
        code = codec(ranks_path, lexicon.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([code.decode(np.array(i or [], "<u4").tobytes()) for i in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, ranks_path: str, lexicon) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded in one pass."""
    def run(batches):
        code = codec(ranks_path, lexicon.value)
        decimal = [str(k) for k in range(SPECIAL_ID + 1)]
        for batch in slices(batches, 64):
            counts, ids_digests, text_digests = [], [], []
            for ids in code.encode(batch.column(1).to_pylist()):
                decimals = ",".join(map(decimal.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(decimals.encode()).hexdigest())
                text_digests.append(hashlib.sha256(code.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
