"""Operator 12: fill-in-middle by memoized content-defined chunks.

A document of n tokens (a word with the white space before it, or the white
space that ends the text) is cut after a units and after b units, and its parts
are put in another order, each behind its mark.  Where the cuts fall is found
from chunks: a rolling hash over ``WINDOW`` code points ends a chunk wherever its
low bits are zero, so a passage that documents share falls into the same chunks
wherever it stands.  A chunk's boundary summary (whether it begins and ends
inside a word, and the places of the word ends within it) is worked out once
for each worker and kept in a bounded cache under the chunk's own text: a hit is
by equality of the whole chunk, not of a hash.  Two neighbouring summaries add
up: their word ends, and one more if a word ends just at their border.  The
running sums of a document's chunks tell the chunk that holds unit a or b, and
that chunk's summary the place in it.

Which form a document takes depends on its id alone (``sha256`` of seed and id),
so rows are independent: no shuffle, and any task can be run again.

Defined results: a null text is empty (n 0, plain).  A null ``doc_id`` counts as
an empty id.  Repeated rows give repeated results.  Texts that hold a mark stay
plain, as they couldn't be rebuilt.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import slices, text_of

SEED = 42
#: In a hundred documents: so many are transformed, and of those so many suffix first.
FIM_RATE, SPM_RATE = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points that the rolling hash sees; a chunk ends where ``CHUNK_BITS`` of it are zero (256 on average).
WINDOW, CHUNK_BITS = 32, 8
#: A chunk has at least so many code points, and at most so many (text without a boundary, such as one repeated letter).
CHUNK_LEAST, CHUNK_MOST = 64, 4096
#: Code points of chunks held by a worker's cache before it starts anew.
CACHE_CHARS = 16 << 20

_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rolling(code: np.ndarray) -> np.ndarray:
    """At each place the hash of the ``WINDOW`` code points that end there (fewer at the start), made by doubling."""
    value = code * np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x85EBCA77)
    size = 1
    while size < WINDOW:
        moved = value.copy()
        moved[size:] += value[:-size] << np.uint32(size)
        value, size = moved, 2 * size
    return value


def chunk_ends(code: np.ndarray) -> list[int]:
    """Ends of the chunks, the last one that of the text."""
    marks = np.flatnonzero(rolling(code) >> np.uint32(32 - CHUNK_BITS) == 0) + 1  # the upper bits see the whole window
    ends, at = [], 0
    for mark in [*marks.tolist(), len(code)]:
        while mark - at > CHUNK_MOST:
            at += CHUNK_MOST
            ends.append(at)
        if mark - at >= CHUNK_LEAST or (mark == len(code) and mark > at):
            ends.append(mark)
            at = mark
    return ends


class Summary:
    """What a chunk adds to its document: word ends inside it, and how it meets its neighbours."""

    __slots__ = ("inside", "word_first", "word_last")

    def __init__(self, code: np.ndarray) -> None:
        word = np.ones(len(code), bool)
        low = code < 128
        word[low] = ~_SPACE[code[low]]
        self.inside = (np.flatnonzero(word[:-1] & ~word[1:]) + 1).astype(np.uint16)
        self.word_first, self.word_last = bool(word[0]), bool(word[-1])


class Chunks:
    """A worker's cache of summaries, bounded by the text it holds."""

    def __init__(self, cache_chars: int = CACHE_CHARS) -> None:
        self.cache_chars, self.known, self.held, self.hits, self.misses = cache_chars, {}, 0, 0, 0

    def summary(self, chunk: str, code: np.ndarray) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            self.misses += 1
            if self.held > self.cache_chars:
                self.known, self.held = {}, 0
            found = self.known[chunk] = Summary(code)
            self.held += len(chunk)
        else:
            self.hits += 1
        return found

    def document(self, text: str) -> Units:
        code, starts, parts, at = code_points(text), [], [], 0
        for end in chunk_ends(code):
            starts.append(at)
            parts.append(self.summary(text[at:end], code[at:end]))
            at = end
        return Units(len(text), starts, parts)


class Units:
    """A document's units: their number and where each ends, from its chunks' summaries."""

    def __init__(self, n_chars: int, starts: list[int], parts: list[Summary]) -> None:
        self.n_chars, self.starts, self.parts = n_chars, starts, parts
        # a word that ends at the border of two chunks belongs to the later one
        self.border = [i > 0 and parts[i - 1].word_last and not p.word_first for i, p in enumerate(parts)]
        self.until = list(accumulate(len(p.inside) + b for p, b in zip(parts, self.border)))
        self.n = (self.until[-1] + 1) if parts else 0  # the last unit ends with the text, a word or white space

    def end(self, k: int) -> int:
        """The place after ``k`` units."""
        if k == 0:
            return 0
        if k == self.n:
            return self.n_chars
        i = bisect_left(self.until, k)
        inside = k - (self.until[i - 1] if i else 0) - self.border[i]
        return self.starts[i] + (int(self.parts[i].inside[inside - 1]) if inside else 0)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


def ordered(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def transformed(doc_id: int | None, text: str, chunks: Chunks, seed: int = SEED) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    units = chunks.document(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= FIM_RATE or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return units.n, "plain", None, None, text
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.end(first), units.end(second)
    form = "spm" if h4 % 100 < SPM_RATE else "psm"
    return units.n, form, a, b - a, ordered(form, text[:a], text[a:b], text[b:])


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                  ("middle_chars", pa.int64()), ("output", pa.string())])


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row."""
    def run(batches):
        chunks = Chunks()
        for batch in slices(batches):
            out = [(doc_id, *transformed(doc_id, text, chunks, seed))
                   for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _OUT.types)], schema=_OUT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The document's text, from form and output alone."""
    def between(text: Column, left: str, right: str) -> Column:
        inner = F.split_part(text, F.lit(left), F.lit(2))
        return F.split_part(inner, F.lit(right), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(output, PREFIX, SUFFIX), middle, between(output, SUFFIX, MIDDLE))
    spm = F.concat(between(output, PREFIX, MIDDLE), middle, between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(done: DataFrame) -> DataFrame:
    """The digest columns of what ``fill_in_middle`` returns."""
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))
