"""Operator 13: periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, of at least ``LEAST`` words
and ``TIMES`` periods, that no neighbouring word extends.  Several documents are
searched at once as one sequence of word numbers, an own number between any two.

* Ranks: level k numbers the stretches of 2^k words in sorted order, by doubling;
  the order of the last level is the suffix array as far as any run needs it, and
  the equal stretches of every level are an interval of it.
* Dyadic blocks: a run of period q with 2^k <= q < 2^(k+1) holds, within its
  first 2q words, an aligned block of m = 2^k words, which occurs again q words
  on.  So for every aligned block a wavelet matrix over the suffix array tells by
  range counts and range successors the block's occurrences that begin m to
  2m - 1 words after it.  For periods under 8 blocks of 8 words meet the 7 places
  after them.
* Progressions: in such a window three occurrences or more are an arithmetic
  progression whose step d is the block's period.  The block and its first
  occurrence lie in stretches of period d; a run's period must map one stretch's
  left or right end onto the other's, which leaves two candidates for the whole
  progression.  One or two occurrences are candidates themselves.
* A candidate (place, q) is extended to both sides by comparing ranks, largest
  level first, kept if long enough; of equal stretches the smallest period stays.

All steps are array operations over all blocks of a level.  Rows are independent
(no shuffle).  A worker holds four bytes for each word and level of ranks and of
the matrix (some 120 bytes a word), for a batch of ``BATCH_WORDS`` words or one
longer document.

Defined results: a null or empty text has no words and no run.  A null
``doc_id`` leaves its words as they are.  Repeated rows give repeated results.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import slices, text_of

LEAST, TIMES = 24, 3
SMALL = 8  # blocks of periods under 8 have 8 words; the next periods have blocks of 8 too
BATCH_WORDS = 1 << 17


# -- ranks and the wavelet matrix -------------------------------------------

def level_ranks(words: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the stretches of 1, 2, .. 2^levels words at every place, and the places in that last order.

    A rank is the number of smaller stretches, so the stretches of equal rank r
    and number c are places[r:r + c].
    """
    n = len(words)

    def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.argsort(key, kind="stable")
        ordered = key[places]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        rank = np.empty(n, np.int64)
        rank[places] = np.repeat(first, np.diff(np.append(first, n)))
        return rank, places

    rank, places = ranked(words.astype(np.int64))
    ranks = [rank]
    for k in range(levels):
        behind = np.zeros(n, np.int64)
        if 1 << k < n:
            behind[:-(1 << k)] = rank[1 << k:] + 1
        rank, places = ranked(rank * (n + 1) + behind)
        ranks.append(rank)
    return [r.astype(np.int32) for r in ranks], places


class WaveletMatrix:
    """Counts and order statistics of any stretch of an array, for many stretches at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = values >> b & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(values) - int(before[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of values[left:right] are under ``limit``."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        count = np.where(limit >= 1 << self.bits, right - left, 0)
        limit = np.minimum(limit, (1 << self.bits) - 1)
        open_ = count == 0
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            l1, r1 = ones[left], ones[right]
            up = (limit >> (self.bits - 1 - level) & 1).astype(bool)
            count += np.where(up & open_, (right - r1) - (left - l1), 0)
            left, right = np.where(up, l1 + zeros, left - l1), np.where(up, r1 + zeros, right - r1)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of values[left:right]."""
        left, right, n = left.astype(np.int64), right.astype(np.int64), n.copy()
        value = np.zeros(len(n), np.int64)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            l1, r1 = ones[left], ones[right]
            low = (right - r1) - (left - l1)
            up = n >= low
            n = np.where(up, n - low, n)
            value = value << 1 | up
            left, right = np.where(up, l1 + zeros, left - l1), np.where(up, r1 + zeros, right - r1)
        return value


# -- runs -------------------------------------------------------------------

class Matcher:
    """Finds the runs of a sequence of word numbers."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        """``longest``: words of the longest document; periods go up to a third of it."""
        self.n, self.top_period = len(words), max(longest // TIMES, SMALL)
        levels = max(3, int(self.top_period).bit_length() - 1)
        self.ranks, places = level_ranks(words, levels)
        self.tree = WaveletMatrix(places)

    def same_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on (a < b)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, live = self.ranks[k], np.arange(len(a))
            while len(live):
                x, y = a[live] + length[live], b[live] + length[live]
                inside = y + (1 << k) <= self.n
                live, x, y = live[inside], x[inside], y[inside]
                live = live[rank[x] == rank[y]]
                length[live] += 1 << k
                if k + 1 < len(self.ranks):
                    break  # at lower levels a second step can't succeed
        return length

    def same_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words just before a equal those just before b (a < b)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, live = self.ranks[k], np.arange(len(a))
            while len(live):
                x, y = a[live] - length[live] - (1 << k), b[live] - length[live] - (1 << k)
                inside = x >= 0
                live, x, y = live[inside], x[inside], y[inside]
                live = live[rank[x] == rank[y]]
                length[live] += 1 << k
                if k + 1 < len(self.ranks):
                    break
        return length

    def stretch(self, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the largest stretch around place and place + period with that period."""
        start = place - self.same_before(place, place + period)
        return start, place + period + self.same_after(place, place + period)

    def candidates(self, level: int, nearest: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, period) of the aligned blocks of a level that occur again ``nearest`` to nearest + width - 1 words on."""
        size, rank = 1 << level, self.ranks[level]
        count = np.bincount(rank, minlength=self.n)
        block = np.arange(0, self.n - size + 1, size)
        block = block[count[rank[block]] > 1]
        left = rank[block].astype(np.int64)
        right = left + count[left]
        earlier = self.tree.below(left, right, block + nearest)
        found = self.tree.below(left, right, block + nearest + width) - earlier
        hit = found > 0
        block, left, right, earlier, found = (x[hit] for x in (block, left, right, earlier, found))
        if not len(block):
            return block, block
        first = self.tree.nth(left, right, earlier)
        blocks, periods = [block], [first - block]
        if nearest < size:  # a short window: every occurrence
            for k in range(1, width):
                more = found > k
                blocks.append(block[more])
                periods.append(self.tree.nth(left[more], right[more], earlier[more] + k) - block[more])
        else:
            more = found > 1
            second = self.tree.nth(left[more], right[more], earlier[more] + 1)
            blocks.append(block[more])
            periods.append(second - block[more])
            many = found > 2
            step = (second - first[more])[many[more]]
            here, there, last = block[many], first[many], first[many] + step * (found[many] - 1)
            for shift in np.subtract(self.stretch(there, step), self.stretch(here, step)):
                ok = (shift >= there - here) & (shift <= last - here)
                blocks.append(here[ok])
                periods.append(shift[ok])
        return np.concatenate(blocks), np.concatenate(periods)

    def runs(self) -> np.ndarray:
        """Rows (start, end, period), by start, then period."""
        rows = [np.zeros((0, 3), np.int64)]
        windows = [(3, 1, SMALL - 1), *((k, 1 << k, 1 << k) for k in range(3, len(self.ranks)))]
        for level, nearest, width in windows:
            block, period = self.candidates(level, nearest, width)
            start, end = self.stretch(block, period)
            ok = end - start >= np.maximum(LEAST, TIMES * period)
            rows.append(np.stack([start[ok], end[ok], period[ok]], axis=1))
        found = np.unique(np.concatenate(rows), axis=0)  # by start, end, period
        first = np.ones(len(found), bool)
        first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[first]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


@dataclass
class Document:
    """A document's words after the planted repetition, and its runs (start, end, period)."""
    words: list[bytes]
    runs: list[tuple[int, int, int]]

    def best(self) -> tuple[int, int, int] | None:
        """The run of the greatest length for its period; ties: smallest start, then period."""
        top = None
        for start, end, period in self.runs:
            if top is None or (end - start) * top[2] > (top[1] - top[0]) * period:
                top = (start, end, period)
        return top

    def collapsed(self) -> bytes:
        keep = np.ones(len(self.words), bool)
        for start, end, period in self.runs:
            keep[start + period:end] = False
        return b" ".join([w for w, k in zip(self.words, keep.tolist()) if k])


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, chosen by their ids, repeat from some place on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def batches_of(documents: list[list[bytes]], limit: int = BATCH_WORDS):
    """Stretches of the list with about ``limit`` words, or one longer document."""
    first = held = 0
    for i, words in enumerate(documents):
        if held and held + len(words) > limit:
            yield first, i
            first, held = i, 0
        held += len(words) + 1
    if first < len(documents):
        yield first, len(documents)


def search(documents: list[list[bytes]]) -> list[Document]:
    """The runs of some documents, searched side by side."""
    number: dict[bytes, int] = {}
    numbers, starts, at = [], [], 0
    for i, words in enumerate(documents):
        starts.append(at)
        numbers.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
        numbers.append(np.array([-1 - i]))  # an own number, found nowhere else
        at += len(words) + 1
    found = [Document(words, []) for words in documents]
    longest = max(map(len, documents), default=0)
    if longest >= LEAST:
        rows = Matcher(np.concatenate(numbers), longest).runs()
        where = np.searchsorted(np.array(starts), rows[:, 0], side="right") - 1
        for i, (start, end, period) in zip(where.tolist(), rows.tolist()):
            found[i].runs.append((start - starts[i], end - starts[i], period))
    return found


_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                  ("best", pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), ("collapsed", pa.string())])


def periodic_runs(docs: DataFrame, plant: bool = True) -> DataFrame:
    """doc_id, runs (start, length, period by start, then period), best (the run of the greatest exponent), collapsed (text without repetitions)."""
    def run(batches):
        for batch in slices(batches):
            ids = batch.column(0).to_pylist()
            words = [text.encode("utf-8", "replace").split() for text in batch.column(1).to_pylist()]  # ASCII white space
            if plant:
                words = [planted(i, w) for i, w in zip(ids, words)]
            for first, stop in batches_of(words):
                out = []
                for doc_id, doc in zip(ids[first:stop], search(words[first:stop])):
                    top = doc.best()
                    out.append((doc_id, [_run(*r) for r in doc.runs], None if top is None else _run(*top), doc.collapsed().decode()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _OUT.types)], schema=_OUT)

    one = "struct<start: long, length: long, period: long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, f"doc_id long, runs array<{one}>, best {one}, collapsed string")


def _run(start: int, end: int, period: int) -> dict:
    return {"start": start, "length": end - start, "period": period}


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of what ``periodic_runs`` returns."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
