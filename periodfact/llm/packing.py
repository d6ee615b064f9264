"""Operator 1: best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  The pieces' lengths
are counted for the whole corpus (at most ``capacity`` rows).  Minimum bin
slack then fills bin after bin: the longest length left opens the bin, and a
subset-sum dynamic programme over the lengths still available, kept as the
bits of one integer, finds the fullest feasible combination, which is removed.
The combination stays the fullest one until a length of it runs out, so it is
taken as often as the counts allow in one step: at most ``capacity`` steps and
a few more, whatever the corpus size.  The plan (runs of equal bins) is bounded
by lengths, not by documents, and travels to the tasks as arrays.

Each piece has a rank among the pieces of its length: a running count within
the task that made it plus the count of earlier tasks.  Rank and length give
sequence and place, so no piece is ever shuffled to be placed.

Defined results: a null text is empty (one piece: the closing id).  Rows with a
null or repeated ``doc_id`` are packed as rows of their own.  An empty table
gives an empty result.  Only the columns ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, slices, text_of
from periodfact.llm.vocab import id_encoder

CAPACITY = 2048
CLOSING_ID = 0

PIECES = ("doc_id long, piece int, start long, length int, ids_crc32 long, part int, local_rank long")


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    n = len(ids) // 4
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece, with its rank among its task's pieces of that length."""
    def run(batches):
        encode, closing = id_encoder(ranks_path), np.array([CLOSING_ID], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in slices(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(encode(text) + closing)
                for k, (start, length) in enumerate(cut(ids, capacity)):
                    crc = zlib.crc32(ids[4 * start: 4 * (start + length)])
                    out.append((doc_id, k, start, length, crc, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECES)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("local_rank", pa.int64())])


def fullest(lengths: list[int], counts: list[int], room: int) -> dict[int, int]:
    """Multiset of available lengths with the largest sum within ``room``.

    ``lengths`` falls.  Bit s of ``reach[k]`` tells whether the sum s can be
    made from the first k lengths; a count is taken as powers of two.
    """
    full, reach, steps = (1 << (room + 1)) - 1, [1], []
    for length, count in zip(lengths, counts):
        count, k = min(count, room // length), 1
        while count > 0:
            take = min(k, count)
            steps.append((length, take))
            reach.append((reach[-1] | reach[-1] << (length * take)) & full)
            count, k = count - take, 2 * k
        if reach[-1] >> room & 1:
            break
    total, taken = reach[-1].bit_length() - 1, {}
    for k in range(len(steps), 0, -1):
        if not reach[k - 1] >> total & 1:
            length, take = steps[k - 1]
            taken[length] = taken.get(length, 0) + take
            total -= length * take
    return taken


@dataclass
class Run:
    """``bins`` equal bins from number ``first`` on: (length, how often) from the front."""
    first: int
    bins: int
    parts: list[tuple[int, int]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    left, runs, first = {k: v for k, v in counts.items() if v > 0}, [], 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        order = sorted((k for k, v in rest.items() if v and k <= capacity - longest), reverse=True)
        parts = fullest(order, [rest[k] for k in order], capacity - longest)
        parts[longest] = parts.get(longest, 0) + 1
        bins = min(left[k] // n for k, n in parts.items())
        runs.append(Run(first, bins, sorted(parts.items(), reverse=True)))
        first += bins
        for k, n in parts.items():
            left[k] -= n * bins
            if not left[k]:
                del left[k]
    return runs


def places(runs: list[Run]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by rank: where its stretch begins, the run's first bin, the bin's share, the offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    for run in runs:
        offset = 0
        for length, n in run.parts:
            at = used.get(length, 0)
            found.setdefault(length, []).append((at, run.first, n, offset))
            used[length] = at + n * run.bins
            offset += n * length
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in found.items()}


def place(length: int, rank: int, by_length) -> tuple[int, int]:
    """(sequence, offset) of one piece; the plain form of what tasks do by arrays."""
    begins, first, share, offset = by_length[length]
    k = bisect_right(begins.tolist(), rank) - 1
    inside = rank - int(begins[k])
    return int(first[k]) + inside // int(share[k]), int(offset[k]) + inside % int(share[k]) * length


def pack(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    made = checkpointed(pieces(docs, ranks_path, capacity))
    per_task = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length = spark.sparkContext.broadcast(places(plan(counts, capacity)))  # bounded by lengths
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = made.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank"))

    def assign(batches):
        table = by_length.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                begins, first, share, base = table[int(value)]
                k = np.searchsorted(begins, rank[at], side="right") - 1
                inside = rank[at] - begins[k]
                sequence[at] = first[k] + inside // share[k]
                offset[at] = base[k] + inside % share[k] * value
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("piece"), batch.column("start"), pa.array(length),
                 batch.column("ids_crc32"), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
