"""Operator 6: document fingerprints by winnowing.

Rolling hashes of ``GRAM`` code points; in every window of ``WINDOW`` grams the
smallest hash is kept, of equal ones the rightmost, with its place.  Two texts
that share ``GRAM + WINDOW - 1`` code points share a hash.  The likeness of two
fingerprints is the Jaccard likeness of their hashes.

For a text next to its follower the rows are put into ranges of ``doc_id``
(bounds from quantiles), each range sorted and streamed, and the first row of
every range also sent to the range before it; so the texts are shuffled once
and no order is made in one task.

Defined results: a null or empty text has an empty fingerprint; two empty ones
are alike (1.0), an empty and another not (0.0).  A text shorter than a gram is
one gram.  Order: falling ``doc_id``, null last, then by text; the follower of
the last row is the first, a single row follows itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import slices, text_of

GRAM, WINDOW = 16, 64  # powers of two: both are made by doubling
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_NULL_ID = -2**63


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, their places) in order of place."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(code):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code *= np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(29)
    size, base = 1, _BASE
    while size < gram and len(code) > size:  # grams of twice the size from two neighbours
        code = code[:-size] * np.uint64(base) + code[size:]
        size, base = 2 * size, base * base % 2**64
    code = (code ^ (code >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    code ^= code >> np.uint64(33)
    low = (code >> np.uint64(32) << np.uint64(32)) | (_LOW - np.arange(len(code), dtype=np.uint64))  # rightmost of equals
    size = 1
    while size < window and len(low) > size:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:  # shorter than a window: one window
        low = low.min(keepdims=True)
    first = np.ones(len(low), bool)
    first[1:] = low[1:] != low[:-1]
    low = low[first]
    return (low >> np.uint64(32)).astype(np.uint32), (_LOW - (low & _LOW)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted distinct sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def edited(text: str, follower: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + follower[:n]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, hashes (array of long), places (array of long) of every row."""
    def run(batches):
        for batch in slices(batches):
            found = [winnow(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                 pa.array([p for _, p in found], pa.list_(pa.int64()))], names=["doc_id", "hashes", "places"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, hashes array<long>, places array<long>")


def _ranges(docs: DataFrame, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their range, and for each range's first id the range that ends before it."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("k"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(keyed.select("k").approxQuantile("k", shares, 1 / (4 * ranges)))) if shares else []
    inside = keyed.withColumn("bucket", F.expr(
        "0" if not bounds else f"size(filter(array({', '.join(f'{b!r}D' for b in bounds)}), b -> b < k))").cast("int"))
    heads = sorted(tuple(r) for r in inside.groupBy("bucket").agg(F.max("k").alias("k")).collect())  # one for each range
    rows = [(k, heads[(i + 1) % len(heads)][0]) for i, (_, k) in enumerate(heads)]
    return inside, docs.sparkSession.createDataFrame(rows, "k long, before int")


def against_followers(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside, heads = _ranges(docs, ranges or 4 * parts)
    rows = (inside.join(F.broadcast(heads), "k", "left")  # a row for each range
            .select("doc_id", "text", "k", F.explode(F.filter(F.array(
                F.struct(F.col("bucket"), F.lit(0).alias("guest")),
                F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest"))), lambda x: x["bucket"].isNotNull())).alias("at"))
            .select("at.bucket", "at.guest", "k", "doc_id", "text")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", F.desc("k"), "text")
            .select("bucket", "guest", "doc_id", "text"))

    def run(batches):
        held = None  # (range, doc_id, text, fingerprint, its set) that waits for its follower
        for batch in slices(batches):
            out = []
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if guest and (held is None or held[0] != bucket):
                    continue  # another row of the same id: the follower is known
                print_ = winnow(text)[0]
                kinds = np.unique(print_)
                if held is not None:
                    if held[0] != bucket:
                        raise ValueError("a range ends without its follower")
                    out.append(_compared(held, text, kinds))
                held = None if guest else (bucket, doc_id, text, print_, kinds)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)
        if held is not None:
            raise ValueError("a range ends without its follower")

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(held: tuple, follower: str, follower_kinds: np.ndarray) -> tuple:
    _, doc_id, text, print_, kinds = held
    changed = edited(text, follower)
    changed_print = winnow(changed)[0]
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            print_.astype(">u4").tobytes().hex(), changed_print.astype(">u4").tobytes().hex(),
            likeness(kinds, np.unique(changed_print)), likeness(kinds, follower_kinds))
