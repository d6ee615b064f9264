"""Operator 10: toxicity severity by cumulative-link ordinal regression.

Sparse features of a text are its distinct words and their beginnings (3 to 6
letters).  Grades are ordered; P(grade <= k) = sigmoid(t_k - w.x) with one
weight vector for all thresholds t_1 <= t_2 <= ...  The expected severity is
the sum over k of P(grade > k).

The labels tell toxic or not; toxic rows are graded by how many
marker features (seen nearly only in toxic rows) their distinct words carry: up
to ``MARKS[0]`` is grade 1, up to ``MARKS[1]`` is 2, more is 3.  A table of labels with a
column ``severity`` is used as it is.

Only fitting uses a sample: at most ``SAMPLE`` labelled rows of each class, by
the hash of their id; its feature counts are aggregated in Spark and the
``FEATURES`` most telling ones reach the driver.  Every row is scored.

Defined results: a null or empty text has no features and the lowest severity.
Null or repeated ``doc_id``: each row is scored by itself.  Without labels of
both classes there is no model: severity 0, nothing is toxic.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, slices, text_of

#: Labelled rows of each class that a model is fitted on, at most.
SAMPLE = 4000
#: Features kept (a bound on what is collected and broadcast).
FEATURES = 3000
LEAST_ROWS = 5
MARKS = (6, 18)
#: Partitions of the sample, whose size is bounded.
SAMPLE_PARTS = 16
SLOTS = 1 << 24
MEMO_ENTRIES = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def slots_of(word: str) -> list[int]:
    """Hashed features of a lowered word: itself and its beginnings."""
    found = [zlib.crc32(b"=" + word.encode()) % SLOTS]
    return found + [zlib.crc32(b"^" + word[:k].encode()) % SLOTS for k in range(3, 7) if len(word) >= k]


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(text: str) -> dict[int, int]:
    """Slot -> number of the text's distinct words that have the feature."""
    out: dict[int, int] = {}
    for word in words(text):
        for slot in slots_of(word):
            out[slot] = out.get(slot, 0) + 1
    return out


def labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, grade, slots, counts of the labelled sample."""
    grade = "severity" if "severity" in labels.columns else "toxic"
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(grade).cast("int").alias("grade"))
             .dropna().groupBy("doc_id").agg(F.max("grade").alias("grade")))
    sample = None
    for low in (F.col("grade") <= 0, F.col("grade") > 0):
        some = known.where(low).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        sample = some if sample is None else sample.unionByName(some)

    def run(batches):
        for batch in slices(batches):
            found = [features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))], names=["doc_id", "grade", "slots", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(checkpointed(sample), "doc_id")
    return rows.select("doc_id", "grade", "text").mapInArrow(run, "doc_id long, grade int, slots array<int>, counts array<int>")


@dataclass
class Model:
    """Weights by slot, thresholds in rising order."""
    weights: dict[int, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)
    memo: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > MEMO_ENTRIES:
                self.memo = {}
            found = self.memo[word] = sum(self.weights.get(s, 0.0) for s in slots_of(word))
        return found

    def link(self, text: str) -> float:
        return math.fsum(map(self.word, words(text)))

    def above(self, x: float) -> list[float]:
        """P(grade > k) for each threshold."""
        return [1 / (1 + math.exp(min(max(t - x, -500.0), 500.0))) for t in self.thresholds]


def fit_ordinal(entries: tuple[np.ndarray, np.ndarray, np.ndarray], features: int, grade: np.ndarray, weight: np.ndarray,
                l2: float = 0.1, steps: int = 600, rate: float = 0.05):
    """(weights, rising thresholds) of the cumulative-link model by gradient steps (Adam) on the mean log loss.

    ``entries`` are the non-zero cells of the rows: (row, feature, value).
    P(grade = k) = s(t_{k+1} - z) - s(t_k - z); thresholds are a start and positive gaps, so they stay in order.
    """
    (row, col, value), top = entries, int(grade.max())
    w, start, gaps = np.zeros(features), 0.0, np.zeros(max(0, top - 1))
    state = [np.zeros(w.size + 1 + gaps.size), np.zeros(w.size + 1 + gaps.size)]
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        t = np.concatenate([[-np.inf], start + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]), [np.inf]])
        z = np.bincount(row, value * w[col], len(grade))
        high, low = _sigmoid(t[grade + 1] - z), _sigmoid(t[grade] - z)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p * weight, low * (1 - low) / p * weight
        g_w = np.bincount(col, value * (d_high - d_low)[row], features) + l2 * w / len(grade)
        g_t = np.zeros(top + 2)
        np.add.at(g_t, grade + 1, -d_high)
        np.add.at(g_t, grade, d_low)
        inner = g_t[1:-1]
        g_gaps = np.array([inner[k + 1:].sum() for k in range(top - 1)]) * np.exp(gaps) if top > 1 else gaps
        g = np.concatenate([g_w, [inner.sum()], g_gaps])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, start, gaps = w - move[:w.size], start - move[w.size], np.clip(gaps - move[w.size + 1:], -5, 5)
    return w, (start + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])).tolist()


def _sigmoid(v: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-v))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = checkpointed(labelled_features(docs, labels).repartition(SAMPLE_PARTS, "doc_id"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model()
    toxic, clean = F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") <= 0)
    rate = (F.log((F.col("t") + 0.5) / (sizes[True] + 1)) - F.log((F.col("c") + 0.5) / (sizes[False] + 1))).alias("rate")
    seen = (rows.select("grade", F.explode("slots").alias("slot")).groupBy("slot").agg(toxic.alias("t"), clean.alias("c")).coalesce(SAMPLE_PARTS)
            .where(F.col("t") + F.col("c") >= LEAST_ROWS).select("slot", "t", "c", rate))
    telling = F.abs("rate") * F.sqrt(F.col("t") + F.col("c"))
    kept = seen.orderBy(F.desc(telling), "slot").limit(FEATURES).collect()
    markers = {r["slot"] for r in kept if r["t"] >= 20 and r["c"] * sizes[True] <= 0.02 * r["t"] * sizes[False]}
    wanted = F.broadcast(docs.sparkSession.createDataFrame(  # at most FEATURES rows
        [(r["slot"], i) for i, r in enumerate(kept)], "slot int, feature int"))
    cells = (rows.select("doc_id", F.explode(F.arrays_zip("slots", "counts")).alias("f"))
             .select("doc_id", F.col("f.slots").alias("slot"), F.col("f.counts").alias("n")).join(wanted, "slot")
             .select("doc_id", "feature", "n").toArrow())  # at most FEATURES cells for each of 2 * SAMPLE rows, as columns
    known = rows.select("doc_id", "grade").toArrow()
    ids, first = np.unique(known["doc_id"].to_numpy(), return_index=True)
    grade = known["grade"].to_numpy().astype(np.int64)[first]
    row, col = np.searchsorted(ids, cells["doc_id"].to_numpy()), cells["feature"].to_numpy()
    value = cells["n"].to_numpy().astype(float)
    graded = "severity" in labels.columns
    if not graded:
        marker = np.array([r["slot"] in markers for r in kept], float)
        marked = np.bincount(row, value * marker[col], len(ids))
        grade = np.where(grade > 0, 1 + np.searchsorted(MARKS, marked, side="left"), 0)
    grade = np.unique(grade, return_inverse=True)[1] if not graded else grade
    # rows of either class weigh as much as their class does among all labels
    all_of = labels.agg(F.count_if(F.col("severity" if graded else "toxic") > 0).alias("t"), F.count("*").alias("n")).first()
    share = min(max(all_of["t"] / max(all_of["n"], 1), 1e-3), 1 - 1e-3)
    weight = np.where(grade > 0, share / sizes[True], (1 - share) / sizes[False])
    w, thresholds = fit_ordinal((row, col, value), len(kept), grade, weight)
    return Model({r["slot"]: float(w[i]) for i, r in enumerate(kept) if abs(w[i]) > 1e-6}, thresholds)


_MODELS: dict = {}


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), severity (expected grade), p_toxic, toxic."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # at most FEATURES weights
    fields = [f for f in docs.schema.fields if f.name in keep]
    if not model.thresholds:
        zero = F.lit(0.0)
        return docs.select(*[f"`{f.name}`" for f in fields], zero.alias("severity"), zero.alias("p_toxic"), F.lit(False).alias("toxic"))

    def run(batches):
        weights, thresholds = shared.value
        if _MODELS.get("of") is not weights:
            _MODELS.update({"of": weights, "model": Model(weights, thresholds)})
        mine = _MODELS["model"]
        for batch in slices(batches):
            above = [mine.above(mine.link(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([sum(a) for a in above], pa.float64()), pa.array([a[0] for a in above], pa.float64()),
                 pa.array([a[0] >= 0.5 for a in above], pa.bool_())], names=[*names, "severity", "p_toxic", "toxic"])

    names = [f"keep_{i}" for i in range(len(fields))]
    rows = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(fields, names)], text_of().alias("text"))
    types = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields))
    out = rows.mapInArrow(run, f"{types}, severity double, p_toxic double, toxic boolean")
    return out.select(*[F.col(n).alias(f.name) for n, f in zip(names, fields)], "severity", "p_toxic", "toxic")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that aren't toxic, with all their columns."""
    columns = list(docs.columns)
    if "toxic" in columns or "severity" in columns or "p_toxic" in columns:  # clashing names
        renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col("text"))
        kept = scored(renamed, model, [f"c{i}" for i in range(len(columns))]).where("NOT toxic")
        return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
    return scored(docs, model, columns).where("NOT toxic").select(*[f"`{c}`" for c in columns])
