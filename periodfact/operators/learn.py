"""Learning and scoring on Spark.

The hold-out, oversampling, KNN and all scores are DataFrame plans; the
driver only sees bounded values: per seed and class a histogram of at most 4,096
counts and a cut, the label list and scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodfact.operators.columns import q

HASH = "__h"
HEX_DIGITS = 3            # of the histogram's prefixes (4,096 buckets)
INLINE_CUTS = 32          # up to so many boundary buckets are a condition, more a join
MAX_BOUNDARY_ROWS = 8192  # rows of boundary buckets that are sorted on the driver, more are ranked in Spark


# M1 P6 X8 -------------------------------------------------------------------
def fill_missing(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Null features -> ``value`` (0 reads as "none", as in the reference)."""
    return df.na.fill(value, subset=list(cols))


def assemble_features(df: DataFrame, feature_cols: Sequence[str], label_col: str | None = None,
                      fill: float | None = 0.0, out: str = "features") -> DataFrame:
    """M1: fill, then one vector column; the label is indexed separately by the model."""
    if fill is not None:
        df = fill_missing(df, feature_cols, fill)
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out,
                           handleInvalid="keep").transform(df)


def label_indexer(label_col: str, out: str = "label") -> StringIndexer:
    """Label -> index in alphabetical order (stable across runs and engines)."""
    return StringIndexer(inputCol=label_col, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="keep")


# Exact k-smallest selection by hash order -------------------------------------
def hash_key(key: Column, seed: int | str, salt: str = "") -> Column:
    """md5 of ``seed|salt|key``: a reproducible pseudo-random order of the rows."""
    parts = [F.lit(str(seed))] + ([F.lit(salt)] if salt else []) + [key.cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def seeded_rows(df: DataFrame, key: str, seeds: Sequence[int | str], group: str | None = None, salt: str = "") -> DataFrame:
    """seed, g, k, HASH of every row under every seed (never stored: histograms and cuts are taken from it)."""
    k = F.col(q(key))
    parts = [F.lit(salt)] if salt else []
    rows = df.select(k.alias("k"), (F.col(q(group)) if group else F.lit(0)).alias("g"),
                     F.explode(F.array(*[F.lit(str(s)) for s in seeds])).alias("seed"))
    return rows.withColumn(HASH, F.md5(F.concat_ws("|", "seed", *parts, F.col("k").cast("string"))))


def smallest_k_cuts(rows: DataFrame, need: Callable[[int, int], int]) -> dict:
    """For each (seed, group) of :func:`seeded_rows`: its row count and the ``(hash, key)`` of its k-th smallest row.

    ``need`` gives k from the group's row count and the largest count of the
    seed's groups; without a k-th row the cut is None.  Two reads for any number
    of seeds and groups: one histogram of rows per hash prefix (reduced before
    it is shuffled) tells the bucket that holds the k-th row, and only the rows
    of those buckets are ranked, each bucket by itself.
    """
    prefix = F.conv(F.substring(F.col(HASH), 1, HEX_DIGITS), 16, 10).cast("long")
    counted = rows.groupBy("seed", "g", prefix.alias("b")).agg(F.count("*").alias("n")).toArrow().to_pylist()
    buckets: dict = {}
    for r in counted:
        buckets.setdefault((r["seed"], r["g"]), []).append((r["b"], r["n"]))
    totals = {at: sum(n for _, n in found) for at, found in buckets.items()}
    largest: dict = {}
    for (seed, _), n in totals.items():
        largest[seed] = max(n, largest.get(seed, 0))
    edges = []  # seed, group, the bucket of the k-th row, its place there
    for (seed, g), found in buckets.items():
        left = need(totals[seed, g], largest[seed])
        for b, n in sorted(found) if 0 < left <= totals[seed, g] else ():
            if left <= n:
                edges.append((seed, g, b, left))
                break
            left -= n
    cuts: dict = {}
    if edges:
        schema = T.StructType([rows.schema["seed"], T.StructField("eg", rows.schema["g"].dataType), T.StructField("eb", T.LongType()),
                               T.StructField("rest", T.LongType())])
        table = rows.sparkSession.createDataFrame(edges, schema).withColumnRenamed("seed", "es")
        placed = rows.withColumn("b", prefix)
        if len(edges) <= INLINE_CUTS:
            hit = F.lit(False)
            for seed, g, b, _ in edges:
                hit = hit | ((F.col("seed") == F.lit(seed)) & F.col("g").eqNullSafe(F.lit(g)) & (F.col("b") == F.lit(b)))
            placed = placed.where(hit)
            sizes = {(seed, g): dict(buckets[seed, g])[b] for seed, g, b, _ in edges}
            if sum(sizes.values()) <= MAX_BOUNDARY_ROWS:
                near: dict = {}
                for r in placed.select("seed", "g", HASH, "k").toArrow().to_pylist():
                    near.setdefault((r["seed"], r["g"]), []).append((r[HASH], r["k"]))
                cuts = {(seed, g): sorted(near[seed, g])[left - 1] for seed, g, _, left in edges}
                return {at: (n, cuts.get(at)) for at, n in totals.items()}
        same = (F.col("seed") == F.col("es")) & F.col("g").eqNullSafe(F.col("eg")) & (F.col("b") == F.col("eb"))
        place = F.row_number().over(Window.partitionBy("seed", "g").orderBy(HASH, "k"))
        ranked = placed.join(F.broadcast(table), same).withColumn("place", place)  # the table: a row for each seed and group
        cuts = {(r["seed"], r["g"]): (r[HASH], r["k"]) for r in ranked.where("place = rest").select("seed", "g", HASH, "k").collect()}
    return {at: (n, cuts.get(at)) for at, n in totals.items()}


def _within_cut(key: str, cut) -> Column:
    if cut is None:
        return F.lit(False)
    h, k = cut
    return (F.col(HASH) < F.lit(h)) | ((F.col(HASH) == F.lit(h)) & (F.col(q(key)) <= F.lit(k)))


# M2 ---------------------------------------------------------------------------
def _test_rows(test_size: float | int) -> Callable[[int, int], int]:
    return lambda n, _: min(n, test_size) if isinstance(test_size, int) else math.ceil(n * test_size)


def holdout(df: DataFrame, key: str, test_size: float | int, seed: int = 42,
            out: str = "is_test") -> DataFrame:
    """M2: exact, reproducible test/train split by hash order.

    The test side is the ``ceil(n * test_size)`` rows (or ``test_size`` rows
    for an int) with the smallest ``md5(seed|key)``; it does not depend on
    partitioning.  Keys must be unique.  The input is read twice before it is
    used: checkpoint an expensive input first, as the learning plans do.
    """
    return holdouts(df, key, test_size, [seed], out)[seed]


def holdouts(df: DataFrame, key: str, test_size: float | int, seeds: Sequence[int], out: str = "is_test") -> dict[int, DataFrame]:
    """:func:`holdout` for many seeds: all cuts from the same two reads."""
    cuts = smallest_k_cuts(seeded_rows(df, key, seeds), _test_rows(test_size))
    return {s: df.withColumn(HASH, hash_key(F.col(q(key)), s)).withColumn(out, _within_cut(key, cuts.get((str(s), 0), (0, None))[1])).drop(HASH)
            for s in seeds}


def seeded_holdout(df: DataFrame, key: str, test_size: float | int, seeds: Sequence[int]) -> DataFrame:
    """The test rows of every seed in one frame, with their ``seed``: scores of all seeds then take one more read."""
    cuts = smallest_k_cuts(seeded_rows(df, key, seeds), _test_rows(test_size))
    return _below_cuts(_with_seeds(df, key, seeds), {s: cut for (s, _), (_, cut) in cuts.items()}, key, below=True)


def _with_seeds(df: DataFrame, key: str, seeds: Sequence[int]) -> DataFrame:
    return (df.withColumn("seed", F.explode(F.array(*[F.lit(str(s)) for s in seeds])))
            .withColumn(HASH, F.md5(F.concat_ws("|", "seed", F.col(q(key)).cast("string")))))


def _below_cuts(rows: DataFrame, cuts: dict, key: str, below: bool) -> DataFrame:
    """Rows (with ``seed`` and HASH) on one side of their seed's cut; the cuts travel as one literal map."""
    known = {s: c for s, c in cuts.items() if c is not None}
    if not known:
        return rows.where(F.lit(not below)).drop(HASH)
    table = F.create_map(*[x for s, (h, k) in known.items() for x in (F.lit(s), F.struct(F.lit(h).alias("h"), F.lit(k).alias("k")))])
    cut = F.element_at(table, F.col("seed"))
    within = (F.col(HASH) < cut["h"]) | ((F.col(HASH) == cut["h"]) & (F.col(q(key)) <= cut["k"]))
    return rows.where(within if below else ~within).drop(HASH)


# M3 ---------------------------------------------------------------------------
MAX_COPIES_PER_TASK = 1_000_000


def oversample(train: DataFrame, label: str, key: str, seed: int = 42,
               copy_col: str = "copy", max_copies_per_task: int | None = None) -> DataFrame:
    """M3: every class grows to the majority count; all originals are kept.

    With ``M`` the majority count and ``n`` a class count, every row gets
    ``M // n`` copies and the ``M % n`` rows of lowest ``md5(seed|os|key)``
    one more: exact class sizes, reproducible, and no class is ever pulled
    into a single task (the cut comes from prefix histograms).  When one row
    needs more than ``max_copies_per_task`` copies (a tiny class against a
    huge one), its copies are cut into chunks that are spread over tasks
    before they are generated.
    """
    cuts = smallest_k_cuts(seeded_rows(train, key, [seed], label, "os"), lambda n, m: m % n)
    return _copied(train, label, key, seed, {g: c for (_, g), c in cuts.items()}, copy_col, max_copies_per_task or MAX_COPIES_PER_TASK)


def _copied(train: DataFrame, label: str, key: str, seed: int, classes: dict, copy_col: str, limit: int) -> DataFrame:
    """The rows with their copies; ``classes``: class -> (rows, cut of the rows with one copy more)."""
    if not classes:
        return train.withColumn(copy_col, F.lit(1))
    m = max(n for n, _ in classes.values())
    h = train.withColumn(HASH, hash_key(F.col(q(key)), seed, "os"))
    base = bonus = F.lit(0)
    for g, (n, cut) in classes.items():
        is_g = F.col(q(label)).eqNullSafe(F.lit(g))
        base = F.when(is_g, F.lit(m // n)).otherwise(base)
        if m % n:
            bonus = F.when(is_g & _within_cut(key, cut), F.lit(1)).otherwise(bonus)
    h = h.withColumn("__copies", base + bonus)
    most = max(m // n + (1 if m % n else 0) for n, _ in classes.values())
    if most <= limit:
        out = h.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    else:
        chunks = F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / limit).cast("int"))
        spread = (h.withColumn("__chunk", F.explode(chunks))
                  .repartition(F.col(q(key)), F.col("__chunk")))
        first = F.col("__chunk") * limit + 1
        last = F.least(F.col("__chunk") * limit + limit, F.col("__copies"))
        out = spread.withColumn(copy_col, F.explode(F.sequence(first, last))).drop("__chunk")
    return out.drop(HASH, "__copies")


# M4 M6 ------------------------------------------------------------------------
MAX_BINS = 32           # of a feature, as in pyspark.ml's trees
FINE = 1024             # percentiles that a feature's bins are chosen from
MAX_GROUPS = 1 << 18    # of a grouped train side: the most a task of a grouped forest holds
ROWS_A_GROUP = 16       # fewer rows a group: nothing is gained by grouping


def fit_forest(train: DataFrame, label_col: str, features: str = "features", seed: int = 42,
               num_trees: int = 100, max_depth: int = 12):
    """M4: random forest (depth set explicitly; the reference library grows unbounded).

    Trees split binned features, so rows of the same bins and label are alike to
    them.  Where such rows are many, they are counted once by Spark and trees grow
    on the counts (:func:`_grow_tree`), each tree's bag a Poisson number of every
    group's rows; else pyspark.ml's forest visits each row for each tree and level.
    Depth, gini, the number of bins, features a node and votes are those of pyspark.ml;
    it takes the bins from a sample, this from percentiles of all rows.
    """
    grouped = _grouped_forest(train, label_col, features, seed, num_trees, max_depth)
    if grouped is not None:
        return grouped
    rf = RandomForestClassifier(featuresCol=features, labelCol="label", numTrees=num_trees,
                                maxDepth=max_depth, seed=seed, maxMemoryInMB=1024,
                                cacheNodeIds=True)
    return _with_labels(rf, label_col).fit(train)


def _entries(df: DataFrame, features: str, dims: int) -> DataFrame:
    values = vector_to_array(F.col(q(features)))
    return df.withColumns({f"__x{i}": values[i] for i in range(dims)})


def _binning(rows: DataFrame, dims: int) -> Bucketizer | None:
    """Bins of all rows' values: one for each of a few values, else between percentiles.  None if a value is not finite."""
    at = ",".join(f"{i / FINE}D" for i in range(1, FINE))  # as text: a thousand columns take Python seconds to make
    xs = [f"__x{i}" for i in range(dims)]
    odd = F.max(F.greatest(*[F.isnan(x) | (F.abs(x) == math.inf) for x in xs], F.lit(False)))
    found = rows.agg(odd, *[F.approx_count_distinct(x) for x in xs], *[F.expr(f"percentile_approx({x}, array({at}), 10000)") for x in xs]).first()
    if found[0]:
        return None
    ends = [_bin_ends(np.array(values)) for values in found[1 + dims:]]
    few = [i for i in range(dims) if found[1 + i] <= MAX_BINS]
    sets = rows.agg(*[F.sort_array(F.collect_set(xs[i])) for i in few]).first() if few else ()
    for i, values in zip(few, sets):
        if len(values) <= MAX_BINS:
            ends[i] = values[:-1]
    # a value that ends a bin belongs to it
    splits = [[-math.inf, *sorted({math.nextafter(v, math.inf) for v in e}), math.inf] for e in ends]
    return Bucketizer(inputCols=xs, outputCols=[f"__b{i}" for i in range(dims)],
                      splitsArray=[s if len(s) > 2 else [-math.inf, 0.0, math.inf] for s in splits], handleInvalid="keep")


def _bin_ends(fine: np.ndarray) -> list[float]:
    """Of many percentiles, the values that end a bin: those of a bin's rows or more, and the rest in even steps."""
    values, counts = np.unique(fine, return_counts=True)
    heavy = counts * MAX_BINS >= len(fine)
    rest = np.repeat(values[~heavy], counts[~heavy])
    steps = MAX_BINS - int(heavy.sum())
    return [*values[heavy].tolist(), *(rest[len(rest) * i // steps] for i in range(1, steps) if len(rest))]


def _grouped_forest(train: DataFrame, label_col: str, features: str, seed: int, num_trees: int, max_depth: int) -> "_GroupedForest | None":
    """The forest from the counts of (bins, label), or None if they are too many, or hardly fewer than the rows."""
    from periodfact.session import ensure_checkpoint_dir
    spark = train.sparkSession
    first = train.select(F.size(vector_to_array(F.col(q(features)))).alias("n")).first()
    if not first or not first["n"]:
        return None
    dims = first["n"]
    rows = _entries(train.select(features, label_col), features, dims)
    binning = _binning(rows, dims)
    if binning is None:  # pyspark.ml's forest says so
        return None
    bins = binning.getOutputCols()
    ensure_checkpoint_dir(spark)
    groups = (binning.transform(rows).groupBy(*[F.col(b).cast("int").alias(b) for b in bins], F.col(q(label_col)).cast("string").alias("y"))
              .agg(F.count("*").alias("n")).checkpoint())
    size = groups.agg(F.count("*").alias("groups"), F.sum("n").alias("rows"), F.sort_array(F.collect_set("y")).alias("labels"),
                      F.max(F.col("y").isNull()).alias("unknown")).first()
    if size["groups"] > MAX_GROUPS or size["rows"] < ROWS_A_GROUP * size["groups"]:
        return None
    labels = [*size["labels"], *([None] if size["unknown"] else [])]
    tasks = min(num_trees, spark.sparkContext.defaultParallelism)
    dealt = spark.range(0, tasks, 1, tasks).crossJoin(F.broadcast(groups))  # at most MAX_GROUPS rows
    sizes = [max(len(s) for s in binning.getSplitsArray()), len(labels)]

    def grow(batches):
        pdf = pd.concat(list(batches), ignore_index=True)
        y = pdf["y"].map({c: i for i, c in enumerate(labels) if c is not None}).fillna(len(labels) - 1).to_numpy(dtype=np.int64)
        x = pdf[bins].to_numpy(dtype=np.int64)
        order = np.lexsort([y, *x.T])  # the same trees however the groups arrive
        x, y, n = x[order], y[order], pdf["n"].to_numpy()[order]
        for tree in range(int(pdf["id"].iloc[0]), num_trees, tasks):
            feature, end, left, share = _grow_tree(x, y, n, *sizes, max_depth, np.random.default_rng([seed % (1 << 63), tree]))
            yield pd.DataFrame({"tree": tree, "node": np.arange(len(feature)), "feature": feature, "end": end, "left": left, "share": list(share)})

    found = dealt.mapInPandas(grow, "tree int, node int, feature int, end int, left int, share array<double>").toPandas()
    trees = [tuple(t[c].to_numpy() for c in ("feature", "end", "left")) + (np.stack(t["share"]),)
             for _, t in found.sort_values(["tree", "node"]).groupby("tree")]
    return _GroupedForest(features, dims, binning, labels, trees)


def _grow_tree(x: np.ndarray, y: np.ndarray, n: np.ndarray, n_bins: int, n_classes: int, max_depth: int, rng) -> tuple:
    """A gini tree on a bag of counted rows, level by level: feature (-1: a leaf), last bin of the left side, left child
    (the right one follows) and class shares of each node."""
    bag = rng.poisson(n)
    if not bag.any():
        bag = n
    x, y, w = x[bag > 0], y[bag > 0], bag[bag > 0].astype(np.float64)
    dims = x.shape[1]
    tried = math.ceil(math.sqrt(dims))
    at, m, made, levels = np.zeros(len(x), dtype=np.int64), 1, 1, []
    for depth in range(max_depth + 1):
        total = np.bincount(at * n_classes + y, w, m * n_classes).reshape(m, n_classes)
        weight = total.sum(axis=1)
        base = (total ** 2).sum(axis=1) / weight
        best, feature, end = base + 1e-10 * weight, np.full(m, -1), np.zeros(m, dtype=np.int64)
        mine = rng.random((m, dims)).argsort(axis=1).argsort(axis=1) < tried
        for f in range(dims if depth < max_depth else 0):
            held = np.bincount((at * n_bins + x[:, f]) * n_classes + y, w, m * n_bins * n_classes).reshape(m, n_bins, n_classes)
            low = held.cumsum(axis=1)[:, :-1]
            high = total[:, None] - low
            a, b = low.sum(axis=2), high.sum(axis=2)
            with np.errstate(divide="ignore", invalid="ignore"):
                purity = np.where((a > 0) & (b > 0), (low ** 2).sum(axis=2) / a + (high ** 2).sum(axis=2) / b, -1.0)
            cut = purity.argmax(axis=1)
            gain = purity[np.arange(m), cut]
            better = mine[:, f] & (gain > best)
            best, feature, end = np.where(better, gain, best), np.where(better, f, feature), np.where(better, cut, end)
        inner = feature >= 0
        rank = np.cumsum(inner) - 1
        levels.append((feature, end, np.where(inner, made + 2 * rank, 0), total / weight[:, None]))
        if not inner.any():
            break
        kept = inner[at]
        x, y, w, at = x[kept], y[kept], w[kept], at[kept]
        at = 2 * rank[at] + (x[np.arange(len(x)), feature[at]] > end[at])
        m = 2 * int(inner.sum())
        made += m
    feature, end, left, share = (np.concatenate(c) for c in zip(*levels))
    says = share.argmax(axis=1)
    for i in np.flatnonzero(feature >= 0)[::-1]:  # leaves of one parent that say the same are one
        a = left[i]
        if feature[a] < 0 and feature[a + 1] < 0 and says[a] == says[a + 1]:
            feature[i] = -1
    return feature, end, left, share


class _GroupedForest:
    """The trees of :func:`_grouped_forest` on binned features: the class with most shares, of equals the first."""

    def __init__(self, features: str, dims: int, binning: Bucketizer, labels: list, trees: list):
        self.features, self.dims, self.binning, self.labels, self.trees = features, dims, binning, labels, trees

    def transform(self, df: DataFrame) -> DataFrame:
        labels, trees = np.array(self.labels, dtype=object), self.trees

        def vote(*bins: pd.Series) -> pd.Series:
            x, back = np.unique(np.column_stack([b.to_numpy(dtype=np.int64) for b in bins]), axis=0, return_inverse=True)
            votes = np.zeros((len(x), len(labels)))
            for feature, end, left, share in trees:
                at = np.zeros(len(x), dtype=np.int64)
                moving = np.arange(len(x))
                while len(moving := moving[feature[at[moving]] >= 0]):
                    here = at[moving]
                    at[moving] = left[here] + (x[moving, feature[here]] > end[here])
                votes += share[at]
            return pd.Series(labels[votes.argmax(axis=1)][back.reshape(-1)], dtype=object)

        binned = self.binning.transform(_entries(df, self.features, self.dims))
        bins = self.binning.getOutputCols()
        return binned.withColumn("predicted", F.pandas_udf(vote, "string")(*bins)).drop(*bins, *self.binning.getInputCols())


def _lean(model):
    """The model without its training summary: that holds the session, which can't go to tasks once an Observation was made in it."""
    none = SparkContext._active_spark_context._jvm.scala.Option.empty()
    for one in getattr(model, "models", [model]):
        one._java_obj.setSummary(none)
    return model


def fit_linear_svm(train: DataFrame, label_col: str, features: str = "features",
                   max_iter: int = 20, reg: float = 1e-3, parallelism: int = 4):
    """M6: linear SVM for several classes (one-vs-rest, classes fitted concurrently).

    A small L2 term (like the reference library's soft margin) keeps the
    optimiser's line search stable on separable classes.
    """
    svc = OneVsRest(classifier=LinearSVC(maxIter=max_iter, regParam=reg), featuresCol=features,
                    labelCol="label", parallelism=parallelism)
    return _with_labels(svc, label_col).fit(train)


def pair_votes(decisions: DataFrame, classes: Sequence[str], pairs: dict[tuple[str, str], str], out: str = "predicted") -> DataFrame:
    """One-vs-one: each pair's column names its winner (null: no vote); most votes win, of equals the class listed first."""
    votes = [sum([F.when(F.col(q(c)) == F.lit(name), 1).otherwise(0) for pair, c in pairs.items() if name in pair], F.lit(0)) for name in classes]
    best = F.greatest(*[F.struct(v.alias("v"), F.lit(-i).alias("r"), F.lit(name).alias("c")) for i, (name, v) in enumerate(zip(classes, votes))]) \
        if len(classes) > 1 else F.struct(F.lit(1).alias("v"), F.lit(0).alias("r"), F.lit(classes[0]).alias("c"))
    return decisions.withColumn(out, best["c"])


def fit_pairwise_svm(train: DataFrame, label_col: str, features: str = "features", max_iter: int = 20, reg: float = 1e-3,
                     parallelism: int = 4) -> "_PairwiseModel":
    """M6: a linear SVM for each pair of classes, fitted on the rows of the two, and a vote of all pairs.

    The number of models grows with the square of the number of classes (a
    label list of a few dozen at most); they are fitted concurrently.
    """
    classes = sorted(r[0] for r in train.select(label_col).where(F.col(q(label_col)).isNotNull()).distinct().collect())
    pairs = [(a, b) for i, a in enumerate(classes) for b in classes[i + 1:]]

    def fit(pair):
        two = train.where(F.col(q(label_col)).isin(*pair)).withColumn("label", (F.col(q(label_col)) == F.lit(pair[1])).cast("double"))
        return LinearSVC(featuresCol=features, labelCol="label", maxIter=max_iter, regParam=reg,
                         rawPredictionCol="raw", predictionCol="side").fit(two)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return _PairwiseModel(classes, dict(zip(pairs, map(_lean, pool.map(fit, pairs)))))


class _PairwiseModel:
    def __init__(self, classes: list[str], models: dict):
        self.classes, self.models = classes, models

    def transform(self, df: DataFrame) -> DataFrame:
        columns = {}
        out = df
        for i, ((a, b), model) in enumerate(self.models.items()):
            columns[a, b] = f"__pair{i}"
            out = model.transform(out).withColumn(columns[a, b], F.when(F.col("side") > 0, F.lit(b)).otherwise(F.lit(a))).drop("raw", "side")
        return pair_votes(out, self.classes, columns).drop(*columns.values())


def _with_labels(estimator, label_col: str) -> "_LabelledEstimator":
    indexer = label_indexer(label_col)
    return _LabelledEstimator(indexer, estimator)


class _LabelledEstimator:
    """Index the label, fit, and map predictions back to label strings."""

    def __init__(self, indexer: StringIndexer, estimator):
        self.indexer, self.estimator = indexer, estimator

    def fit(self, train: DataFrame):
        idx = self.indexer.fit(train)
        model = _lean(self.estimator.fit(idx.transform(train)))
        back = IndexToString(inputCol="prediction", outputCol="predicted", labels=idx.labels)
        return _LabelledModel(model, back)


class _LabelledModel:
    def __init__(self, model, back: IndexToString):
        self.model, self.back = model, back

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.back.transform(self.model.transform(df))
        return out.drop("rawPrediction", "probability", "prediction")


# M5 ---------------------------------------------------------------------------
def _vector_codes(v: np.ndarray) -> np.ndarray:
    """A number for each row of ``v``, the same for rows of the same bytes."""
    return pd.factorize(np.fromiter((row.tobytes() for row in v), dtype=object, count=len(v)))[0]


def _by_key(v: np.ndarray, keys: pa.Array, k: int) -> np.ndarray:
    """The rows of ``v`` in key order (nulls last), of equal vectors the first k: no other can be among k nearest.

    A vector with a NaN is at no distance from anything and left out.
    """
    order = pc.array_sort_indices(keys, null_placement="at_end").to_numpy()
    order = order[~np.isnan(v[order]).any(axis=1)]
    codes = pd.Series(_vector_codes(v[order]))
    return order[codes.groupby(codes).cumcount().to_numpy() < k]


BOX_ROWS = 256


def _boxes(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of ``t`` in boxes of rows that are neighbours in value order: each row's box, least and greatest corners."""
    order = np.lexsort(t.T[::-1])
    starts = np.arange(0, len(t), BOX_ROWS)
    box = np.empty(len(t), dtype=np.int64)
    box[order] = np.arange(len(t)) // BOX_ROWS
    return box, np.minimum.reduceat(t[order], starts), np.maximum.reduceat(t[order], starts)


def _box_gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No row of ``x`` is nearer to a row of a box than this squared distance."""
    gap = np.maximum(0.0, np.maximum(low - x.max(axis=0), x.min(axis=0) - high))
    return (gap * gap).sum(axis=1)


def _add_nearest(best: list, x: np.ndarray, t: np.ndarray, keys: pa.Array, labels: pa.Array, k: int, test_block: int) -> None:
    """Merge the rows ``t``, which are in key order, into the k ``best`` (distance, null key, key, label) of each row of ``x``.

    Boxes of training rows too far from all of a block are left out.  Of the others a
    matrix product bounds all distances from both sides; only the pairs that may be
    among the k nearest by it get the exact distance, squared differences summed in
    vector order.
    """
    m, dims = t.shape
    with np.errstate(all="ignore"):
        x2, t2 = (x * x).sum(axis=1), (t * t).sum(axis=1)
        slack = 16 * (dims + 8) * np.finfo(np.float64).eps * (x2 + t2.max())  # of product and sum, well above their rounding
        left, right = np.column_stack([x, np.ones(len(x))]), np.column_stack([-2.0 * t, t2]).T.copy()
        box, low, high = _boxes(t)
        filled = np.bincount(box)
        placed = np.lexsort(x.T[::-1])  # a block's test rows are neighbours too
        for s in range(0, len(x), test_block):
            mine = placed[s:s + test_block]
            limit = np.array([best[i][-1][0] if len(best[i]) == k else np.inf for i in mine])
            new = np.flatnonzero(np.isinf(limit))
            seen, gaps = None, _box_gaps(x[mine], low, high)
            if len(low) > 1 and m >= k:
                bound = limit + slack[mine]
                if len(new):
                    by_gap = np.argsort(gaps, kind="stable")
                    some = np.flatnonzero(np.isin(box, by_gap[:np.searchsorted(filled[by_gap].cumsum(), k) + 1]))
                    bound[new] = np.partition(left[mine[new]] @ right[:, some], k - 1, axis=1)[:, k - 1] + x2[mine[new]] + 2 * slack[mine[new]]
                may = ~(gaps > (bound + slack[mine]).max())  # a NaN stays in
                if filled[may].sum() < m / 2:
                    seen = np.flatnonzero(may[box])
            near = left[mine] @ (right if seen is None else right[:, seen])  # less the square of the test row
            if len(new) and near.shape[1] >= k:
                limit[new] = np.partition(near[new], k - 1, axis=1)[:, k - 1] + x2[mine][new] + slack[mine][new]
            row, col = np.nonzero(~(near > (limit + slack[mine] - x2[mine])[:, None]))  # a NaN stays in
            row, col = mine[row], col if seen is None else seen[col]
            d = np.zeros(len(row))
            for j in range(dims):  # summed in vector order
                diff = t[col, j] - x[row, j]
                d += diff * diff
            known = ~np.isnan(d)
            row, col, d = row[known], col[known], d[known]
            order = np.lexsort((col, d, row))
            row, col, d = row[order], col[order], d[order]
            first = np.searchsorted(row, row)
            kept = np.arange(len(row)) - first < k
            row, col, d = row[kept], col[kept], d[kept]
            for i, dist, key, y in zip(row.tolist(), d.tolist(), keys.take(pa.array(col)).to_pylist(), labels.take(pa.array(col)).to_pylist()):
                best[i].append((dist, key is None, key, y))
            for i in np.unique(row).tolist():
                best[i] = sorted(best[i], key=lambda found: found[:3])[:k]


def knn_classify(spark: SparkSession, train: DataFrame, test: DataFrame, key: str, vector: str,
                 label: str, k: int = 5, out: str = "predicted", batch_rows: int = 65536,
                 test_block: int = 64, task_rows: int = 32768) -> DataFrame:
    """M5: exact k-nearest-neighbour vote, Euclidean, uniform weights.

    The training side is written once (Parquet) to the shared checkpoint
    folder.  The test side is dealt by key over at least as many tasks as
    there are cores, about ``task_rows`` rows each at most; a task gathers
    blocks of up to ``2 * task_rows`` rows, and streams the training side
    back once for each block, about ``batch_rows`` rows at a time, with a
    running top-k per distinct test vector.  So memory per task is bounded,
    nothing passes through the driver, nothing is broadcast, and no (test,
    train) pair is ever a row.  Distances are squared differences summed as doubles
    in vector order; distance ties go to the lower training key, vote ties
    to the smaller label.  A matrix product tells which pairs can't be among
    the nearest (:func:`_add_nearest`); the work still grows with the product
    of both sides.  Spark lists the written files; pyarrow must be
    able to read their file system (local, ``hdfs://``, ``s3://``, ``gs://``).
    """
    from periodfact.session import scratch_path
    path = scratch_path(spark, "knn-train")
    (train.select(F.col(q(key)).alias("k"), F.col(q(vector)).cast("array<double>").alias("v"),
                  F.col(q(label)).alias("y"))
     .write.parquet(path))
    label_type = train.schema[label].dataType
    files = sorted(spark.read.parquet(path).inputFiles())
    test = test.select(F.col(q(key)).alias("k"), F.col(q(vector)).cast("array<double>").alias("v"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-test.count() // task_rows))

    def blocks(batches):
        held = []
        for pdf in batches:
            for at in range(0, len(pdf), task_rows):
                held.append(pdf.iloc[at:at + task_rows])
                if sum(map(len, held)) > task_rows:
                    yield pd.concat(held)
                    held = []
        if held:
            yield pd.concat(held)

    def gathered(batches):
        held = []
        for rb in batches:
            if rb.num_rows:
                held.append(rb)
            if sum(b.num_rows for b in held) >= batch_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def predict(batches):
        import pyarrow.dataset as ds
        import pyarrow.fs as pafs
        from urllib.parse import unquote, urlsplit
        if files and urlsplit(files[0]).scheme in ("", "file"):
            fs, paths = pafs.LocalFileSystem(), [unquote(urlsplit(f).path) for f in files]
        elif files:
            fs, paths = pafs.FileSystem.from_uri(files[0])[0], [pafs.FileSystem.from_uri(f)[1] for f in files]
        else:
            fs, paths = pafs.LocalFileSystem(), []
        data = ds.dataset(paths, format="parquet", filesystem=fs, schema=None if paths else pa.schema(
            [("k", pa.int64()), ("v", pa.list_(pa.float64())), ("y", pa.string())]))
        for pdf in blocks(batches):
            n = len(pdf)
            x = np.array([np.asarray(v, dtype=np.float64) for v in pdf["v"]]).reshape(n, -1)
            codes = _vector_codes(x)
            x = x[np.unique(codes, return_index=True)[1]]
            best: list = [[] for _ in range(len(x))]
            for chunk in gathered(data.to_batches(columns=["k", "v", "y"], batch_size=batch_rows)):
                keys, vectors, labels = (chunk.column(c).chunk(0) for c in ("k", "v", "y"))
                t = vectors.flatten().to_numpy(zero_copy_only=False).reshape(chunk.num_rows, -1)
                rows = _by_key(t, keys, k)
                if len(rows):
                    _add_nearest(best, x, t[rows], keys.take(pa.array(rows)), labels.take(pa.array(rows)), k, test_block)
            preds = []
            for found in best:
                if not found:
                    preds.append(None)
                    continue
                labels, votes = np.unique(np.asarray([y for *_, y in found]), return_counts=True)
                preds.append(labels[np.argmax(votes)].item())  # sorted: ties -> smaller
            yield pd.DataFrame({"k": pdf["k"], out: [preds[c] for c in codes]})

    schema = T.StructType([T.StructField("k", test.schema["k"].dataType),
                           T.StructField(out, label_type)])
    return test.repartition(tasks, "k").mapInPandas(predict, schema).withColumnRenamed("k", key)


# M7 M8 M9 ---------------------------------------------------------------------
def _per_class(pred: DataFrame, label: str, predicted: str) -> DataFrame:
    # one pass over the predictions: counts per (actual, predicted) pair, at
    # most classes^2 rows; each pair then counts once for its actual class
    # (support, tp) and once for its predicted class, in one aggregation
    pairs = pred.groupBy(F.col(q(label)).alias("a"), F.col(q(predicted)).alias("p")).count()
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("a").alias("class"), F.col("count").alias("support"),
                 F.when(F.col("a") == F.col("p"), F.col("count")).otherwise(zero).alias("tp"),
                 zero.alias("n_predicted")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), zero.alias("tp"),
                 F.col("count").alias("n_predicted")))
    per = (pairs.select(F.inline(sides)).groupBy("class")
           .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                F.sum("n_predicted").alias("n_predicted")))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_predicted").cast("double")),
                   F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")),
                   F.lit(0.0))
    per = per.withColumns({"precision": p, "recall": r})
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return per.withColumn("f1", f1)


def class_report(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """M9: per class precision, recall, F1 and support (0 where undefined)."""
    return _per_class(pred, label, predicted).select("class", "precision", "recall", "f1", "support")


def score(pred: DataFrame, label: str = "label", predicted: str = "predicted",
          scale: int | None = 6) -> DataFrame:
    """M7: accuracy and support-weighted precision, recall and F1, one row.

    Weighted means sum a few doubles; they are rounded to ``scale`` places so
    the result does not depend on the order classes are combined in.
    """
    rep = _per_class(pred, label, predicted)
    n = F.sum("support").cast("double")

    def w(c: str) -> Column:
        v = F.sum(F.col(c) * F.col("support")) / n
        return F.round(v, scale) if scale is not None else v

    acc = F.sum("tp").cast("double") / n
    return rep.agg(w("precision").alias("precision"), w("recall").alias("recall"),
                   w("f1").alias("f1"),
                   (F.round(acc, scale) if scale is not None else acc).alias("accuracy"))


def confusion(pred: DataFrame, classes: Sequence[str], label: str = "label",
              predicted: str = "predicted") -> DataFrame:
    """M8: counts of (actual, predicted), one column per listed class, zero-filled."""
    wide = (pred.groupBy(F.col(q(label)).alias("actual"))
            .pivot(predicted, list(classes)).count())
    return wide.select("actual", *[F.coalesce(F.col(q(c)), F.lit(0)).alias(c) for c in classes])


# M10 M11 M12 B2 ---------------------------------------------------------------
def split_and_balance(df: DataFrame, key: str, label: str, test_size: float, seed: int):
    """The reference's protocol: hold out, then oversample the train side only."""
    return splits(df, key, label, test_size, [seed])[seed]


def splits(df: DataFrame, key: str, label: str, test_size: float, seeds: Sequence[int]) -> dict[int, tuple[DataFrame, DataFrame]]:
    """seed -> (balanced train side, test side): the cuts of all seeds and classes take four reads together."""
    cuts = smallest_k_cuts(seeded_rows(df, key, seeds), _test_rows(test_size))
    sides = {s: cuts.get((str(s), 0), (0, None))[1] for s in seeds}
    left = _below_cuts(_with_seeds(df.select(key, label), key, seeds), {str(s): c for s, c in sides.items()}, key, below=False)
    hashed = left.select("seed", F.col(q(label)).alias("g"), F.col(q(key)).alias("k")).withColumn(
        HASH, F.md5(F.concat_ws("|", "seed", F.lit("os"), F.col("k").cast("string"))))
    classes = smallest_k_cuts(hashed, lambda n, m: m % n)
    out = {}
    for s, cut in sides.items():
        marked = df.withColumn(HASH, hash_key(F.col(q(key)), s)).withColumn("is_test", _within_cut(key, cut)).drop(HASH)
        mine = {g: c for (seed, g), c in classes.items() if seed == str(s)}
        train = _copied(marked.where(~F.col("is_test")), label, key, s, mine, "copy", MAX_COPIES_PER_TASK)
        out[s] = (train, marked.where(F.col("is_test")))
    return out


def seed_search(fit_and_score: Callable[[int], float], seeds: Sequence[int],
                parallelism: int = 8) -> tuple[int, list[tuple[int, float]]]:
    """Best seed by a score; ties go to the first (lowest) seed.

    Seeds run as concurrent Spark jobs from a thread pool; each one is a
    full distributed fit, the driver only gathers one number per seed.
    """
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(zip(seeds, pool.map(fit_and_score, seeds)))
    best = None
    for s, acc in results:
        if best is None or acc > best[1]:
            best = (s, acc)
    return best[0], results


def score_table(scores: dict[str, DataFrame]) -> DataFrame:
    """M12 (+B2): ``Model, Mean Precision, Mean Recall, Mean F1-Score, Mean Accuracy``.

    Each value is the mean over the repeats present in the model's frame.
    """
    frames = [s.withColumn("Model", F.lit(name)) for name, s in scores.items()]
    allr = frames[0]
    for f in frames[1:]:
        allr = allr.unionByName(f)
    return allr.groupBy("Model").agg(F.avg("precision").alias("Mean Precision"),
                                     F.avg("recall").alias("Mean Recall"),
                                     F.avg("f1").alias("Mean F1-Score"),
                                     F.avg("accuracy").alias("Mean Accuracy"))


def predict_scenarios(spark: SparkSession, models: dict, rows: Sequence[Sequence[float]],
                      feature_cols: Sequence[str], first_period: int) -> DataFrame:
    """M11 (+B2): predict hand-written feature rows as future periods."""
    data = [(first_period + i, *map(float, r)) for i, r in enumerate(rows)]
    schema = T.StructType([T.StructField("Year", T.IntegerType())] +
                          [T.StructField(c, T.DoubleType()) for c in feature_cols])
    scen = assemble_features(spark.createDataFrame(data, schema), feature_cols)
    out = None
    for name, model in models.items():
        p = model.transform(scen).select(F.lit(name).alias("Model"), "Year",
                                         F.col("predicted").alias("Prediction"))
        out = p if out is None else out.unionByName(p)
    return out
