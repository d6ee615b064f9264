import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from periodfact.operators import learn as L


def test_holdout_exact_disjoint_reproducible(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    a = L.holdout(df.repartition(7), "key", 0.4, seed=3)
    b = L.holdout(df.coalesce(1), "key", 0.4, seed=3)
    ta = {r.key for r in a.where("is_test").collect()}
    tb = {r.key for r in b.where("is_test").collect()}
    assert len(ta) == 400 and ta == tb
    assert a.where("not is_test").count() == 600


@pytest.mark.parametrize("digits", [1, 3])
def test_cut_refinement_with_small_boundary(spark, monkeypatch, digits):
    monkeypatch.setattr(L, "HEX_DIGITS", digits)
    monkeypatch.setattr(L, "MAX_BOUNDARY_ROWS", 1000 * (digits % 3))  # 1: on the driver, 3: ranked in Spark
    df = spark.range(5000).withColumnRenamed("id", "key")
    h = L.holdout(df, "key", 1234, seed=1)
    assert h.where("is_test").count() == 1234
    ref = sorted(df.select("key", F.md5(F.concat_ws("|", F.lit("1"), F.col("key").cast("string"))).alias("h"))
                 .collect(), key=lambda r: (r.h, r.key))[:1234]
    assert {r.key for r in ref} == {r.key for r in h.where("is_test").collect()}


def test_oversample_balances_and_keeps_originals(spark):
    rows = [(i, "a" if i < 70 else ("b" if i < 90 else "c")) for i in range(100)]
    df = spark.createDataFrame(rows, "key long, y string")
    o = L.oversample(df, "y", "key", seed=5)
    counts = {r.y: r["count"] for r in o.groupBy("y").count().collect()}
    assert counts == {"a": 70, "b": 70, "c": 70}
    assert o.select("key").distinct().count() == 100


def test_oversample_with_a_null_class(spark):
    rows = [(i, None if i < 3 else ("a" if i < 50 else "b")) for i in range(60)]
    o = L.oversample(spark.createDataFrame(rows, "key long, y string"), "y", "key", seed=2)
    counts = {r.y: r["count"] for r in o.groupBy("y").count().collect()}
    assert counts == {None: 47, "a": 47, "b": 47}


def test_oversample_spreads_huge_copy_counts(spark):
    rows = [(i, "a" if i < 95 else "b") for i in range(100)]
    df = spark.createDataFrame(rows, "key long, y string")
    o = L.oversample(df, "y", "key", seed=5, max_copies_per_task=4)
    counts = {r.y: r["count"] for r in o.groupBy("y").count().collect()}
    assert counts == {"a": 95, "b": 95}
    per_key = {r.key: r["count"] for r in o.where("y = 'b'").groupBy("key").count().collect()}
    assert sorted(per_key.values()) == [19] * 5
    assert o.where("y = 'b'").select("key", "copy").distinct().count() == 95


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    tr = rng.normal(size=(60, 4)).round(3)
    te = rng.normal(size=(15, 4)).round(3)
    ytr = rng.integers(0, 3, 60)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(ytr[i])) for i in range(60)],
                                  "id long, v array<double>, y int")
    test = spark.createDataFrame([(100 + i, te[i].tolist()) for i in range(15)], "id long, v array<double>")
    got = {r.id: r.predicted for r in L.knn_classify(spark, train, test, "id", "v", "y", k=5).collect()}
    for i in range(15):
        d = ((tr - te[i]) ** 2).sum(axis=1)
        near = np.lexsort((np.arange(60), d))[:5]
        labels, votes = np.unique(ytr[near], return_counts=True)
        assert got[100 + i] == labels[np.argmax(votes)]


def test_scores_hand_computed(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    pred = spark.createDataFrame(rows, "label string, predicted string")
    rep = {r["class"]: r for r in L.class_report(pred).collect()}
    assert rep["a"].precision == 0.5 and rep["a"].recall == 0.5
    assert rep["b"].precision == pytest.approx(2 / 3) and rep["b"].recall == 1.0
    assert rep["c"].precision == 0.0 and rep["c"].f1 == 0.0
    s = L.score(pred).first()
    assert s.accuracy == 0.6
    assert s.precision == pytest.approx(round((2 * 0.5 + 2 * 2 / 3 + 0) / 5, 6))
    conf = {r.actual: (r.a, r.b, r.c) for r in L.confusion(pred, ["a", "b", "c"]).collect()}
    assert conf == {"a": (1, 1, 0), "b": (0, 2, 0), "c": (1, 0, 0)}


def test_seed_search_first_best_wins():
    best, res = L.seed_search(lambda s: {0: 0.5, 1: 0.9, 2: 0.9}[s], [0, 1, 2], parallelism=2)
    assert best == 1 and len(res) == 3


def test_many_seeds_cut_like_one_and_read_thrice(spark):
    rows = [(i, ["a", "b", "b", "c", "c", "c", None][i % 7]) for i in range(700)]
    df = spark.createDataFrame(rows, "key long, y string")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    seeds = list(range(50))
    tests = L.seeded_holdout(df.mapInPandas(counted, "key long, y string"), "key", 0.2, seeds)
    got = {}
    for r in tests.collect():
        got.setdefault(int(r.seed), set()).add(r.key)
    assert seen.value <= 3 * 700
    for s in (0, 17, 49):
        assert got[s] == {r.key for r in L.holdout(df, "key", 0.2, s).where("is_test").collect()} and len(got[s]) == 140
    sides = L.splits(df, "key", "y", 0.2, seeds[:4])
    for s, (train, test) in sides.items():
        assert {r.key for r in test.collect()} == got[s]
        counts = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
        assert len(set(counts.values())) == 1 and len(counts) == 4
        one = L.oversample(L.holdout(df, "key", 0.2, s).where("not is_test"), "y", "key", s)
        assert sorted((r.key, r.copy) for r in train.select("key", "copy").collect()) == sorted((r.key, r.copy) for r in one.select("key", "copy").collect())


def test_holdout_of_nothing_and_of_all(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "key long")
    assert L.holdout(df.where("key < 0"), "key", 0.5).count() == 0
    for size, n in ((0, 0), (10, 10), (99, 10), (1.0, 10), (0.0, 0)):
        assert L.holdout(df, "key", size).where("is_test").count() == n


def test_pair_votes_break_ties_by_the_list(spark):
    rows = [("a", "a", "b"), ("b", "c", "b"), ("a", "c", "b"), (None, None, "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "ab string, ac string, bc string")
    out = L.pair_votes(df, ["a", "b", "c"], {("a", "b"): "ab", ("a", "c"): "ac", ("b", "c"): "bc"})
    assert [r.predicted for r in out.collect()] == ["a", "b", "a", "c", "a"]


def test_models_learn_more_than_the_split(spark):
    """Accuracy floors of forest and both SVMs on held-out documents, far above the largest class."""
    from periodfact.plans import learning as P
    train, test = P._split(spark, "/root/testdata/sf0.001", 42, 0.4)
    train, test = train.cache(), test.cache()
    largest = max(r["count"] for r in test.groupBy("lang").count().collect()) / test.count()
    for fit, floor in ((L.fit_forest, 0.9), (L.fit_pairwise_svm, 0.8), (L.fit_linear_svm, 0.8)):
        pred = fit(train, "lang").transform(test).select(F.col("lang").alias("label"), "predicted")
        accuracy = L.score(pred).first()["accuracy"]
        assert accuracy >= floor > largest, (fit.__name__, accuracy, largest)


def test_forest_grows_on_counts_of_alike_rows(spark, monkeypatch):
    """Many rows of few kinds: counted trees, the same for any partitions, that say what pyspark.ml's forest says."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 6, 8000), rng.choice([0.0, 0.0, 0.5, 2.5, 9.0], 8000), rng.integers(0, 2, 8000)]).astype(float)
    y = np.where(x[:, 0] > 3, "b", np.where(x[:, 1] > 1, "c", "a"))
    y = np.where(rng.random(8000) < 0.05, "b", y)
    rows = [(i, *map(float, x[i]), str(y[i]) if i % 400 else None) for i in range(8000)]
    df = L.assemble_features(spark.createDataFrame(rows, "id long, u double, v double, w double, y string"), ["u", "v", "w"])
    said = []
    for train in (df.repartition(7), df.coalesce(1)):
        model = L.fit_forest(train, "y", seed=3)
        assert len(model.trees) == 100 and max(len(t[0]) for t in model.trees) < 200
        said.append({r.id: r.predicted for r in model.transform(df).select("id", "predicted").collect()})
    assert said[0] == said[1]
    monkeypatch.setattr(L, "MAX_GROUPS", 0)
    known = df.where("y is not null")
    other = {r.id: r.predicted for r in L.fit_forest(known, "y", seed=3).transform(known).select("id", "predicted").collect()}
    assert sum(said[0][i] == p for i, p in other.items()) > 0.99 * len(other)


def test_tree_on_counts_splits_where_gini_falls_most():
    x = np.array([[0, 1], [1, 0], [2, 1], [3, 0]])
    feature, end, left, share = L._grow_tree(x[:, :1], np.array([0, 0, 1, 1]), np.array([500, 400, 300, 200]), 4, 2, 12, np.random.default_rng(1))
    assert feature.tolist() == [0, -1, -1] and end[0] == 1 and left[0] == 1 and share[1:].tolist() == [[1.0, 0.0], [0.0, 1.0]]
    assert L._bin_ends(np.array([0.0] * 60 + list(range(1, 41))))[0] == 0.0


def test_models_predict_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    spark.range(3).observe(Observation("seen"), F.count("*").alias("n")).collect()
    train = spark.createDataFrame([(Vectors.dense([float(i), float(i % 3)]), "low" if i < 20 else "high") for i in range(40)], ["v", "y"])
    for fit in (L.fit_linear_svm, L.fit_pairwise_svm):
        assert fit(train, "y", "v").transform(train).where("predicted = y").count() >= 36
    forest = L.RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=3, seed=1)
    assert L._with_labels(forest, "y").fit(train).transform(train).where("predicted = y").count() >= 36
