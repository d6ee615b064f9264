"""Learning plans on the driver tables.

The target is the document language, which is learnable from the rate of
language-specific letters in the whole text; ``embeddings`` drives KNN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodfact.operators import learn as L
from periodfact.plans.tables import read

# Letters marking a language (counted over the whole text).
MARKERS = {"fr": "[éèêàçùœ]", "de": "[äöüß]", "es": "[ñ¿¡áíóú]"}
# The class list of the language target, alphabetical.
LANGS = ["de", "en", "es", "fr"]
FEATURES = ["fr_rate", "de_rate", "es_rate", "quality", "toxic"]
SEED, TEST_SIZE, FINAL_TEST_SIZE = 42, 0.2, 0.4
N_SEEDS = 50
# Hand-written scenario rows (fr_rate, de_rate, es_rate, quality, toxic).
SCENARIOS = [[12.0, 0.5, 1.0, 1, 0], [0.2, 9.0, 0.1, 1, 0], [0.0, 0.0, 0.0, 0, 1]]


def marks(text: str = "text") -> dict:
    return {f"{lang}_marks": F.regexp_count(F.col(text), F.lit(p)) for lang, p in MARKERS.items()}


def doc_features(spark: SparkSession, sf: str) -> DataFrame:
    """M1 (+P6, X8): documents left join labels, letter counts, nulls -> 0."""
    d = read(spark, sf, "documents").select(  # counted before the join: no text is shuffled
        "doc_id", "lang", "n_chars", *[c.alias(name) for name, c in marks().items()])
    lab = read(spark, sf, "labels").select("doc_id", "quality", "toxic")
    d = d.join(lab, "doc_id", "left")
    d = L.fill_missing(d, ["quality", "toxic"], 0)
    size = F.greatest(F.col("n_chars"), F.lit(1)).cast("double")
    return d.withColumns({f"{lang}_rate": F.col(f"{lang}_marks") * F.lit(1000.0) / size
                          for lang in MARKERS})


def q_features_filled(spark: SparkSession, sf: str) -> DataFrame:
    f = doc_features(spark, sf)
    idx = L.label_indexer("lang", "label_index").fit(f)
    return idx.transform(f).select("doc_id", "lang", "n_chars", "quality", "toxic",
                                   "fr_marks", "de_marks", "es_marks", "label_index")


def q_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return L.holdout(read(spark, sf, "labels"), "doc_id", TEST_SIZE, SEED).select("doc_id", "is_test")


def _balanced_labels(spark: SparkSession, sf: str) -> DataFrame:
    h = L.holdout(read(spark, sf, "labels"), "doc_id", TEST_SIZE, SEED)
    return L.oversample(h.where(~F.col("is_test")), "quality", "doc_id", SEED)


def q_oversample_counts(spark: SparkSession, sf: str) -> DataFrame:
    o = _balanced_labels(spark, sf)
    return o.groupBy("quality").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_distinct("doc_id").alias("n_original"))


def q_oversample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _balanced_labels(spark, sf).groupBy("doc_id", "quality").agg(
        F.count(F.lit(1)).alias("copies"))


def q_knn_predict(spark: SparkSession, sf: str) -> DataFrame:
    e = L.holdout(read(spark, sf, "embeddings"), "vec_id", TEST_SIZE, SEED)
    train = e.where(~F.col("is_test"))
    test = e.where(F.col("is_test"))
    return L.knn_classify(spark, train, test, "vec_id", "embedding", "label", k=5)


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed rule: the language whose marker letters are most frequent, else English."""
    d = read(spark, sf, "documents").select("doc_id", "lang", "text").withColumns(marks())
    fr, de, es = F.col("fr_marks"), F.col("de_marks"), F.col("es_marks")
    pred = (F.when((fr >= de) & (fr >= es) & (fr > 0), "fr")
            .when((de >= es) & (de > 0), "de")
            .when(es > 0, "es").otherwise("en"))
    return d.select("doc_id", F.col("lang").alias("label"), pred.alias("predicted"))


def q_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    return L.score(rule_predictions(spark, sf))


def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return L.confusion(rule_predictions(spark, sf), LANGS)


def q_class_report(spark: SparkSession, sf: str) -> DataFrame:
    return L.class_report(rule_predictions(spark, sf))


# M10 M11 M12 B2 with scorers that SQL can follow ------------------------------
RULE_SEEDS = N_SEEDS


def q_seed_search_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of the fixed rule on each of 50 seeds' hold-outs, first best marked; three reads for all seeds."""
    from periodfact.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    data = rule_predictions(spark, sf).checkpoint()
    tests = L.seeded_holdout(data, "doc_id", FINAL_TEST_SIZE, list(range(RULE_SEEDS)))
    hits = tests.groupBy(F.col("seed").cast("int").alias("seed")).agg(
        F.round(F.count_if(F.col("label") == F.col("predicted")) / F.count("*"), 6).alias("accuracy"))
    best = F.min_by("seed", F.struct(-F.col("accuracy"), F.col("seed"))).over(Window.partitionBy())  # a row for each seed
    return hits.withColumn("is_best", F.col("seed") == best)


def q_pairwise_votes(spark: SparkSession, sf: str) -> DataFrame:
    """M6: for each pair of languages the one with more marker letters, and the vote of all pairs."""
    d = read(spark, sf, "documents").select("doc_id", "text").withColumns(marks()).withColumn("en_marks", F.lit(0))
    pairs = {(a, b): f"{a}_{b}" for i, a in enumerate(LANGS) for b in LANGS[i + 1:]}
    for (a, b), name in pairs.items():
        d = d.withColumn(name, F.when(F.col(f"{a}_marks") >= F.col(f"{b}_marks"), a).otherwise(b))
    return L.pair_votes(d, LANGS, pairs).select("doc_id", *pairs.values(), "predicted")


def q_scenario_models(spark: SparkSession, sf: str) -> DataFrame:
    """The scenario rows by two models, KNN and the marker rule, united."""
    train = L.assemble_features(doc_features(spark, sf).select("doc_id", "lang", *FEATURES), FEATURES)
    models = {"K-Nearest Neighbors": _Knn(spark, train, "doc_id", "lang"), "Marker Rule": _Rates()}
    return L.predict_scenarios(spark, models, SCENARIOS, FEATURES, 2025)


class _Rates:
    """The marker rule on features: the language of the highest rate, else English."""

    def transform(self, df: DataFrame) -> DataFrame:
        fr, de, es = F.col("fr_rate"), F.col("de_rate"), F.col("es_rate")
        return df.withColumn("predicted", F.when((fr >= de) & (fr >= es) & (fr > 0), "fr").when((de >= es) & (de > 0), "de")
                             .when(es > 0, "es").otherwise("en"))


def q_score_table_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The marker rule and an always-English baseline, one row each."""
    rule = rule_predictions(spark, sf)
    return L.score_table({"Marker Rule": L.score(rule),
                          "Always English": L.score(rule.withColumn("predicted", F.lit("en")))})


def q_scenario_knn(spark: SparkSession, sf: str) -> DataFrame:
    """The scenario rows predicted from all documents' features by KNN."""
    train = L.assemble_features(doc_features(spark, sf).select("doc_id", "lang", *FEATURES), FEATURES)
    models = {"K-Nearest Neighbors": _Knn(spark, train, "doc_id", "lang")}
    return L.predict_scenarios(spark, models, SCENARIOS, FEATURES, 2025)


def _listed(fit, spark: SparkSession, sf: str) -> DataFrame:
    """Per class of the test side: its rows, and those predicted as a listed class."""
    train, test = _split(spark, sf, SEED, FINAL_TEST_SIZE)
    return fit(train, "lang").transform(test).groupBy("lang").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("predicted").isin(LANGS)).alias("n_listed"))


def q_forest_support(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(L.fit_forest, spark, sf)


def q_svm_support(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(L.fit_linear_svm, spark, sf)


# Model fitting (no SQL equivalent: rows-only checks) --------------------------
def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows written once to the checkpoint folder: the regex scans of
    whole texts run once, and every fit reads the stored rows (lineage cut,
    so a lost executor re-reads the checkpoint instead of re-scanning)."""
    from periodfact.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    cols = ["doc_id", "lang", *FEATURES]
    return L.assemble_features(doc_features(spark, sf).select(*cols).checkpoint(), FEATURES)


def _split(spark: SparkSession, sf: str, seed: int, test_size: float):
    return L.split_and_balance(_prepared(spark, sf), "doc_id", "lang", test_size, seed)


class _Knn:
    """KNN behind the same ``transform`` as the fitted pyspark.ml models."""

    def __init__(self, spark: SparkSession, train: DataFrame, key: str, label: str):
        self.spark, self.key, self.label = spark, key, label
        self.train = train.select(key, vector_array("features").alias("vec"), label)

    def transform(self, df: DataFrame) -> DataFrame:
        key = self.key if self.key in df.columns else "Year"
        test = df.select(F.col(key).alias(self.key), vector_array("features").alias("vec"))
        pred = L.knn_classify(self.spark, self.train, test, self.key, "vec", self.label)
        return df.join(pred.withColumnRenamed(self.key, key), key)


def vector_array(c: str):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(c))


def model_report(spark: SparkSession, data: DataFrame, key: str, label: str, features: list[str],
                 seed: int = SEED, test_size: float = FINAL_TEST_SIZE,
                 scenarios: list | None = None, first_period: int = 2025):
    """The reference's learning protocol on any table, as Spark jobs.

    Hold out ``test_size`` by hash order, oversample the train side, fit a
    forest, KNN and a linear SVM, score them on the test side (M12 score
    table) and predict the scenario rows as future periods (M11).
    Returns ``(scores, predictions)``; predictions is None without scenarios.
    """
    prepared = data if "features" in data.columns else L.assemble_features(data, features)
    train, test = L.split_and_balance(prepared, key, label, test_size, seed)
    models = {"Random Forest": L.fit_forest(train, label, seed=seed),
              "K-Nearest Neighbors": _Knn(spark, train, key, label),
              "Support Vector Machine": L.fit_pairwise_svm(train, label)}
    scores = L.score_table({name: L.score(m.transform(test).select(
        F.col(label).alias("label"), "predicted")) for name, m in models.items()})
    preds = (L.predict_scenarios(spark, models, scenarios, features, first_period)
             if scenarios else None)
    return scores, preds


def learning_protocol(spark: SparkSession, data: DataFrame, key: str, label: str, features: list[str],
                      seeds: Sequence[int] = tuple(range(N_SEEDS)), scenarios: list | None = None, first_period: int = 2025) -> dict:
    """The whole protocol: a first report on a small hold-out, the seed whose forest scores best on the large one (the
    cuts of all seeds from four reads), and the report and scenario predictions of that seed.

    Returns ``first`` and ``final`` score tables, ``seed``, ``accuracies`` by seed and ``predictions`` (None without scenarios).
    """
    from periodfact.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    prepared = L.assemble_features(data.select(key, label, *features).checkpoint(), features)
    first, _ = model_report(spark, prepared, key, label, features, SEED, TEST_SIZE)
    sides = L.splits(prepared, key, label, FINAL_TEST_SIZE, list(seeds))

    def accuracy(seed: int) -> float:
        train, test = sides[seed]
        pred = L.fit_forest(train, label, seed=seed).transform(test)
        return L.score(pred.select(F.col(label).alias("label"), "predicted")).first()["accuracy"]

    best, accuracies = L.seed_search(accuracy, list(seeds))
    final, predictions = model_report(spark, prepared, key, label, features, best, FINAL_TEST_SIZE, scenarios, first_period)
    return {"first": first, "seed": best, "accuracies": dict(accuracies), "final": final, "predictions": predictions}


def fitted_models(spark: SparkSession, sf: str, seed: int = SEED, test_size: float = FINAL_TEST_SIZE):
    train, test = _split(spark, sf, seed, test_size)
    return {"Random Forest": L.fit_forest(train, "lang", seed=seed),
            "K-Nearest Neighbors": _Knn(spark, train, "doc_id", "lang"),
            "Support Vector Machine": L.fit_pairwise_svm(train, "lang")}, test


def _scores(model, test: DataFrame) -> DataFrame:
    return L.score(model.transform(test).select(F.col("lang").alias("label"), "predicted"))


def q_forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf, SEED, FINAL_TEST_SIZE)
    return _scores(L.fit_forest(train, "lang", seed=SEED), test)


def q_svm_scores(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf, SEED, FINAL_TEST_SIZE)
    return _scores(L.fit_linear_svm(train, "lang"), test)


def q_score_table(spark: SparkSession, sf: str) -> DataFrame:
    return model_report(spark, _prepared(spark, sf), "doc_id", "lang", FEATURES)[0]


def q_scenario_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return model_report(spark, _prepared(spark, sf), "doc_id", "lang", FEATURES,
                        scenarios=SCENARIOS)[1]


def q_seed_search(spark: SparkSession, sf: str) -> DataFrame:
    sides = L.splits(_prepared(spark, sf), "doc_id", "lang", FINAL_TEST_SIZE, list(range(N_SEEDS)))

    def accuracy(seed: int) -> float:
        train, test = sides[seed]
        return _scores(L.fit_forest(train, "lang", seed=seed), test).first()["accuracy"]

    best, results = L.seed_search(accuracy, list(range(N_SEEDS)))
    return spark.createDataFrame([(s, float(a), s == best) for s, a in results],
                                 "seed int, accuracy double, is_best boolean")


def queries() -> dict:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
