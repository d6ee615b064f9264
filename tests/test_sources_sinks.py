from pyspark.sql import functions as F

from periodfact.operators import union_families
from periodfact.sinks import append_facts, save_results, save_table
from periodfact.sources import read_delimited, read_sources, read_store, reject_report, rejected_rows

INDICATOR = """Annee;Femmes;Hommes;Tranche age
2007;16,0;9,2;14-29 ans
2007;13,7;7,9;75 ans et plus 
2008;5 315;1,5;Ensemble
"""


def test_read_delimited_with_and_without_schema(spark, scratch):
    p = f"{scratch}/ind.csv"
    with open(p, "w", encoding="utf-8") as f:
        f.write(INDICATOR + "\n\n")
    inferred = read_delimited(spark, p)
    assert inferred.count() == 3 and inferred.columns[0] == "Annee"
    typed = read_delimited(spark, p, "Annee int, Femmes string, Hommes string, Tranche string",
                           keep_corrupt=True)
    assert reject_report(typed).first().rejected == 0
    with open(p, "a", encoding="utf-8") as f:
        f.write("not-a-year;1;2;x\n")
    assert [r.Femmes for r in rejected_rows(read_delimited(
        spark, p, "Annee int, Femmes string, Hommes string, Tranche string", keep_corrupt=True))
        .collect()] == ["1"]
    rep = reject_report(read_delimited(spark, p, "Annee int, Femmes string, Hommes string, Tranche string",
                                       keep_corrupt=True)).first()
    assert (rep.rows, rep.rejected) == (4, 1)
    assert typed.where(F.col("Tranche") == "75 ans et plus ").count() == 1  # blank kept
    srcs = read_sources(spark, {"a": p, "b": (p, "Annee int, F string, H string, T string")})
    assert srcs["b"].columns == ["Annee", "F", "H", "T"]


def test_parquet_sinks_round_trip(spark, scratch):
    a = spark.createDataFrame([(2012, 1.5)], "period int, v double")
    b = spark.createDataFrame([(2012, 2.5)], "period int, v double")
    facts = union_families({"presidential": a, "legislative": b})
    target = f"{scratch}/fact"
    append_facts(facts, target)
    append_facts(facts, target)
    back = read_store(spark, target)
    assert back.count() == 4 and set(r.family for r in back.collect()) == {"presidential", "legislative"}
    save_table(facts, target)  # overwrite
    assert read_store(spark, target).count() == 2


def test_save_results_replaces_tables(spark, scratch):
    scores = spark.createDataFrame([("Random Forest", 0.9, 0.8, 0.85, 0.9)],
                                   "Model string, `Mean Precision` double, `Mean Recall` double, "
                                   "`Mean F1-Score` double, `Mean Accuracy` double")
    preds = spark.createDataFrame([("Random Forest", 2025, "fr")], "Model string, Year int, Prediction string")
    save_results(scores, preds, scratch)
    save_results(scores, preds, scratch)
    assert read_store(spark, f"{scratch}/model_scores").count() == 1
    assert read_store(spark, f"{scratch}/future_predictions").first().Prediction == "fr"
