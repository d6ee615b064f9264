from pyspark.sql import functions as F

from periodfact import functions as PF


def test_parse_locale_number(spark):
    rows = [("5 315",), ("16,0",), ("252.65",), ("n/a",), (None,), ("1 234,5",), ("-0.3",), ("2",)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(PF.parse_locale_number("t").alias("v"), PF.is_rejected_number("t").alias("r")).collect()
    assert [r.v for r in out] == [5315.0, 16.0, 252.65, None, None, 1234.5, -0.3, 2.0]
    assert [r.r for r in out] == [False, False, False, True, False, False, False, False]


def test_parse_keeps_whole_numbers(spark):
    df = spark.createDataFrame([(2,), (7,)], "n int")
    assert [r.v for r in df.select(PF.parse_locale_number("n").alias("v")).collect()] == [2.0, 7.0]


def test_period_from_code(spark):
    df = spark.createDataFrame([("_2012_01",), ("_n/a_01",), (None,)], "c string")
    assert [r.p for r in df.select(PF.period_from_code("c").alias("p")).collect()] == [2012, None, None]


def test_percent_change_zero_divisor(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "a double, b double")
    got = [r.c for r in df.select(PF.percent_change("a", "b").alias("c")).collect()]
    assert got == [10.0, None, None]


def test_normalise_label(spark):
    rows = [("Extreme Gauche",), ("extreme  gauche ",), ("Gauche Radical",), ("Ecologie",), ("autre chose",)]
    df = spark.createDataFrame(rows, "l string")
    canon = ["Extreme gauche", "Gauche radicale", "Ecologie"]
    got = [r.n for r in df.select(PF.normalise_label("l", canon, {"Gauche Radical": "Gauche radicale"})
                                  .alias("n")).collect()]
    assert got == ["Extreme gauche", "Extreme gauche", "Gauche radicale", "Ecologie", "Autre Chose"]


def test_strip_prefix_and_casefold(spark):
    df = spark.createDataFrame([("LDVD", " Tranche  Age ")], "c string, t string")
    r = df.select(PF.strip_prefix("c").alias("s"), PF.casefold_key("t").alias("k")).first()
    assert (r.s, r.k) == ("DVD", "tranche age")


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 50
    a = spark.createDataFrame(vals, "x double").repartition(7)
    b = spark.createDataFrame(list(reversed(vals)), "x double").coalesce(1)
    sa = a.agg(PF.exact_sum("x").cast("double").alias("s")).first().s
    sb = b.agg(PF.exact_sum("x").cast("double").alias("s")).first().s
    assert sa == sb == 30.0
    assert a.agg(F.round(PF.exact_mean("x"), 2).alias("m")).first().m == 0.2
