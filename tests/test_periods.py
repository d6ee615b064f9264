import pytest
from pyspark.sql import functions as F

from periodfact.operators import (global_mean, lag_change, mean_by_period, measure_gap,
                                  round_columns, row_total, safe_names, spine_join,
                                  strip_agg_names, sum_all_by_period)


def test_mean_by_period_hand_checked(spark):
    # four quarters of 1990: minimum-wage and price indices
    rows = [(1990, "T4", 106.79, 102.34), (1990, "T3", 104.58, 102.11),
            (1990, "T2", 102.01, 100.70), (1990, "T1", 100.00, 100.00)]
    df = spark.createDataFrame(rows, "period int, q string, wage double, price double")
    r = mean_by_period(df, ["wage", "price"]).first()
    assert (r.wage, r.price) == (103.35, 101.29)
    g = measure_gap(mean_by_period(df, ["wage", "price"]), "wage", "price", "gap").first().gap
    assert g == pytest.approx(2.06)


def test_sum_all_excludes_period_and_keeps_names(spark):
    df = spark.createDataFrame([(2012, 1, 2.5), (2012, 2, 0.5), (2013, 4, None)],
                               "period int, a int, b double")
    out = {r.period: r for r in sum_all_by_period(df).collect()}
    assert sum_all_by_period(df).columns == ["period", "a", "b"]
    assert (out[2012].a, out[2012].b, out[2013].b) == (3.0, 3.0, None)


def test_row_total_treats_null_as_zero(spark):
    df = spark.createDataFrame([(2012, 1.0, None), (2012, 2.0, 3.0)], "period int, a double, b double")
    assert row_total(df).first().row_total == 6.0


def test_lag_change_and_global_mean(spark):
    df = spark.createDataFrame([(2001, 100.0), (2002, 110.0), (2003, 99.0)], "period int, m double")
    ch = lag_change(df, ["m"], per_period=True).orderBy("period").collect()
    assert [r.m_change for r in ch] == [None, 10.0, -10.0]
    assert global_mean(lag_change(df, ["m"], per_period=True), {"g": "m_change"}).first().g == 0.0
    with pytest.raises(ValueError):
        lag_change(df, ["m"])


def test_spine_join_keeps_base_periods(spark):
    base = spark.createDataFrame([(y, float(y)) for y in range(1990, 1995)], "period int, a double")
    part = spark.createDataFrame([(1991, 1.0), (1993, 3.0), (2020, 9.0)], "period int, b double")
    out = spine_join(base, [part]).orderBy("period").collect()
    assert len(out) == 5 and [r.b for r in out] == [None, 1.0, None, 3.0, None]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 1.234)], "period int, x double").groupBy("period").agg(F.sum("x"))
    assert strip_agg_names(df).columns == ["period", "x"]
    assert round_columns(strip_agg_names(df), ["x"]).first().x == 1.23
    long = "x" * 70
    assert safe_names([long, long[:60] + "y" * 10, "short"]) == [long[:54], long[:54] + "_1", "short"]


def test_to_decimal_overflow_is_null_not_a_failure(spark):
    from periodfact.operators import to_decimal
    df = spark.createDataFrame([(12.345,), (123456789.0,), (None,)], "x double")
    got = [r.x for r in to_decimal(df, ["x"]).collect()]
    assert [None if g is None else float(g) for g in got] == [12.35, None, None]


def test_a_fact_fails_on_a_value_that_does_not_fit(spark):
    import pytest

    from periodfact.operators import assemble_fact
    df = spark.createDataFrame([(2001, "A", 12.345, None), (2002, "B", 123456789.0, 1.0)],
                               "period int, winner string, share_a double, total double")
    fact = assemble_fact(df, None, None, None, share_cols=["share_a"], total_cols=["total"])
    assert float(fact.where("period = 2001").first().share_a) == 12.35
    with pytest.raises(Exception, match="share_a does not fit"):
        fact.collect()


def test_filter_period_is_an_inclusive_year_range(spark):
    import datetime as dt

    from periodfact.operators import filter_period
    rows = [(dt.datetime(y, m, 1),) for y in (1995, 1996, 1997, 1998) for m in (1, 12)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert sorted({r.ts.year for r in filter_period(df, "ts", 1996, 1997).collect()}) == [1996, 1997]
    assert filter_period(df, "ts", 1998).count() == 2
