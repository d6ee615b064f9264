"""Declared schemas, repeatable appends, sums of doubles that don't depend on order."""

import math
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from periodfact.functions import order_free_sum
from periodfact.operators import mean_by_period, row_total, sum_all_by_period
from periodfact.operators.contract import Contract, conform
from periodfact.plans.elections import FACT_TABLE, learn_from_fact
from periodfact.sinks import replace_facts

SMALL = Contract([("Year", "int"), ("Winner", "varchar(5)"), ("Share", "decimal(4,2)")])


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(2001, "Left", 12.345, 1), (2002, "Centrist", 1.5, 2), (2003, None, 100.0, 3)],
                                 "period int, winner string, share double, other int")


def test_conform_has_the_declared_columns(spark, rows):
    rejects = Observation("rejects")
    out = conform(rows, SMALL, {"Year": "period", "Winner": "winner", "Share": "share"}, rejects=rejects)
    assert out.dtypes == [("Year", "int"), ("Winner", "string"), ("Share", "decimal(4,2)")]
    got = [(r[0], r[1], None if r[2] is None else float(r[2])) for r in sorted(out.collect())]
    assert got == [(2001, "Left", 12.35), (2002, None, 1.5), (2003, None, None)]
    assert rejects.get == {"rows": 3, "Year": 0, "Winner": 1, "Share": 1}


def test_conform_fills_nothing_silently(spark, rows):
    with pytest.raises(ValueError, match="lacks.*Winner"):
        conform(rows.drop("winner"), SMALL, {"Year": "period", "Winner": "winner", "Share": "share"})
    with pytest.raises(ValueError, match="not in the contract"):
        conform(rows, SMALL, {"Years": "period"})
    given = conform(rows, SMALL, {"Year": "period", "Share": "share"}, {"Winner": F.lit("x")})
    assert {r["Winner"] for r in given.collect()} == {"x"}
    with pytest.raises(Exception, match="does not fit"):
        conform(rows, Contract(SMALL.columns, misfits="error"), {"Year": "period", "Winner": "winner", "Share": "share"}).collect()


def test_fact_table_has_29_columns():
    assert len(FACT_TABLE.names) == 29 and dict(FACT_TABLE.columns)["nombre_incivilite"] == "decimal(10,2)"


def test_a_fact_without_a_feature_fails(spark):
    fact = spark.createDataFrame([(2001, "f", "Left", 1.0)], "period int, family string, winner string, moyenne_ipc double")
    with pytest.raises(ValueError, match="lacks"):
        learn_from_fact(spark, fact)


def test_appending_twice_equals_once(spark, scratch):
    facts = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)], "family string, period int, v double")
    for _ in range(2):
        replace_facts(facts, f"{scratch}/facts")
    replace_facts(facts.where("family = 'a' AND period = 2").withColumn("v", F.lit(9.0)), f"{scratch}/facts")
    got = {(r["family"], r["period"]): r["v"] for r in spark.read.parquet(f"{scratch}/facts").collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 9.0, ("b", 1): 3.0} and spark.read.parquet(f"{scratch}/facts").count() == 3


def test_sums_have_the_same_bits_under_any_partitioning(spark):
    rng = random.Random(1)
    groups = {g: [rng.choice([-1, 1]) * rng.random() * 10 ** rng.choice([-8, -3, 0, 0, 2, 9, 15]) for _ in range(rng.randint(1, 200))] for g in range(30)}
    groups |= {100: [1e15, -1e15, -1e-9], 101: [-0.1] * 10, 102: [1e16, 1.0, -1e16], 103: [0.0], 104: [2.0**89, -2.0**89, 0.25], 105: [-1e-9]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "period int, v double")
    want = {g: math.fsum(vs) for g, vs in groups.items()}
    for parts in (1, 7, 211):
        dealt = df.repartition(parts, F.rand(parts))
        assert {r["period"]: r["v"] for r in sum_all_by_period(dealt).collect()} == want
        assert {r["period"]: r["row_total"] for r in row_total(dealt).collect()} == want
        assert {r["period"]: r["v"] for r in mean_by_period(dealt, ["v"], scale=None).collect()} == {g: want[g] / len(groups[g]) for g in want}


def test_sums_of_odd_values(spark):
    df = spark.createDataFrame([(1, None), (2, math.inf), (2, 1.0), (3, math.nan), (4, math.inf), (4, -math.inf), (5, None), (5, 2.5)], "g int, v double")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(order_free_sum("v").alias("s")).collect()}
    assert got[1] is None and got[2] == math.inf and math.isnan(got[3]) and math.isnan(got[4]) and got[5] == 2.5
