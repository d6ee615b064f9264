"""Files of one family that differ by year in width and in the place of the total; lookups with blank keys and ties."""

import pytest

from periodfact.operators.fact import spine_join
from periodfact.operators.periods import mean_by_period, row_total, sum_all_by_period
from periodfact.operators.reshape import BlockLayout
from periodfact.operators.tally import first_by_key, lookup_first
from periodfact.plans.families import Family, Lookup, _lookup_frame, family_fact


def write(path, header, row):
    path.write_text(";".join(header) + "\n" + ";".join(map(str, row)) + "\n")


def blocks(votes):
    return [x for code, n in votes for x in (code, n)]


@pytest.fixture
def family(tmp_path):
    lists = [(f"L{k}", 1) for k in range(120)] + [("BIG", 1000)]
    write(tmp_path / "res_1998.csv", ["a", "Total", "b", "code", "votes", "code", "votes"], ["x", 100, 0, *blocks([("L1", 60), ("BIG", 40)])])
    write(tmp_path / "res_2004.csv", ["a", "Total", "b", "code", "votes", "code", "votes"], ["x", 10, 0, *blocks([("L1", 4), ("??", 6)])])
    write(tmp_path / "res_2019.csv", ["a", "c", "Total"] + ["code", "votes"] * len(lists), ["x", 7, 1120, *blocks(lists)])
    (tmp_path / "codes.csv").write_text("code;cat\n" + "".join(f"L{k};Left\n" for k in range(120)) + "BIG;Right\n;Right\nL1;Right\n")
    return Family("f", f"{tmp_path}/res_*.csv", r"_(\d{4})\.csv", n_cols=None, total_col="Total",
                  layouts=[(None, BlockLayout(start=3, step=2, fields={"code": 0, "votes": 1}, key=("code",)))],
                  item=["code"], lookups=[Lookup(f"{tmp_path}/codes.csv", key=[0], value=1, n_cols=2)])


def test_each_header_gives_its_width_and_total(spark, family):
    rows = {r["period"]: r for r in family_fact(spark, family, ["Left", "Right"]).collect()}
    assert (rows[1998]["total"], rows[1998]["share_left"], rows[1998]["share_right"]) == (100, 60, 40)
    assert rows[2019]["winner"] == "Right" and rows[2019]["share_right"] == pytest.approx(89.29, abs=0.01)


def test_blank_lookup_key_takes_no_miss(spark, family):
    rows = {r["period"]: r for r in family_fact(spark, family, ["Left", "Right"]).collect()}
    assert (rows[2004]["share_left"], rows[2004]["share_right"], rows[2004]["winner"]) == (40, 0, "Left")
    assert rows[2004]["share_residual"] == 60


def test_tied_ordinals_match_once(spark):
    dim = spark.createDataFrame([("a", 0, "y"), ("a", 0, "x"), (None, 1, "z")], "k string, o long, v string")
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    assert sorted((r["n"], r["v"]) for r in lookup_first(df, dim, "k", "k", ["v"], "o").collect()) == [(1, "x"), (2, None)]


def test_small_values_are_not_rounded_by_default(spark):
    df = spark.createDataFrame([(1, 0.004)] * 3 + [(1, 0.012)], "period int, v double")
    assert mean_by_period(df, ["v"], scale=None).first()["v"] == pytest.approx(0.006)
    assert sum_all_by_period(df).first()["v"] == pytest.approx(0.024)
    assert row_total(df).first()["row_total"] == pytest.approx(0.024)
    with pytest.raises(Exception, match="decimals"):
        sum_all_by_period(df, exact_scale=2).collect()


def test_repeated_period_on_the_spine_fails(spark):
    base = spark.createDataFrame([(1,)], "period int")
    side = spark.createDataFrame([(1, 2.0), (1, 3.0)], "period int, v double")
    with pytest.raises(Exception, match="not unique"):
        spine_join(base, [side]).collect()


def test_first_match_in_a_split_file(spark, tmp_path):
    """Match order is the order of the rows in their file, however it is split."""
    rows = [f"k{i % 50};v{i}" for i in range(4000)]
    (tmp_path / "codes.csv").write_text("code;cat\n" + "\n".join(rows) + "\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        frame = _lookup_frame(spark, Lookup(f"{tmp_path}/codes.csv", key=[0], value=1, n_cols=2))
        assert frame.rdd.getNumPartitions() > 5
        first = first_by_key(frame.repartition(7), "__lk", ["__value"], "__ordinal")
        assert {r["__key"]: r["__value"] for r in first.collect()} == {f"k{i}": f"v{i}" for i in range(50)}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
