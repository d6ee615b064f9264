"""Plan-shape regressions: pushdown, pruning, no Python in core paths."""

import re

from periodfact.plans import queries
from periodfact.session import scale_conf

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_range_is_pushed_to_both_scans(spark):
    p = plan(queries()["period_slice"](spark, SF))
    assert len(re.findall(r"PushedFilters: \[IsNotNull\(\w+\), GreaterThanOrEqual", p)) == 2


def test_flagship_prunes_columns_and_stays_in_jvm(spark):
    p = plan(queries()["period_fact"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem_scans = [s for s in schemas if "l_partkey" in s]
    assert lineitem_scans and all(s.count(":") == 5 for s in lineitem_scans)
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_each_large_table_is_scanned_once(spark):
    for name in ["period_fact", "family_union"]:
        p = plan(queries()[name](spark, SF))
        for table in ["lineitem", "orders"]:
            assert len(re.findall(rf"Location: [^\n]*/{table}\.parquet", p)) == 1, (name, table)
    p = plan(queries()["unpivot_layouts"](spark, SF))
    assert len(re.findall(r"Location: [^\n]*/lineitem\.parquet", p)) == 1


def test_no_text_in_the_shuffles_of_the_features(spark):
    p = plan(queries()["features_filled"](spark, SF))
    assert "Exchange" in p
    for line in re.findall(r"SortMergeJoin[^\n]*|BroadcastHashJoin[^\n]*", p):
        assert "text" not in line
    joined = p[p.index("Join"):]
    assert "regexp" in joined  # letters are counted below the join


def test_core_plans_have_no_python(spark):
    for name in ["family_union", "unpivot_layouts", "lookup_casefold", "holdout", "model_scores"]:
        p = plan(queries()[name](spark, SF))
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_scale_conf():
    c = scale_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1, 8)["spark.sql.shuffle.partitions"]) == 16
