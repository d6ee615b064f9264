"""Ragged files with layouts as data: widths, headers, unfinished blocks, surplus cells, quoted cells."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from periodfact.operators import BlockLayout
from periodfact.operators.ragged import cells_of, layout_table, with_layout
from periodfact.plans.families import Family, Lookup, family_fact, family_layout_report, ragged_partials, ragged_tally


def write(path, *lines):
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "codes.csv", "code;cat", "A;Left", "B;Right", "C;Left")
    # 2001: total at 1, blocks of 2 from 2; one row lacks its last votes, one is short, one goes beyond the header
    write(tmp_path / "r_2001.csv", "zone;Total;code;votes;code;votes", "z;10;A;4;B;6", "y;7;A;3;B", "x;1;A;1", "w;9;B;5;A;4;C;99")
    # 2002: total at 3 by another spelling, blocks of 3 from 4, votes at offset 2, a quoted cell with the separator
    write(tmp_path / "r_2002.csv", "zone;a;b; TOTAL ;code;x;votes;code;x;votes", '"z;1";;;1 500;A;-;900;B;-;600')
    # 2003 has 100 blocks
    write(tmp_path / "r_2003.csv", ";".join(["zone", "Total"] + ["code;votes"] * 100), ";".join(["z", "100"] + ["A;0,5", "B;0,5"] * 50))
    return tmp_path


def family(folder, **more):
    layouts = [([2002], BlockLayout(4, 3, {"code": 0, "votes": 2}, key=("code",))),
               (None, BlockLayout(2, 2, {"code": 0, "votes": 1}, key=("code",)))]
    given = dict(n_cols=None, total_col="Total", layouts=layouts, item=["code"],
                 lookups=[Lookup(f"{folder}/codes.csv", key=[0], value=1, n_cols=2)])
    return Family("f", f"{folder}/r_*.csv", r"_(\d{4})\.csv", **(given | more))


def test_cells(spark):
    lines = {"a;b;": ["a", "b", ""], "": [""], ";;": ["", "", ""], '"a;b";c': ["a;b", "c"], ';"x ""y"" z";': ["", 'x "y" z', ""],
             'a;"open': ["a", '"open'], '"";"b"': ["", "b"], "a b": ["a b"]}
    df = spark.createDataFrame([(k,) for k in lines], "line string")
    assert {r.line: r.cells for r in df.select("line", cells_of("line").alias("cells")).collect()} == lines


def test_mixed_widths_in_one_scan(spark, folder):
    fam = family(folder)
    rows = {r["period"]: r for r in family_fact(spark, fam, ["Left", "Right"]).collect()}
    assert {p: (r["total"], r["winner"]) for p, r in rows.items()} == {2001: (27, "Left"), 2002: (1500, "Left"), 2003: (100, "Left")}
    assert rows[2001]["share_left"] == pytest.approx(12 / 27 * 100) and rows[2001]["share_right"] == pytest.approx(11 / 27 * 100)
    plan = ragged_partials(spark, fam)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [line") == 1


def test_lost_cells_are_counted(spark, folder):
    rows = {r["period"]: r.asDict() for r in family_layout_report(spark, family(folder)).drop("file").collect()}
    assert rows[2001] == {"period": 2001, "header_width": 6, "header_partial": False, "n_rows": 4, "n_short": 2, "n_partial": 1,
                          "n_surplus_rows": 1, "n_surplus_cells": 2}
    assert (rows[2002]["header_width"], rows[2003]["header_width"]) == (10, 202)
    assert all(rows[p]["n_partial"] == rows[p]["n_surplus_cells"] == 0 for p in (2002, 2003))


def test_report_and_fact_from_one_tally(spark, folder):
    fam = family(folder)
    tallied = ragged_tally(spark, fam).cache()
    assert family_layout_report(spark, fam, tallied).count() == 3
    assert {r["period"]: r["votes"] for r in ragged_partials(spark, fam, tallied).where("kind = 'total'").collect()} == {2001: 27, 2002: 1500, 2003: 100}


def test_broken_headers_fail(spark, folder):
    write(folder / "r_2004.csv", "zone;Total;code;votes;code", "z;1;A;1;B")
    with pytest.raises(Exception, match="partial block in .*r_2004"):
        ragged_partials(spark, family(folder)).collect()
    lax = [(p, BlockLayout(b.start, b.step, b.fields, stop="first_missing", key=b.key)) for p, b in family(folder).layouts]
    kept = ragged_partials(spark, family(folder, layouts=lax)).where("period = 2004 AND kind = 'item'").collect()
    assert [(r["code"], r["votes"]) for r in kept] == [("A", 1)]
    write(folder / "r_2004.csv", "zone;Sum;code;votes", "z;1;A;1")
    with pytest.raises(Exception, match="not in the header of .*r_2004"):
        ragged_partials(spark, family(folder)).collect()


def test_total_by_position(spark, tmp_path):
    write(tmp_path / "codes.csv", "code;cat", "A;Left")
    write(tmp_path / "r_2001.csv", "z;t;code;votes", "z;10;A;4")
    write(tmp_path / "r_2002.csv", "z;t" + ";code;votes" * 3, "z;10;A;4;A;5;A;1")
    fam = family(tmp_path, total_col=1, layouts=[(None, BlockLayout(2, 2, {"code": 0, "votes": 1}, key=("code",)))])
    rows = {r["period"]: r for r in family_fact(spark, fam, ["Left"]).collect()}
    assert {p: (r["total"], r["share_left"]) for p, r in rows.items()} == {2001: (10, 40), 2002: (10, 100)}


def test_periods_without_a_layout_are_left_out(spark):
    layouts = layout_table(spark, [([2002], BlockLayout(1, 2, {"votes": 0}))])
    assert [r["period"] for r in with_layout(spark.createDataFrame([(2001,), (2002,)], "period int"), layouts).collect()] == [2002]
    with pytest.raises(ValueError, match="step"):
        layout_table(spark, [(None, BlockLayout(1, 0, {"votes": 0}))])


@pytest.mark.parametrize("policy, want", [("keep", (10, 40, 60, 0)), ("drop", (4, 100, 0, 0)), ("bucket", (10, 40, 0, 60))])
def test_miss_policies_and_ledger(spark, tmp_path, policy, want):
    write(tmp_path / "codes.csv", "code;cat", "A;Left")
    write(tmp_path / "r_2001.csv", "z;Total;code;votes;code;votes;code;votes", "z;10;A;4;B;5;C;1")
    misses = Observation(f"misses-{policy}")
    row = family_fact(spark, family(tmp_path, unmatched=policy, bucket="Other"), ["Left", "Other"], misses=misses).first()
    assert (row["total"], row["share_left"], row["share_residual"], row["share_other"]) == want
    assert (row["unmatched_items"], row["unmatched_votes"]) == (2, 6) and misses.get == {"items": 2, "votes": 6.0}


def test_strict_policy_names_the_item(spark, tmp_path):
    write(tmp_path / "codes.csv", "code;cat", "A;Left")
    write(tmp_path / "r_2001.csv", "z;Total;code;votes;code;votes", "z;10;A;4;B;6")
    with pytest.raises(Exception, match="no category in f, 2001, for B"):
        family_fact(spark, family(tmp_path, unmatched="error"), ["Left"]).collect()
    with pytest.raises(ValueError, match="bucket"):
        family_fact(spark, family(tmp_path, unmatched="bucket", bucket="?"), ["Left"])


def test_item_winner_under_drop(spark, tmp_path):
    write(tmp_path / "codes.csv", "code;cat", "A;Left")
    write(tmp_path / "r_2001.csv", "z;Total;code;votes;code;votes", "z;10;A;4;B;6")
    assert family_fact(spark, family(tmp_path, winner="item"), ["Left"]).first()["winner"] is None
    assert family_fact(spark, family(tmp_path, winner="item", unmatched="drop"), ["Left"]).select(F.col("winner")).first()[0] == "Left"
