import os

import pytest
from pyspark.sql import functions as F

from periodfact.functions import strip_prefix
from periodfact.operators import (BlockLayout, apply_unmatched_policy, assert_all_matched,
                                  lookup_first, pivot_categories, shares, tally,
                                  unmatched, unpivot_blocks, unpivot_layouts, winner_category,
                                  winner_item, winner_of_columns)
from periodfact.sources import positional_schema, read_period_files

WIDE = """area;Exprimes;Code;Voix;Pct;Code;Voix;Pct
a1;30;LO;10;33.3;PS;20;66.7
a2;20;PS;15;75.0;;;
"""


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_wide_file_to_shares(spark, scratch):
    write(f"{scratch}/elections/election_2012.csv", WIDE)
    df = read_period_files(spark, f"{scratch}/elections/election_*.csv", r"election_(\d{4})\.csv$",
                           schema=positional_schema(8))
    layout = BlockLayout(start=2, step=3, fields={"code": 0, "votes": 1},
                         types={"votes": "double"}, key=("code",))
    long = unpivot_blocks(df, ["period", "c0"], layout, columns=positional_schema(8).names)
    assert sorted((r.c0, r.code, r.votes) for r in long.collect()) == [
        ("a1", "LO", 10.0), ("a1", "PS", 20.0), ("a2", "PS", 15.0)]
    t = tally(long, ["period", "code"], "votes")
    assert {r.code: r.votes for r in t.collect()} == {"LO": 10.0, "PS": 35.0}
    valid = df.groupBy("period").agg(F.sum(F.col("c1").cast("double")).alias("total"))
    wide = pivot_categories(t, ["period"], "code", "votes", ["LO", "PS", "XX"]).join(valid, "period")
    r = shares(wide, "total", ["LO", "PS", "XX"]).first()
    assert (r.share_LO, r.share_PS, r.share_XX) == (20.0, 70.0, 0.0)
    assert r.share_residual == pytest.approx(10.0)


# The ten block geometries: (start, step, key offset, votes offset, stop).
GEOMETRIES = [(16, 6, 0, 2, "end"), (15, 4, 0, 1, "end"), (9, 4, 1, 3, "first_missing"),
              (14, 5, 1, 3, "first_missing"), (16, 7, 0, 3, "end"), (16, 7, 1, 3, "first_missing"),
              (15, 5, 0, 2, "end"), (15, 6, 0, 3, "end"), (13, 5, 0, 2, "end"), (16, 8, 0, 4, "end")]


@pytest.mark.parametrize("start,step,key,votes,stop", GEOMETRIES)
def test_layout_geometries(spark, start, step, key, votes, stop):
    n_blocks = 3
    n_cols = start + n_blocks * step + (2 if stop == "first_missing" else 0)
    row = [f"v{i}" for i in range(n_cols)]
    for b in range(n_blocks):
        row[start + b * step + key] = f"K{b}"
        row[start + b * step + votes] = str(10 * (b + 1))
    df = spark.createDataFrame([row], positional_schema(n_cols))
    layout = BlockLayout(start, step, {"key": key, "votes": votes}, stop=stop,
                         types={"votes": "double"}, key=("key",))
    got = sorted((r.key, r.votes) for r in unpivot_blocks(df, ["c0"], layout).collect())
    assert got == [("K0", 10.0), ("K1", 20.0), ("K2", 30.0)]


def test_partial_block_is_a_layout_error(spark):
    df = spark.createDataFrame([["a"] * 7], positional_schema(7))
    with pytest.raises(ValueError):
        unpivot_blocks(df, ["c0"], BlockLayout(2, 3, {"k": 0, "v": 2}))


def test_strip_transform_and_layout_union(spark):
    df = spark.createDataFrame([["x", "LDVD", "3", "LPS", "4"]], positional_schema(5))
    lay = BlockLayout(1, 2, {"code": 0, "votes": 1}, transforms={"code": strip_prefix},
                      types={"votes": "double"})
    out = unpivot_layouts([(df, ["c0"], lay, {"family": "regional"}),
                           (df, ["c0"], BlockLayout(1, 2, {"code": 0, "votes": 1}, types={"votes": "double"}),
                            {"family": "raw"})])
    assert sorted((r.family, r.code) for r in out.collect()) == [
        ("raw", "LDVD"), ("raw", "LPS"), ("regional", "DVD"), ("regional", "PS")]


def test_lookup_first_duplicate_keys_do_not_double_count(spark):
    dim = spark.createDataFrame([(0, "LR", "Droite"), (1, "DV", "Ecologie"), (2, "LR", "Droite"),
                                 (3, "DV", "Divers")], "ordinal long, code string, cat string")
    votes = spark.createDataFrame([("LR", 5.0), ("DV", 7.0), ("ZZ", 1.0)], "code string, votes double")
    j = lookup_first(votes, dim, "code", "code", ["cat"], "ordinal")
    assert j.count() == 3
    assert {r.code: r.cat for r in j.collect()} == {"LR": "Droite", "DV": "Ecologie", "ZZ": None}
    miss = unmatched(votes, dim, "code", "code", "votes").collect()
    assert [(r.code, r.n_rows, r.votes) for r in miss] == [("ZZ", 1, 1.0)]
    assert {r.code: r.cat for r in apply_unmatched_policy(j, "cat").collect()}["ZZ"] == "Divers"
    assert apply_unmatched_policy(j, "cat", "drop").count() == 2
    with pytest.raises(ValueError):
        assert_all_matched(j, "cat")
    cf = lookup_first(spark.createDataFrame([(" lr ",)], "code string"), dim, "code", "code",
                      ["cat"], "ordinal", casefold=True)
    assert cf.first().cat == "Droite"


def test_winner_ties_and_row_wise_winner_agree(spark):
    cats = ["Gauche", "Centre", "Droite"]
    t = spark.createDataFrame([(1, "Droite", 5.0), (1, "Centre", 5.0), (2, "Gauche", 1.0),
                               (2, "Other", 9.0), (3, "Other", 2.0)],
                              "period int, cat string, votes double")
    agg = {r.period: r.winner for r in winner_category(t, ["period"], "cat", "votes", cats).collect()}
    assert agg == {1: "Centre", 2: "Gauche"}
    wide = pivot_categories(t, ["period"], "cat", "votes", cats, total="total")
    row = {r.period: r.winner for r in winner_of_columns(wide, [(c, c) for c in cats]).collect()}
    assert row == {1: "Centre", 2: "Gauche", 3: None}
    assert {r.period: r.total for r in wide.collect()} == {1: 10.0, 2: 10.0, 3: 2.0}


def test_winner_item_ties_to_lowest_ordinal(spark):
    t = spark.createDataFrame([(1, 7, 3.0), (1, 4, 3.0), (1, 9, 1.0)], "period int, item int, votes double")
    assert winner_item(t, ["period"], "item", "votes", "item").first().winner_item == 4


def test_shares_residual_property(spark):
    import random
    rnd = random.Random(7)
    rows = [(p, rnd.choice(["A", "B", "C", "D"]), float(rnd.randint(0, 50))) for p in range(5) for _ in range(40)]
    t = tally(spark.createDataFrame(rows, "period int, cat string, v double"), ["period", "cat"], "v")
    wide = pivot_categories(t, ["period"], "cat", "votes", ["A", "B", "C"], total="total")
    for r in shares(wide, "total", ["A", "B", "C"]).collect():
        assert r.share_A + r.share_B + r.share_C + r.share_residual == pytest.approx(100.0)


def test_to_blocks_round_trip(spark):
    from periodfact.operators import to_blocks
    rows = [(1, 1, "A", 2.0), (1, 2, "B", 3.0), (2, 1, "C", 5.0), (1, 1, "A", 1.0)]
    long = spark.createDataFrame(rows, "k int, slot int, item string, v double")
    wide = to_blocks(long, ["k"], "slot", [1, 2, 3],
                     {"item": (F.min, "item"), "votes": (F.sum, "v")},
                     extra=[F.sum("v").alias("total")])
    assert wide.columns == ["k", "1_item", "1_votes", "2_item", "2_votes", "3_item", "3_votes", "total"]
    back = unpivot_blocks(wide, ["k"], BlockLayout(1, 2, {"item": 0, "votes": 1}, key=("item",)),
                          columns=wide.columns[:7])
    assert sorted((r.k, r.slot, r.item, r.votes) for r in back.collect()) == [
        (1, 0, "A", 3.0), (1, 1, "B", 3.0), (2, 0, "C", 5.0)]
