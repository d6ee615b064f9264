"""Steps whose cost must not grow faster than the tables."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from periodfact.operators import learn as L
from periodfact.plans import tables
from periodfact.plans.queries import q_unpivot_blocks, q_unpivot_layouts, wide_orders


def _lines(spark, path, orders=40, lines=3):
    rows = spark.range(orders * lines).select(
        (F.col("id") % orders).alias("l_orderkey"), (F.floor(F.col("id") / orders) + 1).cast("int").alias("l_linenumber"),
        (F.col("id") * 7 % 50).alias("l_partkey"), (F.col("id") % 9).cast("double").alias("l_quantity"),
        (F.col("id") * 1.5).cast("double").alias("l_extendedprice"))
    rows.write.parquet(f"{path}/lineitem.parquet")


def test_tasks_of_wide_orders_grow_with_the_lines(spark, scratch, monkeypatch):
    _lines(spark, scratch)
    few = sorted(map(tuple, wide_orders(spark, scratch).collect()))
    monkeypatch.setattr(tables, "TASK_ROWS", 10)  # 120 lines: 12 tasks, not the session's 4
    wide = wide_orders(spark, scratch)
    assert re.search(r"RepartitionByExpression \[l_orderkey#\d+L?\], 12\b", wide._jdf.queryExecution().optimizedPlan().toString())
    assert sorted(map(tuple, wide.collect())) == few
    assert q_unpivot_layouts(spark, scratch).count() == 2 * q_unpivot_blocks(spark, scratch).count() == 240


def test_headers_of_a_stored_tally_need_no_window(spark, tmp_path):
    from periodfact.operators import BlockLayout
    from periodfact.plans.families import Family, ragged_partials, stored_tally
    for year, line in ((2001, "z;Total;code;votes\nz;10;A;4\nz;5;B;5\n"), (2002, "z;y;Total;code;votes\nz;y;7;A;7;B;9\n")):
        (tmp_path / f"r_{year}.csv").write_text(line)
    layouts = [([2001], BlockLayout(2, 2, {"code": 0, "votes": 1}, key=("code",))), ([2002], BlockLayout(3, 2, {"code": 0, "votes": 1}, key=("code",)))]
    fam = Family("f", f"{tmp_path}/r_*.csv", r"r_(\d{4})", n_cols=None, total_col="Total", layouts=layouts, item=["code"], lookups=[])
    got = ragged_partials(spark, fam, stored_tally(spark, fam), stored=True)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((r["kind"], r["period"], r["code"], r["votes"]) for r in got.where("kind = 'item'").collect())
    assert rows == [("item", 2001, "A", 4), ("item", 2001, "B", 5), ("item", 2002, "A", 7)]
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in ragged_partials(spark, fam).collect()}


def test_equal_vectors_leave_the_lowest_keys(spark):
    t = np.array([[1.0, 2.0]] * 6 + [[0.0, 0.0], [np.nan, 1.0]])
    rows = L._by_key(t, pa.array([9, 3, None, 7, 1, 5, 2, 4]), 3)
    assert rows.tolist() == [4, 6, 1, 5]  # keys 1, 2, 3, 5


def test_knn_bounds_keep_the_exact_neighbours(spark):
    rng = np.random.default_rng(3)
    tr = np.concatenate([rng.integers(0, 3, (400, 3)).astype(float), 1e6 + rng.normal(size=(100, 3)) / 1e3])
    te = np.concatenate([rng.integers(0, 3, (30, 3)).astype(float), 1e6 + rng.normal(size=(10, 3)) / 1e3])
    y = rng.integers(0, 4, 500)
    keys = rng.permutation(500)
    train = spark.createDataFrame([(int(keys[i]), tr[i].tolist(), f"c{y[i]}") for i in range(500)], "id long, v array<double>, y string")
    test = spark.createDataFrame([(1000 + i, te[i].tolist()) for i in range(40)], "id long, v array<double>")
    got = {r.id: r.predicted for r in L.knn_classify(spark, train, test, "id", "v", "y", batch_rows=70, test_block=7).collect()}
    for i in range(40):
        d = np.zeros(500)
        for j in range(3):
            d += (tr[:, j] - te[i, j]) ** 2
        labels, votes = np.unique(y[np.lexsort((keys, d))[:5]], return_counts=True)
        assert got[1000 + i] == f"c{labels[np.argmax(votes)]}"


def test_knn_leaves_far_boxes_out_and_keeps_the_exact_neighbours(monkeypatch):
    """Rows of many boxes, ties and equal rows: few distances are bounded, and the neighbours are those of all pairs."""
    monkeypatch.setattr(L, "BOX_ROWS", 16)
    rng = np.random.default_rng(7)
    for make in (lambda n: rng.integers(0, 400, (n, 2)).astype(float), lambda n: np.round(rng.normal(size=(n, 4)) * 3) * (rng.random((n, 4)) < 0.4) + 1e5):
        t, x, keys = make(3000), make(200), rng.permutation(3000)
        t, keys = t[np.argsort(keys)], np.sort(keys)
        best = [[] for _ in x]
        for part in (slice(0, 1500), slice(1500, 3000)):
            L._add_nearest(best, x, t[part], pa.array(keys[part]), pa.array(keys[part]), 5, 9)
        for i in range(200):
            d = np.zeros(3000)
            for j in range(t.shape[1]):
                d += (t[:, j] - x[i, j]) ** 2
            assert [(f[0], f[2]) for f in best[i]] == [(d[n], keys[n]) for n in np.lexsort((keys, d))[:5]]
    t = np.column_stack([np.arange(64.0), np.zeros(64)])
    box, low, high = L._boxes(t[::-1])
    assert np.bincount(box).tolist() == [16] * 4 and box[0] == 3
    assert L._box_gaps(np.array([[0.0, 3.0], [2.0, 3.0]]), low, high).tolist() == [9.0, 14.0 ** 2 + 9, 30.0 ** 2 + 9, 46.0 ** 2 + 9]


def test_words_are_split_once_for_all_windows(spark):
    from periodfact.llm import chat
    rows = spark.createDataFrame([(1, 0, "u", "one two three four five six"), (1, 1, "a", "> one two three four five six\nyes")],
                                 "conv_id long, turn long, role string, text string")
    links = chat.links(chat.parsed(rows))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(lambda" in plan and "slice(split(" not in plan  # no split, and no normalising before it, for each window
    assert [tuple(r) for r in links.collect()] == [(1, 1, 0)]


CHAT = "conv_id long, turn long, role string, text string"


def test_quoted_lines_are_read_once_and_units_stay_where_they_are_made(spark):
    from periodfact.llm import chat
    rows = spark.createDataFrame([(1, 0, "u", "one two three four five six"), (1, 1, "a", "> one two three four five six\nyes")], CHAT)
    plan = chat.links(chat.parsed(rows))._jdf.queryExecution()
    filters = [line for line in plan.optimizedPlan().toString().splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("transform(" in line or "split(" in line for line in filters)  # each lambda there reads all lines for each line
    assert not re.search(r"hashpartitioning\([^)]*\bh#", plan.executedPlan().toString())


def test_a_long_conversation_links_as_a_short_one(spark, monkeypatch):
    """Dealt out by units or by conversation, with repeated rows, repeated passages and quotes of later messages."""
    from periodfact.llm import chat
    said = [f"word{k} two{k % 3} three four five six\nshort {k}. Well {k % 2}!" for k in range(12)]
    rows = [(c, k, "u", "".join(f"> {x}\n" for x in said[(k * 7 + c) % 12].split("\n")) + "> again\n\n> again\n>> " + said[max(k - 2, 0)].split("\n")[0]
             + "\n" + said[k]) for c in range(4) for k in range(12)]
    rows += [rows[5], (1, 5, "u", "> " + said[0].split("\n")[0] + "\nagain"), (9, 0, "u", "no quote"), (9, 1, "u", "no quote"), (None, 1, "u", "> no quote"),
             (1, None, "u", "> " + said[0])]
    frame = spark.createDataFrame(rows, CHAT)
    usual = sorted(map(tuple, chat.links(chat.parsed(frame)).collect()))
    assert len(usual) > 20
    for task, long in ((1, 16384), (3, 12), (2, 1)):  # conversation 1 alone is longer than 12
        monkeypatch.setattr(chat, "TASK", task)
        monkeypatch.setattr(chat, "LONG", long)
        assert sorted(map(tuple, chat.links(chat.parsed(frame)).collect())) == usual
