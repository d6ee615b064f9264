import os
import uuid

from pyspark.sql import functions as F

from periodfact.operators import BlockLayout, pivot_categories, shares, tally, unpivot_blocks
from periodfact.sources import positional_schema
from periodfact.streaming import append_facts_stream, stream_period_files

SCHEMA = positional_schema(8)
LAYOUT = BlockLayout(start=2, step=3, fields={"code": 0, "votes": 1}, types={"votes": "double"},
                     key=("code",))


def wide(rows):
    head = "area;Exprimes;Code;Voix;Pct;Code;Voix;Pct\n"
    return head + "".join(";".join(r) + "\n" for r in rows)


def build_fact(batch):
    long = unpivot_blocks(batch, ["period"], LAYOUT, columns=SCHEMA.names)
    t = tally(long, ["period", "code"], "votes")
    valid = batch.groupBy("period").agg(F.sum(F.col("c1").cast("double")).alias("total"))
    w = pivot_categories(t, ["period"], "code", "votes", ["LO", "PS"]).join(valid, "period")
    return shares(w, "total", ["LO", "PS"])


def test_new_period_files_are_appended_once(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/fact"
    os.makedirs(src)
    for year, rows in [(2012, [["a1", "30", "LO", "10", "1", "PS", "20", "2"]]),
                       (2017, [["a1", "40", "LO", "10", "1", "PS", "30", "2"]])]:
        with open(f"{src}/election_{year}.csv", "w") as f:
            f.write(wide(rows))
    name = f"t-{uuid.uuid4().hex}"
    stream = stream_period_files(spark, src, SCHEMA, r"election_(\d{4})\.csv$")
    append_facts_stream(stream, build_fact, out, name).awaitTermination()
    assert sorted(r.period for r in spark.read.parquet(out).collect()) == [2012, 2017]
    with open(f"{src}/election_2022.csv", "w") as f:
        f.write(wide([["a1", "10", "LO", "5", "1", "PS", "5", "2"]]))
    stream = stream_period_files(spark, src, SCHEMA, r"election_(\d{4})\.csv$")
    append_facts_stream(stream, build_fact, out, name).awaitTermination()
    got = {r.period: r.share_PS for r in spark.read.parquet(out).collect()}
    assert got == {2012: 20 / 30 * 100, 2017: 75.0, 2022: 50.0}
