"""Verification plans of facts from ragged files, miss policies, the stored fact table and repeatable appends."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodfact.operators import (BlockLayout, drop_columns, lag_change, mean_by_period, measure_gap, spine_join,
                                  sum_all_by_period, tally)
from periodfact.operators.contract import conform
from periodfact.operators.fact import to_decimal
from periodfact.plans.elections import FACT_TABLE
from periodfact.plans.families import (Family, Lookup, families_fact, family_fact_from_partials, family_layout_report)
from periodfact.plans.queries import lineitem_shares, order_means, q_family_union
from periodfact.plans.tables import CATEGORIES, TASK_ROWS, col_name, dealt, lineitem, orders, read
from periodfact.session import scratch_path
from periodfact.sinks import replace_facts

TOTAL = "Exprimes"
#: Header cells before the blocks, the blocks' geometry, blocks in a header, and the years of that geometry.
GEOMETRIES = [
    (["zone", TOTAL], BlockLayout(2, 2, {"item": 0, "votes": 1}, key=("item",)), 4, [1995, 1996]),
    (["zone", "inscrits", "votants", TOTAL, "nuls"], BlockLayout(5, 4, {"item": 1, "votes": 3}, key=("item",)), 7, [1997, 1998]),
    (["zone", "a", "b", "c", TOTAL, "d"], BlockLayout(6, 3, {"item": 0, "votes": 2}, stop="first_missing", key=("item",)), 66, None),
]
#: Files of a year, at least.
FILES = 4


def _write_lines(lines: DataFrame, headers: DataFrame, path: str) -> None:
    """Rows (period, bucket, line) as text files, a folder for each period and bucket, its header line first."""
    both = headers.withColumn("first", F.lit(0)).unionByName(lines.withColumn("first", F.lit(1)))
    (both.repartition("period", "bucket").sortWithinPartitions("period", "bucket", "first")
     .select("period", "bucket", "line").write.partitionBy("period", "bucket").text(path))


def _part_lookups(spark: SparkSession, sf: str, base: str, codes: DataFrame | None = None) -> list[Lookup]:
    """item -> brand (primary key), brand -> type (first match by part key), as delimited files."""
    part = read(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    for name, rows in (("part", part), ("codes", part if codes is None else codes)):
        rows.write.option("sep", ";").option("header", True).csv(f"{base}/{name}")
    return [Lookup(f"{base}/part", key=[0], value=1, n_cols=3, ordinal=0, unique=True),
            Lookup(f"{base}/codes", key=[1], value=2, n_cols=3, ordinal=0)]


def _block_cells(layout: BlockLayout) -> Callable:
    """The cells of one line's block; those that the layout doesn't name are filled."""
    def cells(b):
        at = {layout.fields["item"]: b["l_partkey"].cast("string"), layout.fields["votes"]: b["l_quantity"].cast("string")}
        return F.array(*[at.get(k, F.lit("x")) for k in range(layout.step)])
    return cells


# S3 S5 U3 A3 ----------------------------------------------------------------
def ragged_orders(spark: SparkSession, sf: str, base: str) -> Family:
    """lineitem as ragged result files: three geometries by year, the widest of 204 columns; rows end where their blocks end."""
    li = lineitem(spark, sf).where(F.col("period").isNotNull())
    n_lines = li.count()
    files = max(FILES, -(-n_lines // (4 * TASK_ROWS)))  # one task writes a file
    order = Window.partitionBy("period", "l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    many = F.lit(GEOMETRIES[-1][2])
    for _, _, n, years in reversed(GEOMETRIES[:-1]):
        many = F.when(F.col("period").isin(years), n).otherwise(many)
    cells = li.select("period", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    numbered = dealt(cells, n_lines, "period", "l_suppkey").withColumn("place", F.row_number().over(order) - 1).withColumn("many", many)
    rows = (numbered.withColumn("row", F.floor(F.col("place") / F.col("many")))
            .groupBy("period", "l_suppkey", "row")  # at most 66 lines each
            .agg(F.sort_array(F.collect_list(F.struct("place", "l_partkey", "l_quantity"))).alias("blocks"), F.sum("l_quantity").alias("total"))
            .withColumn("bucket", F.pmod(F.hash("l_suppkey", "row"), F.lit(files))))
    line = header = None
    for lead, layout, n, years in reversed(GEOMETRIES):
        row = F.concat(F.array(*[F.col("total").cast("string") if c == TOTAL else F.lit("0") for c in lead]),
                       F.flatten(F.transform("blocks", _block_cells(layout))))
        names = F.lit(";".join([*lead, *[f"{f}{b}" for b in range(n) for f in range(layout.step)]]))
        here = F.col("period").isin(years) if years else None
        line = F.concat_ws(";", row) if here is None else F.when(here, F.concat_ws(";", row)).otherwise(line)
        header = names if here is None else F.when(here, names).otherwise(header)
    heads = li.select("period").distinct().select("period", F.explode(F.array(*[F.lit(k) for k in range(files)])).alias("bucket"))
    _write_lines(rows.select("period", "bucket", line.alias("line")), heads.select("period", "bucket", header.alias("line")), f"{base}/wide")
    return Family("orders", f"{base}/wide/period=*/bucket=*/*.txt", r"period=(\d{4})", n_cols=None, total_col=TOTAL,
                  layouts=[(years, layout) for _, layout, _, years in GEOMETRIES], item=["item"],
                  lookups=_part_lookups(spark, sf, base))


def wide_files_layouts_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Files of three geometries in one scan; width and place of the total come from each file's header."""
    return families_fact(spark, [ragged_orders(spark, sf, scratch_path(spark, "ragged"))], CATEGORIES)


def wide_files_layout_report(spark: SparkSession, sf: str) -> DataFrame:
    """Files with rows that are short, break off inside a block or go beyond the header: each is counted by year.

    An order is one row of 1 to 5 blocks under a header of 4; every seventh one lacks the last votes.
    """
    base = scratch_path(spark, "ragged-report")
    o = orders(spark, sf).where(F.col("period").isNotNull())
    pairs = F.transform(F.sequence(F.lit(1), 1 + F.col("o_orderkey") % 5), lambda k: F.concat(k.cast("string"), F.lit(";9")))
    row = F.concat_ws(";", F.lit("z"), F.lit("y"), F.lit("7"), F.array_join(pairs, ";"))
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.regexp_replace(row, ";9$", "")).otherwise(row)
    rows = o.select("period", F.pmod(F.hash("o_orderkey"), F.lit(FILES)).alias("bucket"), cut.alias("line"))
    heads = o.select("period").distinct().select("period", F.explode(F.array(*[F.lit(k) for k in range(FILES)])).alias("bucket"),
                                                 F.lit(f"a;b;{TOTAL};" + ";".join(["item;votes"] * 4)).alias("line"))
    _write_lines(rows, heads, f"{base}/wide")
    fam = Family("orders", f"{base}/wide/period=*/bucket=*/*.txt", r"period=(\d{4})", n_cols=None, total_col=TOTAL,
                 layouts=[(None, BlockLayout(3, 2, {"item": 0, "votes": 1}, key=("item",)))], item=["item"], lookups=[])
    counts = ["n_rows", "n_short", "n_partial", "n_surplus_rows", "n_surplus_cells"]
    return family_layout_report(spark, fam).groupBy("period", "header_width").agg(*[F.sum(c).alias(c) for c in counts])


# J4 -------------------------------------------------------------------------
def _fact_with_misses(spark: SparkSession, sf: str, policy: str, known: str | None, bucket: str | None = None) -> DataFrame:
    """The lineitem family under a miss policy; codes from ``known`` on have no category."""
    part = read(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    codes = part if known is None else part.where(F.col("p_brand") < known)
    fam = Family("orders", "", "", n_cols=2, total_col=1, layouts=[], item=["item"], unmatched=policy, bucket=bucket,
                 lookups=_part_lookups(spark, sf, scratch_path(spark, "misses"), codes))
    li = lineitem(spark, sf).select("period", F.col("l_partkey").cast("string").alias("item"), F.col("l_quantity").alias("votes"))
    items = tally(li, ["period", "item"], "votes").withColumn("kind", F.lit("item"))
    totals = items.groupBy("period").agg(F.sum("votes").alias("votes")).select(
        "period", F.lit(None).cast("string").alias("item"), "votes", F.lit("total").alias("kind"))
    fact = family_fact_from_partials(spark, fam, items.unionByName(totals), CATEGORIES)
    stored = to_decimal(fact, [f"share_{col_name(c)}" for c in CATEGORIES] + ["share_residual"], overflow="raise")
    return to_decimal(stored, ["total", "unmatched_votes"], 20, overflow="raise")


def fact_unmatched_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return _fact_with_misses(spark, sf, "bucket", "Brand#3", bucket="ABSENT")


def fact_unmatched_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _fact_with_misses(spark, sf, "drop", "Brand#3")


def fact_unmatched_error(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing is missed here, so the strict policy lets the fact through."""
    return _fact_with_misses(spark, sf, "error", None)


# K2 -------------------------------------------------------------------------
_MEANS = {"moyenne_smic_horaire_brut": "l_quantity", "moyenne_ipc": "l_extendedprice",
          "moyenne_pouvoir_achat_unite_conso": "l_discount", "moyenne_pouvoir_achat_revenu_brute": "l_tax"}
#: Measures of the stored table that are numbers of lines or orders here: (column, condition).
_LINE_COUNTS = {"taux_insecurite_femmes": ("l_returnflag", "R"), "taux_insecurite_hommes": ("l_returnflag", "A"),
                "population_etrangere": ("l_linestatus", "O"), "population_immigres": ("l_linestatus", "F")}
_ORDER_COUNTS = {"preoccupation_terrorisme": ("o_orderpriority", "1-URGENT"), "preoccupation_chomage": ("o_orderpriority", "2-HIGH"),
                 "preoccupation_pauvrete": ("o_orderpriority", "3-MEDIUM"), "preoccupation_sante": ("o_orderpriority", "4-NOT SPECIFIED"),
                 "preoccupation_deliquance": ("o_orderpriority", "5-LOW"), "preoccupation_racisme": ("o_orderstatus", "F"),
                 "preoccupation_ecologie": ("o_orderstatus", "O"), "preoccupation_securite_routiere": ("o_orderstatus", "P")}


def stored_fact_table(spark: SparkSession, sf: str) -> DataFrame:
    """A fact with exactly the 29 columns and types of the stored table; a sum that outgrows its type is null (and counted on request)."""
    from periodfact.functions import exact_mean, exact_sum

    def counts(which):
        return [F.count_if(F.col(c) == v).alias(out) for out, (c, v) in which.items()]

    li = lineitem(spark, sf).groupBy("period").agg(
        *[F.round(exact_mean(c), 2).alias(out) for out, c in _MEANS.items()], *counts(_LINE_COUNTS),
        F.count("*").alias("population_totale_etrangere"), exact_sum("l_extendedprice").alias("nombre_incivilite"))
    o = orders(spark, sf).groupBy("period").agg(*counts(_ORDER_COUNTS))
    means = order_means(spark, sf).select("period", F.col("avg_totalprice").alias("moyenne_ensemble_chomage"))
    shares = lineitem_shares(spark, sf).select("period", "winner", *[f"share_{col_name(c)}" for c in CATEGORIES], "share_residual")
    names = [n for n in FACT_TABLE.names if n.startswith("total_vote_")]
    sources = {"Annee": "period", "Orientation_politique_gagnante": "winner",
               **dict(zip(names, [*[f"share_{col_name(c)}" for c in CATEGORIES], "share_residual"]))}
    return conform(spine_join(shares, [li, o, means]), FACT_TABLE, sources)


# K3 -------------------------------------------------------------------------
def fact_appended_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Both families' facts appended, then the years from 1997 on once more: every row is there once."""
    path = scratch_path(spark, "replaced-facts")
    fact = q_family_union(spark, sf).where(F.col("period").isNotNull())
    replace_facts(fact, path)
    stored = spark.read.parquet(path)
    again = scratch_path(spark, "again")
    stored.where("period >= 1997").write.parquet(again)
    replace_facts(spark.read.schema(stored.schema).parquet(again), path)
    return spark.read.schema(stored.schema).parquet(path).select(*fact.columns)


# A1 A2 ----------------------------------------------------------------------
def sum_discounted_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of measures with no declared scale: the same bits under any partitioning, here to six decimals."""
    li = lineitem(spark, sf).select("period", (F.col("l_extendedprice") * F.col("l_discount")).alias("discounted"),
                                    (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charged"))
    sums = sum_all_by_period(li)
    return sums.select("period", *[F.round(c, 4).alias(c) for c in ("discounted", "charged")])


# A1 P1 P5 P7 W1 -------------------------------------------------------------
def evolution_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two yearly means, their gap and both changes against the year before, without the columns that the table doesn't keep."""
    means = mean_by_period(lineitem(spark, sf), {"avg_price": "l_extendedprice", "avg_quantity": "l_quantity", "avg_tax": "l_tax"}, exact_scale=2)
    table = measure_gap(means, "avg_price", "avg_quantity", "gap")
    changes = {"price_change": "avg_price", "quantity_change": "avg_quantity"}
    return drop_columns(lag_change(table, changes, per_period=True), ["avg_tax"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: Sequence[Callable] = (wide_files_layouts_fact, wide_files_layout_report, fact_unmatched_bucket, fact_unmatched_drop,
                                 fact_unmatched_error, stored_fact_table, fact_appended_twice, sum_discounted_by_period, evolution_table)
    return {f.__name__: f for f in found}
