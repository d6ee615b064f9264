"""Verification plans on the driver tables, one per operator group.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
only from the library's operators.  ``periodfact.plans.oracle`` holds the
equivalent SQL for an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodfact import functions as PF
from periodfact.operators import (BlockLayout, assemble_fact, drop_null_keys, filter_category,
                                  filter_period, first_columns, global_mean, join_on_period,
                                  lag_change, mean_from_parts, mean_parts, means_of_parts, part_columns,
                                  lookup_first, mean_by_period, measure_gap, pivot_categories,
                                  row_total, safe_column_names, shares, spine_join,
                                  sum_all_by_period, tally, to_blocks, union_families, unmatched,
                                  unpivot_blocks, unpivot_layouts, winner_category, winner_item,
                                  winner_of_columns, with_period)
from periodfact.plans.tables import (CATEGORIES, SEGMENT_CATEGORY, col_name, dealt, lineitem,
                                     literal_table, orders, read)

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# A1 X3 P1 ------------------------------------------------------------------
def q_mean_by_period(spark: SparkSession, sf: str) -> DataFrame:
    return mean_by_period(lineitem(spark, sf), {
        "avg_quantity": "l_quantity", "avg_extendedprice": "l_extendedprice",
        "avg_discount": "l_discount", "avg_tax": "l_tax"}, exact_scale=2)


# J1 O1 ---------------------------------------------------------------------
def q_mean_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    a = mean_by_period(lineitem(spark, sf), {"avg_quantity": "l_quantity",
                                             "avg_extendedprice": "l_extendedprice"}, exact_scale=2)
    b = mean_by_period(orders(spark, sf), {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    return join_on_period(a, b, "inner").orderBy("period")


# F1 ------------------------------------------------------------------------
def q_period_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators of the periods 1996-1998 only; the range reaches both scans."""
    li = with_period(filter_period(read(spark, sf, "lineitem"), "l_shipdate", 1996, 1998), "l_shipdate")
    o = with_period(filter_period(read(spark, sf, "orders"), "o_orderdate", 1996, 1998), "o_orderdate")
    a = mean_by_period(li, {"avg_quantity": "l_quantity", "avg_extendedprice": "l_extendedprice"}, exact_scale=2)
    b = mean_by_period(o, {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    return join_on_period(a, b, "left")


# A2 P3 ---------------------------------------------------------------------
def q_mean_revenue_by_period(spark, sf):
    """A1 on a measure of four decimals, without a declared scale."""
    li = lineitem(spark, sf).withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return mean_by_period(li, {"avg_revenue": "revenue"}, scale=4)


def q_sum_all_by_period(spark: SparkSession, sf: str) -> DataFrame:
    li = lineitem(spark, sf).select("period", *LINE_MEASURES)
    return sum_all_by_period(li, exact_scale=2)


# A5 P8 ---------------------------------------------------------------------
def q_row_total_by_period(spark: SparkSession, sf: str) -> DataFrame:
    li = lineitem(spark, sf).select("period", *LINE_MEASURES)
    return row_total(li, exact_scale=2)


# X2 A2 ---------------------------------------------------------------------
def order_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a period code ``_YYYY_MM``; pending orders carry a malformed one."""
    o = read(spark, sf, "orders")
    month = F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    code = (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("_n/a_"), month))
            .otherwise(F.concat(F.lit("_"), F.year("o_orderdate").cast("string"), F.lit("_"), month)))
    return o.select(code.alias("code"), "o_totalprice")


def q_period_from_code(spark: SparkSession, sf: str) -> DataFrame:
    o = order_codes(spark, sf).select(PF.period_from_code("code").alias("period"), "o_totalprice")
    return sum_all_by_period(o, exact_scale=2)


# P5 ------------------------------------------------------------------------
def q_measure_gap(spark: SparkSession, sf: str) -> DataFrame:
    m = mean_by_period(lineitem(spark, sf), {"avg_tax": "l_tax", "avg_discount": "l_discount"}, exact_scale=2)
    return measure_gap(m, "avg_tax", "avg_discount", "gap")


# W1 X4 ---------------------------------------------------------------------
def yearly_price_change(spark: SparkSession, sf: str) -> DataFrame:
    m = mean_by_period(orders(spark, sf), {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    return lag_change(m, ["avg_totalprice"], per_period=True)


def q_lag_change(spark: SparkSession, sf: str) -> DataFrame:
    return yearly_price_change(spark, sf)


def q_lag_change_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    # orders are reduced to (customer, period) partial means before the join,
    # so a customer with a huge share of the orders reaches it as a few rows
    o = mean_parts(orders(spark, sf), ["o_custkey", "period"], {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    m = mean_from_parts(o.join(c, "o_custkey"), ["c_mktsegment", "period"], ["avg_totalprice"], exact_scale=2)
    return lag_change(m, ["avg_totalprice"], partition=["c_mktsegment"])


# A4 ------------------------------------------------------------------------
def q_mean_change(spark: SparkSession, sf: str) -> DataFrame:
    return global_mean(yearly_price_change(spark, sf), {"mean_change": "avg_totalprice_change"}, exact_scale=2)


# J2 ------------------------------------------------------------------------
def q_spine_left_join(spark: SparkSession, sf: str) -> DataFrame:
    base = mean_by_period(lineitem(spark, sf), {"avg_quantity": "l_quantity"}, exact_scale=2)
    o = mean_by_period(orders(spark, sf), {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    ev = mean_by_period(with_period(read(spark, sf, "events"), "ts"), {"avg_event_value": "value"}, exact_scale=2)
    return spine_join(base, [o, ev])


# F2 ------------------------------------------------------------------------
def q_filter_category(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    label = (F.when(F.col("c_acctbal") < 0, F.concat("c_mktsegment", F.lit("  ")))
             .otherwise(F.lower("c_mktsegment")))
    c = c.select("c_custkey", "c_name", "c_nationkey", label.alias("segment_label"))
    return filter_category(c, "segment_label", "Building")


# X1 ------------------------------------------------------------------------
def q_parse_locale_number(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    s = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.regexp_replace(s, "\\.", ","))
            .when(F.col("o_orderpriority") == "2-HIGH",
                  F.concat(F.substring(s, 1, 1), F.lit(" "), F.substring(s, 2, 64)))
            .when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
            .otherwise(s))
    o = o.select("o_orderkey", text.alias("price_text"))
    return o.select("o_orderkey", "price_text",
                    PF.parse_locale_number("price_text").alias("price"),
                    PF.is_rejected_number("price_text").alias("rejected"))


# X9 ------------------------------------------------------------------------
LABELS = ["Economy", "Large", "Medium", "Promo", "Small", "Standard"]


def q_normalise_label(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    raw = (F.when(F.col("p_size") < 15, F.lower("p_type"))
           .when(F.col("p_size") < 35, F.concat(F.lit("  "), F.col("p_type")))
           .otherwise(F.concat(F.initcap("p_type"), F.lit(" "))))
    p = p.select(PF.normalise_label(raw, LABELS, {"Std": "Standard"}).alias("label"),
                 "p_retailprice")
    return p.groupBy("label").agg(F.count(F.lit(1)).alias("n_parts"),
                                  PF.exact_sum("p_retailprice").alias("sum_retailprice"))


# X7 F3 ---------------------------------------------------------------------
def q_strip_prefix_code(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    p = p.select(PF.strip_prefix(F.concat(F.lit("L"), F.col("p_brand"))).alias("code"),
                 "p_retailprice")
    p = drop_null_keys(p, ["code"])
    return p.groupBy("code").agg(F.count(F.lit(1)).alias("n_parts"),
                                 PF.exact_sum("p_retailprice").alias("sum_retailprice"))


# P4 P2 ---------------------------------------------------------------------
LONG_A = "region_key_as_published_in_the_statistical_yearbook_of_the_reference_year"
LONG_B = "region_key_as_published_in_the_statistical_yearbook_of_the_revised_year"


def q_safe_column_names(spark: SparkSession, sf: str) -> DataFrame:
    r = read(spark, sf, "region")
    wide = r.select(F.col("r_regionkey").alias(LONG_A),
                    (F.col("r_regionkey") + 1).alias(LONG_B),
                    F.col("r_name"),
                    F.length("r_name").alias("name_length_in_characters_counted_including_blanks_inside"),
                    F.upper("r_name").alias("upper_name"),
                    F.lower("r_name").alias("lower_name"))
    return first_columns(safe_column_names(wide), 5)


# U1 S5 F3 ------------------------------------------------------------------
def numbered_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The lines with their row number within the order as ``block``, and the longest order's number of lines.

    Line numbers repeat within an order; numbering the rows keeps every item.
    """
    li = read(spark, sf, "lineitem")
    n_lines = li.count()
    widest = dealt(li.select("l_orderkey"), n_lines, "l_orderkey").groupBy("l_orderkey").count().agg(F.max("count")).first()[0] or 1
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    cells = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return dealt(cells, n_lines, "l_orderkey").withColumn("block", F.row_number().over(w)), widest


def wide_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order, one block (item, quantity, price) per line."""
    lines, widest = numbered_lines(spark, sf)
    return to_blocks(lines, ["l_orderkey"], "block", list(range(1, widest + 1)),
                     {"item": (F.max, "l_partkey"), "qty": (F.max, "l_quantity"),
                      "price": (F.max, "l_extendedprice")})


def q_unpivot_blocks(spark: SparkSession, sf: str) -> DataFrame:
    layout = BlockLayout(start=1, step=3, fields={"item": 0, "votes": 1}, key=("item",))
    return unpivot_blocks(wide_orders(spark, sf), ["l_orderkey"], layout)


# U3 B1 ---------------------------------------------------------------------
def q_unpivot_layouts(spark: SparkSession, sf: str) -> DataFrame:
    w = wide_orders(spark, sf)
    qty = BlockLayout(start=1, step=3, fields={"item": 0, "votes": 1}, key=("item",))
    price = BlockLayout(start=1, step=3, fields={"item": 0, "votes": 2}, key=("item",))
    return unpivot_layouts([(w, ["l_orderkey"], qty, {"family": "quantity"}),
                            (w, ["l_orderkey"], price, {"family": "price"})])


# A6 F3 ---------------------------------------------------------------------
def item_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Votes per (period, item), all rows included (a null item stays a group).

    Totals, lookups and winners all start from this one aggregation, so the
    lineitem scan and its shuffle run once and the exchange is reused.
    """
    li = lineitem(spark, sf).select("period", F.col("l_partkey").alias("item"), "l_quantity")
    return tally(li, ["period", "item"], "l_quantity")


def item_tally(spark: SparkSession, sf: str) -> DataFrame:
    li = lineitem(spark, sf).select("period", F.col("l_partkey").alias("item"), "l_quantity")
    return tally(drop_null_keys(li, ["item"]), ["period", "item"], "l_quantity")


def q_tally_items(spark: SparkSession, sf: str) -> DataFrame:
    return item_tally(spark, sf)


# J3 O2 ---------------------------------------------------------------------
def code_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Votes per (period, code): items -> their code (candidate -> party)."""
    part = read(spark, sf, "part")
    t = lookup_first(item_votes(spark, sf), part, "item", "p_partkey", ["p_brand"], "p_partkey",
                     unique=True)
    return tally(t.withColumnRenamed("p_brand", "code"), ["period", "code"], "votes")


def category_tally_long(spark: SparkSession, sf: str) -> DataFrame:
    """Codes -> first-listed category (party -> orientation, first match wins)."""
    part = read(spark, sf, "part")
    return lookup_first(code_tally(spark, sf), part, "code", "p_brand", ["p_type"], "p_partkey")


def q_lookup_first(spark: SparkSession, sf: str) -> DataFrame:
    return category_tally_long(spark, sf).withColumnRenamed("p_type", "category")


# X6 J3 ---------------------------------------------------------------------
def q_lookup_casefold(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    n = read(spark, sf, "nation")
    left = c.join(n.select(F.col("n_nationkey").alias("c_nationkey"),
                           F.concat(F.lower("n_name"), F.lit(" ")).alias("nation_label")),
                  "c_nationkey")
    j = lookup_first(left, n, "nation_label", "n_name", ["n_regionkey"], "n_nationkey",
                     casefold=True)
    return j.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n_customers"),
                                        PF.exact_sum("c_acctbal").alias("acctbal"))


# J4 ------------------------------------------------------------------------
def q_unmatched_codes(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    li = read(spark, sf, "lineitem")
    # one row per item (row count + votes) before the lookup join
    items = li.groupBy(F.col("l_partkey").alias("item")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("l_quantity"))
    rows = lookup_first(items, part, "item", "p_partkey", ["p_brand"], "p_partkey",
                     unique=True)
    truncated = part.where(F.col("p_brand") < "Brand#3")
    return unmatched(rows, truncated, "p_brand", "p_brand", measure="l_quantity", count_col="n")


# A7 ------------------------------------------------------------------------
def category_tally(spark: SparkSession, sf: str) -> DataFrame:
    return tally(category_tally_long(spark, sf).withColumnRenamed("p_type", "category"),
                 ["period", "category"], "votes")


def q_tally_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return category_tally(spark, sf)


# A8 O3 ---------------------------------------------------------------------
def category_votes(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_categories(category_tally(spark, sf), ["period"], "category", "votes",
                            CATEGORIES, names={c: col_name(c) for c in CATEGORIES},
                            total="total", exact_scale=2)


def q_zero_fill_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return category_votes(spark, sf).drop("total")


# A3 A11 X5 -----------------------------------------------------------------
def category_shares(spark: SparkSession, sf: str) -> DataFrame:
    wide = category_votes(spark, sf)
    cats = [col_name(c) for c in CATEGORIES]
    out = shares(wide, "total", cats)
    return winner_of_columns(out, [(col_name(c), c) for c in CATEGORIES]).select(
        "period", "total", *[f"share_{c}" for c in cats], "share_residual", "winner")


def q_category_shares(spark: SparkSession, sf: str) -> DataFrame:
    return category_shares(spark, sf).drop("winner")


# A9 ------------------------------------------------------------------------
def q_winner_category(spark: SparkSession, sf: str) -> DataFrame:
    return winner_category(category_tally(spark, sf), ["period"], "category", "votes", CATEGORIES)


# A10 -----------------------------------------------------------------------
def q_winner_item_category(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    w = winner_item(item_tally(spark, sf), ["period"], "item", "votes", "item")
    w = lookup_first(w, part, "winner_item", "p_partkey", ["p_type"], "p_partkey",
                     unique=True)
    return w.withColumnRenamed("p_type", "category")


# J5 K2 (flagship) ----------------------------------------------------------
SHARE_COLS = [f"share_{col_name(c)}" for c in CATEGORIES] + ["share_residual"]
INDICATOR_COLS = ["avg_totalprice", "avg_discount", "avg_tax"]
TOTAL_COLS = ["total_votes", "orders_value"]


def order_means(spark: SparkSession, sf: str) -> DataFrame:
    """Mean price and value of the orders per period, in one pass."""
    parts = mean_parts(orders(spark, sf), ["period"], {"avg_totalprice": "o_totalprice"}, exact_scale=2)
    return _with_value(parts.groupBy("period").agg(*means_of_parts(["avg_totalprice"], exact_scale=2),
                                                   F.sum("avg_totalprice__sum").alias("cents")))


def _with_value(df: DataFrame) -> DataFrame:
    """The orders' value from its cents (no price at all: 0)."""
    return df.withColumn("orders_value", F.coalesce(F.col("cents"), F.lit(0)) / F.lit(100.0)).drop("cents")


def lineitem_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares, winner, total and the yearly means of discount and tax.

    The means travel as sums and counts through the tally chain, so lineitem
    is scanned, reduced and shuffled once.
    """
    means = {"avg_discount": "l_discount", "avg_tax": "l_tax"}
    part = read(spark, sf, "part")
    t = mean_parts(lineitem(spark, sf).withColumnRenamed("l_partkey", "item"), ["period", "item"], means,
                   exact_scale=2, extra=[F.sum("l_quantity").alias("votes")])
    t = lookup_first(t, part, "item", "p_partkey", ["p_brand"], "p_partkey", unique=True)
    t = t.groupBy("period", F.col("p_brand").alias("code")).agg(
        *[F.sum(c).alias(c) for c in ["votes", *part_columns(means)]])
    t = lookup_first(t, part, "code", "p_brand", ["p_type"], "p_partkey")
    return _shares_and_winner(t, "p_type", means_of_parts(means, exact_scale=2))


def _shares_and_winner(t: DataFrame, category: str, extra: list) -> DataFrame:
    cats = [col_name(c) for c in CATEGORIES]
    wide = pivot_categories(t, ["period"], category, "votes", CATEGORIES,
                            names={c: col_name(c) for c in CATEGORIES}, total="total_votes",
                            exact_scale=2, extra=extra)
    return winner_of_columns(shares(wide, "total_votes", cats), [(col_name(c), c) for c in CATEGORIES])


def q_period_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Every table's indicators hang on the periods of orders, the spine of the indicators."""
    fact = spine_join(lineitem_shares(spark, sf), [order_means(spark, sf).withColumn("on_spine", F.lit(True))])
    fact = fact.withColumns({c: F.when(F.col("on_spine"), F.col(c)) for c in ("avg_discount", "avg_tax")})
    return assemble_fact(fact, None, None, None, share_cols=SHARE_COLS,
                         indicator_cols=INDICATOR_COLS, total_cols=TOTAL_COLS)


# B1 K3 ---------------------------------------------------------------------
def orders_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Second family: order value per customer -> segment -> category, with the orders' yearly mean and value."""
    o = orders(spark, sf).withColumnRenamed("o_custkey", "item")
    t = mean_parts(o, ["period", "item"], {"avg_totalprice": "o_totalprice"}, exact_scale=2,
                   extra=[PF.exact_sum("o_totalprice").alias("votes")])
    cust = read(spark, sf, "customer")
    t = lookup_first(t, cust, "item", "c_custkey", ["c_mktsegment"], "c_custkey",
                     unique=True)
    seg = literal_table(spark, SEGMENT_CATEGORY, ["segment", "category"])
    t = lookup_first(t, seg, "c_mktsegment", "segment", ["category"], "ordinal")
    return _with_value(_shares_and_winner(t, "category", [
        *means_of_parts(["avg_totalprice"], exact_scale=2), F.sum("avg_totalprice__sum").alias("cents")]))


def q_family_union(spark: SparkSession, sf: str) -> DataFrame:
    """Both families' rows; a period's indicators are spread over its few rows by a window, not computed again."""
    facts = union_families({"lineitem": lineitem_shares(spark, sf),
                            "orders": orders_shares(spark, sf)})
    w = Window.partitionBy("period")
    on_spine = F.col("period").isNotNull() & (F.count_if(F.col("family") == "orders").over(w) > 0)
    facts = facts.withColumns({c: F.when(on_spine, F.max(c).over(w))
                               for c in [*INDICATOR_COLS, "orders_value"]})
    return assemble_fact(facts, None, None, None,
                         keys=("period", "family"), share_cols=SHARE_COLS,
                         indicator_cols=INDICATOR_COLS, total_cols=TOTAL_COLS)


# S1 S2 S3 ------------------------------------------------------------------
def q_read_delimited_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """nation written as one semicolon CSV set per region, read back in one scan."""
    from periodfact.session import scratch_path
    from periodfact.sources import read_period_files
    base = scratch_path(spark, "nation-csv")
    (read(spark, sf, "nation").write.partitionBy("n_regionkey")
     .option("sep", ";").option("header", True).csv(base))
    df = read_period_files(spark, f"{base}/n_regionkey=*/*.csv", r"n_regionkey=(\d+)",
                           schema="n_nationkey int, n_name string")
    return df.select("n_nationkey", "n_name", "period")


# S3 U3 J3 J5 B1 on files -------------------------------------------------------
def write_wide_files(spark: SparkSession, sf: str):
    """lineitem as per-year wide result files plus a part lookup file.

    Each order becomes one row ``order;total;item;votes;item;votes;...`` (one
    block per line) in the folder of its order year; part becomes a
    ``partkey;brand;type`` file.  Returns the family spec that reads them:
    item -> brand (key lookup) -> type (first match by lowest partkey).
    """
    from periodfact.plans.families import Family, Lookup
    from periodfact.session import scratch_path
    base = scratch_path(spark, "wide-files")
    lines, widest = numbered_lines(spark, sf)
    blocks = [x for n in range(1, widest + 1) for x in (f"{n}_item", f"{n}_votes")]
    wide = to_blocks(lines, ["l_orderkey"], "block", list(range(1, widest + 1)),
                     {"item": (F.max, "l_partkey"), "votes": (F.max, "l_quantity")},
                     extra=[F.sum("l_quantity").alias("total")])
    years = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.year("o_orderdate").alias("period"))
    (wide.join(years, "l_orderkey")
     .select("period", "l_orderkey", "total", *blocks)
     .write.partitionBy("period").option("sep", ";").option("header", True).csv(f"{base}/wide"))
    (read(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
     .write.option("sep", ";").option("header", True).csv(f"{base}/part"))
    fam = Family("orders", f"{base}/wide/period=*/*.csv", r"period=(\d{4})",
                 n_cols=2 + 2 * widest, total_col=1,
                 layouts=[(None, BlockLayout(2, 2, {"item": 0, "votes": 1}, key=("item",)))],
                 item=["item"],
                 lookups=[Lookup(f"{base}/part", key=[0], value=1, n_cols=3, ordinal=0, unique=True),
                          Lookup(f"{base}/part", key=[1], value=2, n_cols=3, ordinal=0)])
    return base, fam


def q_wide_files_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Per-year wide result files read back in one scan through a family spec."""
    from periodfact.plans.families import families_fact
    _, fam = write_wide_files(spark, sf)
    return families_fact(spark, [fam], CATEGORIES)


def q_streaming_wide_files_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The same files arriving as a stream, in about four micro-batches.

    Each micro-batch appends its partial tallies (idempotently, one folder
    per batch); a year's files may straddle batches, which is why the fact
    is built from the accumulated partials rather than per batch.
    """
    import uuid

    from periodfact.plans.families import (assemble_families, family_fact_from_partials,
                                           family_partials)
    from periodfact.session import scratch_path
    from periodfact.sources import positional_schema
    from periodfact.streaming import append_facts_stream, stream_period_files
    from periodfact.sources import count_files
    base, fam = write_wide_files(spark, sf)
    per_batch = max(1, -(-count_files(spark, fam.glob) // 4))   # about four micro-batches
    stream = stream_period_files(spark, f"{base}/wide", positional_schema(fam.n_cols),
                                 fam.period_pattern, max_files_per_trigger=per_batch)
    target = scratch_path(spark, "stream-partials")
    append_facts_stream(stream, lambda batch: family_partials(batch.sparkSession, fam, batch),
                        target, f"wide-{uuid.uuid4().hex}").awaitTermination()
    partials = spark.read.parquet(target)
    return assemble_families({fam.name: family_fact_from_partials(spark, fam, partials, CATEGORIES)},
                             CATEGORIES)


# S1 S2 X1 X2 F2 A1 A2 J2 P4 on files -------------------------------------------
def q_indicator_mart_files(spark: SparkSession, sf: str) -> DataFrame:
    """Indicator files in the messy formats of the reference, read back into a mart.

    Written from orders and lineitem: quarterly mean prices (base), mean
    price per priority with decimal commas and a padded label, yearly order
    counts with space-grouped thousands, and monthly quantities keyed by a
    ``_YYYY_MM`` code.  Read with inferred types, parsed, reduced per year
    and spine-joined.
    """
    from periodfact.plans.mart import Indicator, indicator_mart
    from periodfact.session import scratch_path
    base = scratch_path(spark, "indicators")
    o, li = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    year = F.year("o_orderdate").alias("Annee")
    money = lambda c: F.round(PF.exact_mean(c), 2).cast("decimal(14,2)").cast("string")

    def write(df: DataFrame, name: str) -> str:
        path = f"{base}/{name}"
        df.write.option("sep", ";").option("header", True).csv(path)
        return path

    quarterly = write(o.groupBy(year, F.concat(F.lit("T"), F.quarter("o_orderdate")).alias("Trimestre"))
                      .agg(money("o_totalprice").alias("Prix moyen")), "quarterly")
    priority = write(o.groupBy(year, F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("Tranche"))
                     .agg(F.regexp_replace(money("o_totalprice"), "\\.", ",").alias("Prix")),
                     "priority")
    counts = write(o.groupBy(year).agg(F.regexp_replace(F.format_number(F.count(F.lit(1)), 0), ",", " ")
                                       .alias("Commandes")), "counts")
    code = F.concat(F.lit("_"), F.year("l_shipdate").cast("string"), F.lit("_"),
                    F.lpad(F.month("l_shipdate").cast("string"), 2, "0"))
    monthly = write(li.groupBy(code.alias("Annee")).agg(F.sum("l_quantity").alias("Quantite")), "monthly")
    return indicator_mart(spark, Indicator(quarterly, {"avg_price": "Prix moyen"}, exact_scale=2), [
        Indicator(priority, {"urgent_price": "Prix"}, keep=("Tranche", "1-urgent"), exact_scale=2),
        Indicator(counts, {"orders": "Commandes"}, reduce="none"),
        Indicator(monthly, {"quantity": "Quantite"}, reduce="sum", period_code=(2, 4), exact_scale=2),
    ])
