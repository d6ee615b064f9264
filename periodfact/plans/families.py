"""Wide result files of several families -> one fact row per (period, family).

A family is declared once: where its per-period files are, their block
layouts (which may change by period), the column holding the valid-vote
total, and the lookup chain from a block's key to a category.  All files of
a family are read in one scan: with a declared width by a positional schema as
wide as the widest file (shorter rows get nulls, which the null-key filter
drops), else as ragged rows cut by a layout table under each file's own header.
The period comes from each file's name, and every step after that is a
DataFrame operator: unpivot, tally, first-match lookups, zero-filled
pivot, shares and winner.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from periodfact.functions import casefold_key, normalise_label, parse_locale_number
from periodfact.operators import (BlockLayout, assemble_fact, lookup_first, pivot_categories,
                                  shares, tally, union_families, unpivot_blocks, winner_item,
                                  winner_of_columns)
from periodfact.operators.ragged import counted_cells, layout_report, layout_table, tally_cells
from periodfact.session import scratch_path
from periodfact.sources import files_exist, positional_schema, read_delimited, read_lines, read_period_files


@dataclass(frozen=True)
class Lookup:
    """A delimited lookup file: key column(s) -> value column, first match in file order.

    Columns are positions (the header is ignored, so header drift does not
    matter).  ``period_pattern`` makes it a per-period lookup whose files
    carry the period in their name (e.g. one candidate list per year).
    ``ordinal`` is the position of a numeric column giving the match order;
    without it the order is that of the rows in their files.  ``unique`` declares the key a primary key (no
    first-match deduplication needed).
    """

    path: str
    key: Sequence[int]
    value: int
    n_cols: int
    period_pattern: str | None = None
    ordinal: int | None = None
    unique: bool = False


@dataclass(frozen=True)
class Family:
    name: str
    glob: str
    period_pattern: str
    n_cols: int | None            # None: the width of each file's own header
    total_col: int | str          # position, or a header name looked up in the files' header
    layouts: Sequence[tuple[Sequence[int] | None, BlockLayout]]
    item: Sequence[str]
    lookups: Sequence[Lookup]
    winner: str = "category"          # or "item": category of the single biggest item
    unmatched: str = "keep"           # items without a category: keep (residual), bucket, drop or error
    bucket: str | None = None         # the category that takes them
    options: Mapping[str, str] = field(default_factory=dict)


def _key(cols: Sequence[Column], period: Column | None = None) -> Column:
    """The lookup key; null, so it matches nothing, if all of ``cols`` are blank."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    blank = F.trim(F.concat_ws("", *parts)) == ""
    whole = parts if period is None else [F.coalesce(period.cast("string"), F.lit("")), *parts]
    return F.when(~blank, casefold_key(F.concat_ws("|", *whole)))


def read_family(spark: SparkSession, fam: Family) -> DataFrame:
    """All files of a family in one scan: positional columns + the period."""
    return read_period_files(spark, fam.glob, fam.period_pattern,
                             schema=positional_schema(fam.n_cols), **dict(fam.options))


def family_partials(spark: SparkSession, fam: Family, wide: DataFrame) -> DataFrame:
    """Votes per (period, item) and valid-vote totals per period of some wide rows.

    Rows ``kind='item'`` carry the item fields and their votes; rows
    ``kind='total'`` carry the period's valid-vote total.  Partials of
    disjoint row sets (files, micro-batches) add up, so the fact can be
    built from any split of the files (see :func:`family_fact_from_partials`).
    One scan and one aggregation: the row's total travels as an extra
    pseudo-block next to the vote blocks.
    """
    names = positional_schema(fam.n_cols).names
    pos = fam.total_col
    explicit = [p for periods, _ in fam.layouts if periods for p in periods]
    parts = []
    for periods, layout in fam.layouts:
        w = (wide.where(F.col("period").isin(list(periods))) if periods
             else wide.where(~F.col("period").isin(explicit)) if explicit else wide)
        # the schema is as wide as the widest file: blocks past a narrower
        # file's last column read as null and are dropped by the key filter
        lay = replace(layout, stop="first_missing", key=(), transforms={})
        long = unpivot_blocks(w, ["period"], lay, columns=names,
                              extra_rows=[{"votes": F.col(names[pos])}])
        is_item = F.col("slot") >= 0
        if layout.transforms:
            long = long.withColumns({k: F.when(is_item, fn(F.col(k))).otherwise(F.col(k))
                                     for k, fn in layout.transforms.items()})
        if layout.key:
            ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")
                                             for k in layout.key])
            long = long.where(~is_item | ok)
        parts.append(long.withColumn("kind", F.when(is_item, F.lit("item")).otherwise(F.lit("total"))))
    long = reduce(lambda a, b: a.unionByName(b), parts)
    return (long.groupBy("kind", "period", *fam.item)
            .agg(F.sum(parse_locale_number("votes")).alias("votes")))


def _lookup_frame(spark: SparkSession, lk: Lookup) -> DataFrame:
    schema = positional_schema(lk.n_cols)
    df = (read_period_files(spark, lk.path, lk.period_pattern, schema=schema) if lk.period_pattern
          else read_delimited(spark, lk.path, schema))
    # match order: a declared column, else the place in the files (file, start of the split,
    # and the row within it, which the id tells), however a file is split and tasks are packed
    order = (F.col(f"c{lk.ordinal}").cast("long") if lk.ordinal is not None
             else F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                           F.monotonically_increasing_id().alias("row")))
    df = df.withColumn("__ordinal", order)
    key = _key([F.col(f"c{i}") for i in lk.key], F.col("period") if lk.period_pattern else None)
    return df.select(key.alias("__lk"), F.col(f"c{lk.value}").alias("__value"), "__ordinal")


def is_ragged(fam: Family) -> bool:
    """Whether the files' own headers give width or total."""
    return fam.n_cols is None or isinstance(fam.total_col, str)


def ragged_tally(spark: SparkSession, fam: Family) -> DataFrame:
    """Everything the family's lines may add, summed in one scan; see :mod:`periodfact.operators.ragged`."""
    options = dict(fam.options)
    fields, key, transforms = _shared_parts(fam)
    lines = read_lines(spark, fam.glob, fam.period_pattern, header=not isinstance(fam.total_col, str),
                       encoding=options.get("encoding", "UTF-8"))
    return tally_cells(lines, layout_table(spark, fam.layouts), fields, fam.total_col, sep=options.get("sep", ";"),
                       key=key, transforms=transforms)


def _shared_parts(fam: Family) -> tuple[list[str], tuple, Mapping]:
    """Fields, key and transforms, which all layouts of a ragged family have in common."""
    parts = [(sorted(lay.fields), tuple(lay.key), dict(lay.transforms)) for _, lay in fam.layouts]
    if any(p != parts[0] for p in parts):
        raise ValueError(f"the layouts of {fam.name} differ in fields, key or transforms")
    return parts[0]


def stored_tally(spark: SparkSession, fam: Family) -> DataFrame:
    """:func:`ragged_tally`, written to the shared scratch space: its headers can be looked up without another scan of the files."""
    tallied = ragged_tally(spark, fam)
    path = scratch_path(spark, "tallied")
    tallied.write.parquet(path)
    return spark.read.schema(tallied.schema).parquet(path)


def ragged_partials(spark: SparkSession, fam: Family, tallied: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """:func:`family_partials` of files whose headers differ, from one scan (or from a tally made before, ``stored`` or not)."""
    tallied = ragged_tally(spark, fam) if tallied is None else tallied
    return counted_cells(tallied, layout_table(spark, fam.layouts), fam.item, fam.total_col, width=fam.n_cols, stored=stored)


def family_layout_report(spark: SparkSession, fam: Family, tallied: DataFrame | None = None) -> DataFrame:
    """Short rows, unfinished blocks and surplus cells of each file of a ragged family."""
    tallied = ragged_tally(spark, fam) if tallied is None else tallied
    return layout_report(tallied, layout_table(spark, fam.layouts), fam.total_col, fam.n_cols)


def family_fact(spark: SparkSession, fam: Family, categories: Sequence[str],
                aliases: Mapping[str, str] | None = None, misses: Observation | None = None) -> DataFrame:
    """Shares (+ residual), winner and total of one family, one row per period.

    Files of a family may differ by year in width and in the place of the
    total: with a total given by name, or no declared width, each file's own
    header decides, all files being read in one scan.  ``misses`` gathers the
    items without a category in the same pass.
    """
    partials = ragged_partials(spark, fam, stored_tally(spark, fam), stored=True) if is_ragged(fam) else family_partials(spark, fam, read_family(spark, fam))
    return family_fact_from_partials(spark, fam, partials, categories, aliases, misses)


def family_fact_from_partials(spark: SparkSession, fam: Family, partials: DataFrame,
                              categories: Sequence[str],
                              aliases: Mapping[str, str] | None = None,
                              misses: Observation | None = None) -> DataFrame:
    """The fact of a family from its (possibly repeated per file or batch) partials.

    Every frame is used once, so the files are read once: total rows travel
    through the lookups with null keys, and one aggregation per period gives
    the category sums, the valid-vote total and (item mode) the category of
    the biggest item.

    ``unmatched_items`` and ``unmatched_votes`` count what the lookups missed, by
    period; the family's policy tells what becomes of it: it stays in the total
    (``keep``), goes to a category (``bucket``), leaves tally and total
    (``drop``), or fails the job (``error``).
    """
    cur = tally(partials, ["kind", "period", *fam.item], "votes")
    cur = cur.withColumn("__code", F.lit(None).cast("string"))
    for i, lk in enumerate(fam.lookups):
        src = [F.col(c) for c in fam.item] if i == 0 else [F.col("__code")]
        cur = lookup_first(cur.withColumn("__lk", _key(src, F.col("period") if lk.period_pattern else None)), _lookup_frame(spark, lk),
                           "__lk", "__lk", ["__value"], "__ordinal", unique=lk.unique).drop("__lk")
        cur = cur.withColumn("__code", F.col("__value")).drop("__value")
    is_item = F.col("kind") == "item"
    missed = is_item & F.col("__code").isNull()
    if misses is not None:
        cur = cur.observe(misses, F.count_if(missed).alias("items"), F.coalesce(F.sum(F.when(missed, F.col("votes"))), F.lit(0.0)).alias("votes"))
    label = F.when(missed, _missed(fam, categories)).otherwise(normalise_label("__code", categories, aliases))
    cur = cur.withColumn("category", F.when(is_item, label))
    names = {c: f"votes_{i}" for i, c in enumerate(categories)}
    extra = [F.count_if(missed).alias("unmatched_items"),
             F.coalesce(F.sum(F.when(missed, F.col("votes"))), F.lit(0.0)).alias("unmatched_votes")]
    if fam.winner == "item":
        # the category of the single biggest item; ties -> the lowest item key
        order = F.struct(-F.col("votes"), *[F.col(c) for c in fam.item])
        known = is_item & F.col("votes").isNotNull() & (~missed if fam.unmatched == "drop" else F.lit(True))
        extra.append(F.min_by(F.col("category"), F.when(known, order)).alias("winner"))
    wide = pivot_categories(cur, ["period"], "category", "votes", categories, names=names,
                            total="total", total_filter=~is_item, extra=extra)
    if fam.unmatched == "drop":
        wide = wide.withColumn("total", F.col("total") - F.col("unmatched_votes"))
    cols = list(names.values())
    out = shares(wide, "total", cols)
    if fam.winner != "item":
        out = winner_of_columns(out, [(names[c], c) for c in categories])
    renamed = {f"share_{names[c]}": f"share_{_slug(c)}" for c in categories}
    return out.withColumnsRenamed(renamed).drop(*cols)


def _missed(fam: Family, categories: Sequence[str]) -> Column:
    """The category of an item without one, by the family's policy."""
    if fam.unmatched == "bucket":
        if fam.bucket not in categories:
            raise ValueError(f"the bucket {fam.bucket!r} is no category")
        return F.lit(fam.bucket)
    if fam.unmatched == "error":
        item = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fam.item])
        return F.raise_error(F.concat(F.lit(f"no category in {fam.name}, "), F.col("period").cast("string"), F.lit(", for "), item)).cast("string")
    if fam.unmatched not in ("keep", "drop"):
        raise ValueError(f"unknown policy {fam.unmatched!r}")
    return F.lit(None).cast("string")


def _slug(label: str) -> str:
    return "_".join(label.lower().split())


def families_fact(spark: SparkSession, families: Sequence[Family], categories: Sequence[str],
                  mart: DataFrame | None = None, aliases: Mapping[str, str] | None = None,
                  indicator_cols: Sequence[str] = (), total_cols: Sequence[str] = (),
                  misses: Mapping[str, Observation] | None = None) -> DataFrame:
    """K2 + B1 + J5: all families' rows, tagged with the family, with the period's indicators.

    A family whose files are all absent is skipped (like a missing year).
    ``misses`` holds an observation for each family whose misses are wanted.
    """
    present = [f for f in families if files_exist(spark, f.glob)]
    if not present:
        raise ValueError("no family has any file")
    return assemble_families({f.name: family_fact(spark, f, categories, aliases, (misses or {}).get(f.name)) for f in present},
                             categories, mart, indicator_cols, total_cols)


def assemble_families(facts: Mapping[str, DataFrame], categories: Sequence[str],
                      mart: DataFrame | None = None, indicator_cols: Sequence[str] = (),
                      total_cols: Sequence[str] = ()) -> DataFrame:
    """Union of per-family facts, the period's indicators, stored types."""
    share_cols = [f"share_{_slug(c)}" for c in categories] + ["share_residual"]
    return assemble_fact(union_families(dict(facts)), None, mart, None, keys=("period", "family"),
                         share_cols=share_cols, indicator_cols=indicator_cols,
                         total_cols=["total", *total_cols])
