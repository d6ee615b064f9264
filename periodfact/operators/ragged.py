"""Ragged rows with their layouts as data (S3 S5 U3, A3): any mix of widths in one scan.

A row is an array of cells.  Where its repeated blocks begin, how far apart they
are and where a block's fields stand come from a small table joined by period,
and blocks are cut by index arithmetic, so files of any width and geometry share
one scan, one plan branch and one aggregation.

The header line of a file is a row like any other: it is the one that holds the
total's name.  Rows say what they would add under any header (blocks with their
number, and the cells before the first block as possible totals); after the
aggregation each file's own header tells which of those count.  Cells beyond the
header's width and blocks that a row leaves unfinished are counted, not lost.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodfact.functions import casefold_key, parse_locale_number
from periodfact.operators.reshape import BlockLayout

#: ``kind`` of a tallied row.
ITEM, CELL, WIDTH, HEADER = "item", "cell", "width", "header"
_ANY = -2**31  # the layout of every period that has none of its own


def layout_table(spark: SparkSession, layouts: Sequence[tuple[Sequence[int] | None, BlockLayout]]) -> DataFrame:
    """period (null: every other), start, step, span, strict, at (field -> offset): declared layouts as rows."""
    rows = [(p, lay.start, lay.step, max(lay.fields.values()), lay.stop == "end", dict(lay.fields))
            for periods, lay in layouts for p in (periods or [None])]
    if any(step <= 0 for _, _, step, *_ in rows):
        raise ValueError("step must be positive")
    structs = [F.struct(F.lit(p).cast("int").alias("period"), F.lit(start).alias("start"), F.lit(step).alias("step"),
                        F.lit(span).alias("span"), F.lit(strict).alias("strict"),
                        F.create_map(*[F.lit(x) for pair in at.items() for x in pair]).alias("at"))
               for p, start, step, span, strict, at in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def with_layout(rows: DataFrame, layouts: DataFrame, period: str = "period") -> DataFrame:
    """Rows with ``layout``: that of their period, else the table's row without a period; rows without one are left out."""
    whole = F.struct("start", "step", "span", "strict", "at")
    table = layouts.select(F.coalesce("period", F.lit(_ANY)).alias("__for"), whole.alias("__lay"))
    own = rows.join(table.select(F.col("__for").alias("__p"), F.col("__lay").alias("__own")), F.col(period) == F.col("__p"), "left")
    both = own.withColumn("__any", F.lit(_ANY)).join(table.select(F.col("__for").alias("__any"), "__lay"), "__any", "left")
    return (both.withColumn("layout", F.coalesce("__own", "__lay")).drop("__own", "__lay", "__p", "__any")
            .where(F.col("layout").isNotNull()))


def cells_of(line: Column | str, sep: str = ";") -> Column:
    """The cells of a delimited line; quoted ones may hold the separator and doubled quotes."""
    line = F.col(line) if isinstance(line, str) else line
    mark = "\\" + sep if not sep.isalnum() else sep
    plain = F.split(line, mark, -1)
    parts = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{mark}("(?:[^"]|"")*+"|[^{mark}]*+)'), 1)
    quoted = F.transform(parts, lambda c: F.when(
        F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')) & (F.length(c) > 1),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def _used(cells: Column) -> Column:
    """Cells up to the last one that isn't blank."""
    return F.coalesce(F.array_max(F.transform(cells, lambda c, i: F.when(F.trim(c) != "", i + 1))), F.lit(0))


def tally_cells(rows: DataFrame, layouts: DataFrame, fields: Sequence[str], total: str | int, line: str = "line",
                votes: str = "votes", sep: str = ";", key: Sequence[str] = (),
                transforms: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """All that rows (file, period, line) may add, summed: file, period, kind, place, at, <item fields>, votes, n.

    ``total`` is a header name, or a position in rows without headers.  ``place``
    is a block's number, a header's width or a row's used width; ``at`` a cell's
    position.  One scan and one partial aggregation; a block whose ``key``
    fields are blank adds nothing.
    """
    items = [f for f in fields if f != votes]
    rows = with_layout(rows, layouts).withColumn("cells", cells_of(line, sep))
    if isinstance(total, str):
        name = total.strip().lower()
        folded = F.transform("cells", lambda c: casefold_key(c))
        found = F.when(F.contains(F.lower(line), F.lit(name)), F.array_position(folded, F.lit(name)) - 1)
        rows = rows.withColumn("header_at", F.when(found >= 0, found))
        prefix = F.sequence(F.lit(0), F.col("layout.start") - 1)
    else:
        rows = rows.withColumn("header_at", F.lit(None).cast("long"))
        prefix = F.array(F.lit(total))
    rows = rows.withColumn("used", _used(F.col("cells")))
    null = F.lit(None).cast("string")

    def entry(kind: str, place: Column, at: Column, cell: Column, parts: Mapping[str, Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), at.cast("int").alias("at"),
                        *[parts.get(f, null).alias(f) for f in items], cell.alias("cell"))

    def block(b: Column) -> Column:
        first = F.col("layout.start") + b * F.col("layout.step")
        cell = {f: F.get("cells", first + F.col("layout.at")[f]) for f in fields}
        return entry(ITEM, b, F.lit(None), cell[votes], cell)

    blocks = F.ceil((F.col("used") - F.col("layout.start")) / F.col("layout.step")).cast("int")
    none = F.array().cast(f"array<struct<kind:string,place:int,at:int,{''.join(f'`{f}`:string,' for f in items)}cell:string>>")
    data = F.concat(
        F.array(entry(WIDTH, F.col("used"), F.lit(None), null, {})),
        F.transform(prefix, lambda p: entry(CELL, F.lit(None), p, F.get("cells", p), {})),
        F.when(blocks > 0, F.transform(F.sequence(F.lit(0), blocks - 1), block)).otherwise(none))
    header = F.array(entry(HEADER, F.size("cells"), F.col("header_at"), null, {}))
    long = rows.select("file", "period", F.inline(F.when(F.col("header_at").isNotNull(), header).otherwise(data)))
    is_item = F.col("kind") == ITEM
    if transforms:
        long = long.withColumns({f: F.when(is_item, fn(F.col(f))) for f, fn in transforms.items()})
    for f in key:
        long = long.where(~is_item | (F.col(f).isNotNull() & (F.trim(f) != "")))
    return (long.groupBy("file", "period", "kind", "place", "at", *items)
            .agg(F.sum(parse_locale_number("cell")).alias(votes), F.count("*").alias("n")))


def _with_headers(tallied: DataFrame, layouts: DataFrame, total: str | int, width: int | None, stored: bool = False) -> DataFrame:
    """Tallied rows with their file's header: width and place of the total, and whether it ends inside a block.

    The headers of a ``stored`` tally, a row for each file, come from a second read of it and travel to its rows; else one
    pass over all is kept and a task gathers the rows of whole files.
    """
    is_header = F.col("kind") == HEADER
    rows = with_layout(tallied, layouts)
    if not isinstance(total, str):
        rows = rows.withColumns({"header_width": F.lit(width).cast("int"), "total_at": F.lit(total)})
    elif stored:
        heads = tallied.where(is_header).groupBy("file").agg(F.max("place").alias("header_width"), F.max("at").alias("total_at"))
        rows = rows.join(F.broadcast(heads), "file", "left")
    else:
        whole = Window.partitionBy("file")
        rows = rows.withColumns({"header_width": F.max(F.when(is_header, F.col("place"))).over(whole),
                                 "total_at": F.max(F.when(is_header, F.col("at"))).over(whole)})
    return rows.withColumn("header_partial", _inside_block(F.col("header_width")))


def _inside_block(width: Column) -> Column:
    """Whether a row of this width ends before the last field of a block that it begins."""
    return F.coalesce((width > F.col("layout.start"))
                      & (F.pmod(width - 1 - F.col("layout.start"), F.col("layout.step")) < F.col("layout.span")), F.lit(False))


def counted_cells(tallied: DataFrame, layouts: DataFrame, items: Sequence[str], total: str | int, votes: str = "votes",
                  width: int | None = None, stored: bool = False) -> DataFrame:
    """kind ('item' or 'total'), period, <item fields>, votes: what counts under each file's header.

    A file without a header that names the total, and a header that ends inside
    a block where the layout is strict, fail the job.
    """
    rows = _with_headers(tallied, layouts, total, width, stored)
    wrong = F.when(F.col("total_at").isNull(), F.concat(F.lit(f"column {total!r} not in the header of "), "file")).when(
        F.col("header_partial") & F.col("layout.strict"), F.concat(F.lit("the layout leaves a partial block in "), "file"))
    last = F.col("layout.start") + F.col("place") * F.col("layout.step") + F.col("layout.span")
    kind = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string")).when(
        (F.col("kind") == ITEM) & (F.col("header_width").isNull() | (last < F.col("header_width"))), F.lit("item")).when(
        (F.col("kind") == CELL) & (F.col("at") == F.col("total_at")), F.lit("total"))
    return (rows.withColumn("kind", kind).where(F.col("kind").isNotNull())
            .groupBy("kind", "period", *items).agg(F.sum(votes).alias(votes)))


def layout_report(tallied: DataFrame, layouts: DataFrame, total: str | int, width: int | None = None) -> DataFrame:
    """file, period, header_width, header_partial, n_rows, n_short, n_partial, n_surplus_rows, n_surplus_cells, from the same tally."""
    rows = _with_headers(tallied, layouts, total, width).where(F.col("kind") == WIDTH)
    used, wide, n = F.col("place"), F.col("header_width"), F.col("n")

    def count(hit: Column, weight: Column | None = None) -> Column:
        return F.coalesce(F.sum(F.when(hit, n if weight is None else n * weight)), F.lit(0)).cast("long")

    return rows.groupBy("file", "period", "header_width", "header_partial").agg(
        F.sum("n").alias("n_rows"), count(used < wide).alias("n_short"),
        count((used <= wide) & _inside_block(used)).alias("n_partial"),
        count(used > wide).alias("n_surplus_rows"), count(used > wide, used - wide).alias("n_surplus_cells"))
