"""Wide-to-long block unpivot (U1, U3) and zero-filled category pivot."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.operators.columns import drop_null_keys, q


@dataclass(frozen=True)
class BlockLayout:
    """Geometry of repeated column blocks in a wide frame.

    Blocks start at column position ``start`` and repeat every ``step``
    columns; ``fields`` maps an output name to its offset inside a block.
    ``stop='end'`` requires every block to be complete (a trailing partial
    block is a layout error); ``stop='first_missing'`` ends at the first
    block that runs past the last column.  ``types`` casts fields to one
    type across blocks, ``transforms`` post-processes a field (for instance
    stripping a one-letter prefix), ``key`` names the fields that must be
    present for a block to count.
    """

    start: int
    step: int
    fields: Mapping[str, int]
    stop: str = "end"
    types: Mapping[str, str] = field(default_factory=dict)
    transforms: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    key: Sequence[str] = ()

    def positions(self, n_cols: int) -> list[dict[str, int]]:
        if self.step <= 0:
            raise ValueError("step must be positive")
        span = max(self.fields.values())
        blocks = []
        for i in range(self.start, n_cols, self.step):
            if i + span >= n_cols:
                if self.stop == "first_missing":
                    break
                raise ValueError(f"layout {self} leaves a partial block at column {i} "
                                 f"of {n_cols}")
            blocks.append({name: i + off for name, off in self.fields.items()})
        return blocks


def unpivot_blocks(df: DataFrame, id_cols: Sequence[str], layout: BlockLayout,
                   slot: str | None = "slot", columns: Sequence[str] | None = None,
                   extra_rows: Sequence[Mapping[str, Column]] = ()) -> DataFrame:
    """U1 (+S5, U2, F3): one long row per (input row, block).

    Fields of one block travel together in a struct, so no row alignment
    across separate reads is needed; ``inline`` expands the array in the
    same stage (no shuffle).  Blocks without their key fields are dropped.
    ``columns`` lists the file's own columns that block positions count in
    (default: all columns); columns added after the read, such as the
    period taken from the file name, are left out of it.  ``extra_rows``
    adds per-row pseudo-blocks (slot -1, -2, ...) given as ``{field: Column}``,
    e.g. a row-level total, so one scan yields both.
    """
    cols = list(columns) if columns is not None else df.columns
    structs = []
    types = {}
    for b, pos in enumerate(layout.positions(len(cols))):
        parts = [F.lit(b).alias(slot)] if slot else []
        for name, p in pos.items():
            c = F.col(q(cols[p]))
            types.setdefault(name, layout.types.get(name, df.schema[cols[p]].dataType))
            if name in layout.types:
                c = c.cast(layout.types[name])
            parts.append(c.alias(name))
        structs.append(F.struct(*parts))
    if not structs:
        raise ValueError("layout yields no block for this frame")
    for i, extra in enumerate(extra_rows):
        parts = [F.lit(-1 - i).alias(slot)] if slot else []
        parts += [(extra[name] if name in extra else F.lit(None)).cast(types[name]).alias(name)
                  for name in layout.fields]
        structs.append(F.struct(*parts))
    long = df.select(*[F.col(q(c)) for c in id_cols], F.inline(F.array(*structs)))
    if layout.transforms:
        long = long.withColumns({k: fn(F.col(q(k))) for k, fn in layout.transforms.items()})
    return drop_null_keys(long, layout.key) if layout.key else long


def unpivot_layouts(frames: Sequence[tuple[DataFrame, Sequence[str], BlockLayout, Mapping[str, object]]],
                    slot: str | None = "slot") -> DataFrame:
    """U3 (+B1): unpivot several layout groups and append them.

    Each entry is ``(wide_frame, id_cols, layout, constant_columns)``, e.g.
    constants ``{'family': 'regional'}``.  Layouts of one and the same frame
    are expanded together, so the frame is computed once.
    """
    if not frames:
        raise ValueError("no frames")
    groups: list[list] = []
    for entry in frames:
        if groups and _together(groups[-1][0], entry):
            groups[-1].append(entry)
        else:
            groups.append([entry])
    parts = [_unpivot_together(group, slot) for group in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _together(a, b) -> bool:
    """Whether two entries read the same frame into the same columns."""
    return (a[0] is b[0] and list(a[1]) == list(b[1]) and list(a[3]) == list(b[3])
            and list(a[2].fields) == list(b[2].fields) and tuple(a[2].key) == tuple(b[2].key)
            and not a[2].transforms and not b[2].transforms)


def _unpivot_together(entries: Sequence, slot: str | None) -> DataFrame:
    df, ids, layout, consts = entries[0]
    if len(entries) == 1:
        long = unpivot_blocks(df, ids, layout, slot)
        return long.withColumns({k: F.lit(v) for k, v in consts.items()}) if consts else long
    structs = []
    for _, _, lay, values in entries:
        for b, pos in enumerate(lay.positions(len(df.columns))):
            cells = {n: F.col(q(df.columns[p])) for n, p in pos.items()}
            structs.append(F.struct(
                *([F.lit(b).alias(slot)] if slot else []),
                *[(c.cast(lay.types[n]) if n in lay.types else c).alias(n) for n, c in cells.items()],
                *[F.lit(v).alias(n) for n, v in values.items()]))
    if not structs:
        raise ValueError("layout yields no block for this frame")
    long = df.select(*[F.col(q(c)) for c in ids], F.inline(F.array(*structs)))
    return drop_null_keys(long, layout.key) if layout.key else long


def to_blocks(df: DataFrame, index: Sequence[str], slot: str, slots: Sequence[object],
              fields: Mapping[str, tuple[Callable[[Column], Column], str]],
              extra: Sequence[Column] = ()) -> DataFrame:
    """Inverse of :func:`unpivot_blocks`: long rows -> one wide row per index.

    For every slot value ``s`` and field ``name -> (aggregate, column)`` the
    output has ``{s}_{name}`` = aggregate of the column over the rows of that
    slot (null where the slot is absent), in slot-major order, so the result
    has the repeated-block layout of a wide result file.  One conditional
    aggregation (one shuffle, partially aggregated) instead of a pivot that
    first aggregates by (index, slot).  ``extra`` adds whole-row aggregates.
    """
    aggs = []
    for v in slots:
        hit = F.col(q(slot)) == F.lit(v)
        aggs += [fn(F.when(hit, F.col(q(c)))).alias(f"{v}_{name}") for name, (fn, c) in fields.items()]
    return df.groupBy(*[F.col(q(c)) for c in index]).agg(*aggs, *extra)


def pivot_categories(df: DataFrame, index: Sequence[str], category: str, value: str,
                     categories: Sequence[str], names: Mapping[str, str] | None = None,
                     fill: object = 0, total: str | None = None,
                     exact_scale: int | None = None, total_filter: Column | None = None,
                     extra: Sequence[Column] = ()) -> DataFrame:
    """A8 (+O3): one column per listed category, in list order, missing -> ``fill``.

    The values are given, so no job runs to discover them, and categories
    absent from the data still get their (zero) column.  Categories not in
    the list are left out of the columns but, with ``total``, still counted
    in a total column computed in the same aggregation (one pass, one
    shuffle of the already reduced tally).  ``exact_scale`` sums in scaled
    longs.  ``total_filter`` restricts the rows counted in the total (e.g.
    dedicated total rows); ``extra`` adds more aggregates to the same pass.
    """
    from periodfact.functions import scaled_long
    names = dict(names or {})
    v = F.col(q(value)) if exact_scale is None else scaled_long(q(value), exact_scale)

    def summed(c: Column) -> Column:
        s = F.sum(c)
        return s / F.lit(float(10 ** exact_scale)) if exact_scale is not None else s

    aggs = [F.coalesce(summed(F.when(F.col(q(category)) == F.lit(c), v)),
                       F.lit(fill).cast("double")).alias(names.get(c, c)) for c in categories]
    if total:
        aggs.append(summed(v if total_filter is None else F.when(total_filter, v)).alias(total))
    return df.groupBy(*[F.col(q(c)) for c in index]).agg(*aggs, *extra)
