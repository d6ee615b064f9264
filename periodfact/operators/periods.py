"""Per-period reductions and period-ordered windows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodfact.functions import exact_sum, order_free_sum, percent_change, scaled_long
from periodfact.operators.columns import numeric_columns, q


def with_period(df: DataFrame, source: str, name: str = "period") -> DataFrame:
    """Integer period (year) from a date/timestamp column."""
    return df.withColumn(name, F.year(F.col(q(source))))


def filter_period(df: DataFrame, source: str, first: int, last: int | None = None) -> DataFrame:
    """keep the periods ``first..last`` (years of a date/timestamp column).

    Written as a range on the column itself, not on ``year(col)``, so the
    predicate reaches the Parquet scan as a pushed filter and row groups
    outside the range are skipped.
    """
    last = first if last is None else last
    c = F.col(q(source))
    return df.where((c >= F.lit(f"{first:04d}-01-01")) & (c < F.lit(f"{last + 1:04d}-01-01")))


def mean_parts(df: DataFrame, keys: Sequence[str], cols: dict[str, str],
               exact_scale: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Partial means: per key, the sum and count of each measure.

    Reducing rows to (key, sum, count) before a join keeps a hot key from
    reaching the join as millions of rows; :func:`mean_from_parts` finishes.
    ``extra`` adds more aggregates to the same pass.
    """
    aggs = list(extra)
    for out, c in cols.items():
        s = F.sum(F.col(q(c)) if exact_scale is None else scaled_long(q(c), exact_scale))
        aggs += [s.alias(f"{out}__sum"), F.count(F.col(q(c))).alias(f"{out}__n")]
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)


def mean_from_parts(df: DataFrame, keys: Sequence[str], outs: Sequence[str],
                    scale: int | None = 2, exact_scale: int | None = None) -> DataFrame:
    """Combine partial means (same result as :func:`mean_by_period` on the rows).

    With ``exact_scale`` the partial sums are scaled longs, so combining
    them stays exact.
    """
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*means_of_parts(outs, scale, exact_scale))


def means_of_parts(outs: Sequence[str], scale: int | None = 2, exact_scale: int | None = None) -> list[Column]:
    """The aggregates of :func:`mean_from_parts`, to be taken along in another aggregation."""
    unit = float(10 ** exact_scale) if exact_scale is not None else 1.0
    aggs = []
    for out in outs:
        m = (F.sum(f"{out}__sum") / F.lit(unit)) / F.sum(f"{out}__n")
        aggs.append((F.round(m, scale) if scale is not None else m).alias(out))
    return aggs


def part_columns(outs: Sequence[str]) -> list[str]:
    """The columns that :func:`mean_parts` makes for these means."""
    return [f"{out}__{part}" for out in outs for part in ("sum", "n")]


def _mean(c: str, exact_scale: int | None) -> Column:
    # exact sum / count: the same value whatever the partitioning
    total = order_free_sum(F.col(q(c))) if exact_scale is None else exact_sum(q(c), exact_scale)
    return total / F.count(F.col(q(c)))


def mean_by_period(df: DataFrame, cols: Sequence[str] | dict[str, str],
                   period: str | Sequence[str] = "period", scale: int | None = 2,
                   exact_scale: int | None = None) -> DataFrame:
    """A1 (+P1, X3): one row per period with the mean of each measure.

    ``cols`` is a list of measures (output keeps the name) or a mapping
    ``{output: measure}``.  Nulls are ignored.  Sums don't depend on row order:
    with ``exact_scale`` they are sums of scaled longs, else of fixed-point limbs.
    """
    keys = [period] if isinstance(period, str) else list(period)
    mapping = cols if isinstance(cols, dict) else {c: c for c in cols}
    aggs = []
    for out, c in mapping.items():
        m = _mean(c, exact_scale)
        aggs.append((F.round(m, scale) if scale is not None else m).alias(out))
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)


def _sum(df: DataFrame, c: str) -> Column:
    """The sum in the column's own type; that of doubles doesn't depend on row order."""
    inexact = dict(df.dtypes)[c] in ("double", "float")
    return order_free_sum(F.col(q(c))) if inexact else F.sum(F.col(q(c)))


def sum_all_by_period(df: DataFrame, period: str = "period", cols: Sequence[str] | None = None,
                      exclude: Iterable[str] = (), exact_scale: int | None = None) -> DataFrame:
    """A2 (+P3): sum of every numeric non-key column per period, names kept.

    The period itself is never summed (the reference's ``sum(Annee)``).
    """
    measures = list(cols) if cols is not None else numeric_columns(df, [period, *exclude])
    aggs = []
    for c in measures:
        if exact_scale is None:
            aggs.append(_sum(df, c).alias(c))
        else:
            aggs.append(exact_sum(q(c), exact_scale).alias(c))
    return df.groupBy(F.col(q(period))).agg(*aggs)


def row_total(df: DataFrame, period: str = "period", cols: Sequence[str] | None = None,
              exclude: Iterable[str] = (), out: str = "row_total",
              exact_scale: int | None = None) -> DataFrame:
    """A5 (+P8): horizontal sum of the measures, then summed over the period.

    Null cells count as 0 instead of failing.
    """
    measures = list(cols) if cols is not None else numeric_columns(df, [period, *exclude])
    if exact_scale is None:
        parts = [F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0)) for c in measures]
        total = order_free_sum(sum(parts[1:], parts[0]))
    else:
        parts = [F.coalesce(scaled_long(q(c), exact_scale), F.lit(0).cast("long")) for c in measures]
        total = F.sum(sum(parts[1:], parts[0])) / F.lit(float(10 ** exact_scale))
    return df.groupBy(F.col(q(period))).agg(total.alias(out))


def global_mean(df: DataFrame, cols: dict[str, str], scale: int = 2,
                exact_scale: int | None = None) -> DataFrame:
    """A4 (+P9): one-row mean over all periods of each (rounded) measure."""
    return df.agg(*[F.round(_mean(c, exact_scale), scale).alias(out) for out, c in cols.items()])


def lag_change(df: DataFrame, measures: Sequence[str] | dict[str, str], order: str = "period",
               partition: Sequence[str] = (), per_period: bool = False,
               scale: int | None = 2) -> DataFrame:
    """Percent change of each measure against the previous row in period order.

    "Previous" is the previous row of the partition, so gaps between periods
    are not bridged.  A window without partition columns runs in a single
    task; it is only allowed with ``per_period=True``, i.e. when the caller
    has already reduced the frame to one row per period (a bounded size).
    """
    if not partition and not per_period:
        raise ValueError("lag_change needs partition columns unless the frame has "
                         "one row per period (pass per_period=True)")
    w = Window.partitionBy(*[F.col(q(p)) for p in partition]).orderBy(F.col(q(order)))
    mapping = measures if isinstance(measures, dict) else {f"{m}_change": m for m in measures}
    return df.withColumns({out: percent_change(F.col(q(m)), F.lag(F.col(q(m)), 1).over(w), scale)
                           for out, m in mapping.items()})
