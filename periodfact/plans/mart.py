"""Indicator mart: messy per-period indicator files -> one row per period.

Each indicator source is declared once (path, how its period is found,
which measures to reduce and how); the mart is the spine join of all of
them on the period.  This is the whole indicator half of the reference as
one lazy plan: no ``show`` between steps, no positional column contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodfact.functions import parse_locale_number, period_from_code
from periodfact.operators import (filter_category, mean_by_period, row_total,
                                  safe_column_names, spine_join, sum_all_by_period)
from periodfact.operators.columns import q
from periodfact.sources import files_exist, read_delimited


@dataclass(frozen=True)
class Indicator:
    """One indicator source.

    ``measures`` maps output names to source columns (None: every column but
    the period, under its own name); ``reduce`` is ``mean`` (A1), ``sum``
    (A2), ``row_total`` (A5: one column ``out``, the sum over all measures
    and rows of the period) or ``none`` (already one row per period).  Text
    numbers are parsed with X1.  ``period_code`` cuts the period out of a
    code column (X2) instead of reading an integer column; ``keep`` filters
    a category column to one label (F2) before reducing.  An ``optional``
    source whose file is absent is left out of the mart.
    """

    path: str
    measures: Mapping[str, str] | None
    period_col: str = "Annee"
    reduce: str = "mean"
    period_code: tuple[int, int] | None = None
    keep: tuple[str, str] | None = None
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    exact_scale: int | None = None   # sum in scaled longs when values carry <= this many decimals
    out: str = "row_total"
    optional: bool = False
    names: Sequence[str] | None = None   # with measures None: output names of the columns, in file order


def indicator_frame(spark: SparkSession, spec: Indicator, period: str = "period") -> DataFrame:
    df = read_delimited(spark, spec.path, spec.schema, **dict(spec.options))
    if spec.keep:
        df = filter_category(df, *spec.keep)
    p = (period_from_code(q(spec.period_col), *spec.period_code) if spec.period_code
         else F.col(q(spec.period_col)).cast("int"))
    keep_col = spec.keep[0] if spec.keep else None
    measures = dict(spec.measures) if spec.measures is not None else {
        c: c for c in df.columns if c not in (spec.period_col, keep_col)}
    if spec.measures is None and spec.names is not None:
        if len(spec.names) != len(measures):
            raise ValueError(f"{spec.path} has {len(measures)} measures, not {len(spec.names)}")
        measures = dict(zip(spec.names, measures.values()))
    df = df.select(p.alias(period),
                   *[parse_locale_number(q(src)).alias(out) for out, src in measures.items()])
    if spec.reduce == "mean":
        return mean_by_period(df, list(measures), period=period, exact_scale=spec.exact_scale)
    if spec.reduce == "sum":
        return sum_all_by_period(df, period=period, cols=list(measures),
                                 exact_scale=spec.exact_scale)
    if spec.reduce == "row_total":
        return row_total(df, period=period, cols=list(measures), out=spec.out,
                         exact_scale=spec.exact_scale)
    if spec.reduce == "none":
        return df
    raise ValueError(f"unknown reduction {spec.reduce!r}")


def indicator_mart(spark: SparkSession, base: Indicator, others: Sequence[Indicator],
                   period: str = "period", max_name: int = 64) -> DataFrame:
    """J2 over all indicators: the base source's periods, the others left-joined."""
    present = [s for s in others if not s.optional or files_exist(spark, s.path)]
    mart = spine_join(indicator_frame(spark, base, period),
                      [indicator_frame(spark, s, period) for s in present], on=period)
    return safe_column_names(mart, max_len=max_name)
