"""Period joins and fact assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.operators.columns import q


def join_on_period(a: DataFrame, b: DataFrame, how: str = "inner",
                   on: str | Sequence[str] = "period") -> DataFrame:
    """Equi-join of two per-period frames."""
    return a.join(b, on=on if isinstance(on, str) else list(on), how=how)


def spine_join(base: DataFrame, others: Sequence[DataFrame],
               on: str | Sequence[str] = "period") -> DataFrame:
    """Left-join a chain of per-period frames onto the base periods.

    Every right side must hold one row per period (they are reductions
    such as :func:`mean_by_period`), so the base row count is kept; a side
    with a repeated key fails the job instead of multiplying fact rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return reduce(lambda left, right: left.join(_one_row(right, keys), on=keys, how="left"), others, base)


def _one_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame, guarded in the plan: no further shuffle where it is already reduced by the keys."""
    rest = [c for c in df.columns if c not in keys]
    several = F.raise_error(F.lit(f"keys {list(keys)} are not unique"))
    types = dict(df.dtypes)
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(*[
        F.when(F.count("*") > 1, several.cast(types[c])).otherwise(F.any_value(F.col(q(c)))).alias(c) for c in rest])


def to_decimal(df: DataFrame, cols: Sequence[str], precision: int = 10, scale: int = 2,
               overflow: str = "null") -> DataFrame:
    """K2: store measures as ``DECIMAL(precision, scale)``.

    A value outside the type's range becomes null, or fails the job with
    ``overflow="raise"`` (as :func:`assemble_fact` does, so that no measure
    of a fact is lost silently).
    """
    t = f"decimal({precision},{scale})"

    def stored(c: str):
        value = F.col(q(c)).try_cast(t)
        if overflow == "null":
            return value
        lost = F.raise_error(F.concat(F.lit(f"{c} does not fit {t}: "), F.col(q(c)).cast("string"))).cast(t)
        return F.when(F.col(q(c)).isNotNull() & value.isNull(), lost).otherwise(value)

    return df.withColumns({c: stored(c) for c in cols})


def assemble_fact(shares: DataFrame, winner: DataFrame | None, indicators: DataFrame | None,
                  totals: DataFrame | None, keys: Sequence[str] = ("period",),
                  period: str = "period", share_cols: Sequence[str] = (),
                  indicator_cols: Sequence[str] = (), total_cols: Sequence[str] = (),
                  precision: int = 10, scale: int = 2,
                  total_precision: int = 20) -> DataFrame:
    """J5 (+K2): one fact row per group: winner, shares, the period's indicators, totals.

    ``winner`` is a per-group frame, or None when ``shares`` already carries
    a ``winner`` column.

    Everything is a keyed left join on the period, so a missing indicator
    gives nulls instead of shifting columns.  Shares and indicators are
    ``DECIMAL(precision, scale)``; totals get ``total_precision`` digits
    because yearly sums outgrow ``DECIMAL(10,2)`` at scale.  A value that
    doesn't fit its type fails the job.
    """
    fact = shares if winner is None else shares.join(winner, on=list(keys), how="left")
    if indicators is not None:
        fact = fact.join(indicators, on=period, how="left")
    if totals is not None:
        fact = fact.join(totals, on=period, how="left")
    fact = to_decimal(fact, [*share_cols, *indicator_cols], precision, scale, overflow="raise")
    fact = to_decimal(fact, list(total_cols), total_precision, scale, overflow="raise")
    return fact.select(*keys, "winner", *share_cols, *indicator_cols, *total_cols)


def union_families(facts: Mapping[str, DataFrame], family: str = "family") -> DataFrame:
    """B1 (+K3): append the facts of several families, tagged with the family.

    (The reference stored no family, so two elections of one year gave two
    indistinguishable rows.)
    """
    tagged = [df.withColumn(family, F.lit(name)) for name, df in facts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
