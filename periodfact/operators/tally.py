"""Tallies, first-match lookups, shares and winners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodfact.functions import casefold_key, exact_sum, share
from periodfact.operators.columns import q


def tally(df: DataFrame, keys: Sequence[str], measure: str, out: str = "votes",
          exact_scale: int | None = None) -> DataFrame:
    """Sum of a measure per key (partial aggregation before the shuffle).

    The map-side partial aggregate collapses a hot key to one row per task
    before anything is shuffled, so key skew does not reach the exchange.
    """
    m = F.col(q(measure))
    agg = F.sum(m) if exact_scale is None else exact_sum(m, exact_scale)
    return df.groupBy(*[F.col(q(k)) for k in keys]).agg(agg.alias(out))


def first_by_key(dim: DataFrame, key: str, values: Sequence[str], ordinal: str,
                 casefold: bool = False, key_out: str = "__key") -> DataFrame:
    """One row per lookup key: the values of the row with the lowest ordinal.

    This is file-order first match made explicit; duplicate keys (a code
    listed twice with different values) can't double-count, and rows that tie
    on the ordinal give one row too, that of the smallest values.  Null keys
    never match and are dropped.
    """
    k = casefold_key(F.col(q(key))) if casefold else F.col(q(key))
    rows = dim.where(k.isNotNull()).select(k.alias(key_out), F.struct(F.col(q(ordinal)), *[F.col(q(v)) for v in values]).alias("__row"))
    return rows.groupBy(key_out).agg(F.min("__row").alias("__row")).select(key_out, *[F.col("__row")[v].alias(v) for v in values])


def lookup_first(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
                 values: Sequence[str], ordinal: str, casefold: bool = False,
                 how: str = "left", unique: bool = False) -> DataFrame:
    """J3 (+O2, X6): attach the first matching lookup row to every row.

    One deduplicated lookup and one join replace a job per key.  By default
    the join strategy is left to Spark's size checks: the planner broadcasts
    a side whose estimated size (an upper bound after aggregation) is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks the actual
    size at run time; anything larger stays a sort-merge join with AQE skew
    splitting.

    ``unique=True`` declares ``right_on`` a primary key of ``dim`` (at most
    one row per key): the first-match deduplication, a sort-based
    aggregation over the whole dimension, is then skipped.
    """
    if unique:
        k = casefold_key(F.col(q(right_on))) if casefold else F.col(q(right_on))
        first = dim.where(k.isNotNull()).select(k.alias("__key"), *[F.col(q(v)) for v in values])
    else:
        first = first_by_key(dim, right_on, values, ordinal, casefold)
    lk = casefold_key(F.col(q(left_on))) if casefold else F.col(q(left_on))
    return df.join(first, lk == first["__key"], how).drop("__key")


def unmatched(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
              measure: str | None = None, casefold: bool = False,
              count_col: str | None = None) -> DataFrame:
    """Keys of ``df`` without a lookup row, with their row count and votes.

    ``df`` may be a pre-aggregated tally: ``count_col`` then holds the
    number of source rows behind each tally row and is summed.
    """
    lk = casefold_key(F.col(q(left_on))) if casefold else F.col(q(left_on))
    rk = casefold_key(F.col(q(right_on))) if casefold else F.col(q(right_on))
    keys = dim.select(rk.alias("__key")).where(F.col("__key").isNotNull()).distinct()
    miss = df.join(keys, lk == keys["__key"], "left_anti")
    aggs = [(F.sum(F.col(q(count_col))) if count_col else F.count(F.lit(1))).alias("n_rows")]
    if measure:
        aggs.append(F.sum(F.col(q(measure))).alias(measure))
    return miss.groupBy(F.col(q(left_on))).agg(*aggs)


def apply_unmatched_policy(df: DataFrame, category: str, policy: str = "bucket",
                           bucket: str = "Divers") -> DataFrame:
    """J4 policy after a left lookup: ``drop`` misses or put them in ``bucket``.

    (``error`` is :func:`assert_all_matched`, which needs an action.)
    """
    if policy == "drop":
        return df.where(F.col(q(category)).isNotNull())
    if policy == "bucket":
        return df.withColumn(category, F.coalesce(F.col(q(category)), F.lit(bucket)))
    raise ValueError(f"unknown policy {policy!r}")


def assert_all_matched(df: DataFrame, category: str) -> None:
    """Fail if any row of a left lookup found no match (bounded action)."""
    if df.where(F.col(q(category)).isNull()).limit(1).count():
        raise ValueError(f"unmatched lookup keys: no {category}")


def category_rank(category: Column, categories: Sequence[str]) -> Column:
    """1-based position of a category in the fixed list; 0 if absent."""
    return F.array_position(F.array(*[F.lit(c) for c in categories]), category)


def winner_category(tallied: DataFrame, group: Sequence[str], category: str, votes: str,
                    categories: Sequence[str], out: str = "winner") -> DataFrame:
    """Category with the most votes per group; ties go to the earlier listed one.

    Only listed categories with votes can win.  ``max_by`` over ``struct(votes, -rank)``
    gives a total order, so the result does not depend on row order.
    """
    rank = category_rank(F.col(q(category)), categories)
    return (tallied.where((rank > 0) & (F.col(q(votes)) > 0))
            .groupBy(*[F.col(q(g)) for g in group])
            .agg(F.max_by(F.col(q(category)), F.struct(F.col(q(votes)), -rank)).alias(out)))


def winner_of_columns(wide: DataFrame, columns: Sequence[tuple[str, str]],
                      out: str = "winner") -> DataFrame:
    """A9 on a zero-filled pivot: per row, the label of the largest column.

    ``columns`` is ``[(column, label), ...]`` in list order; ties go to the
    earlier one and a row without any positive votes has no winner.  This is
    a row-wise expression (no aggregation, no shuffle).
    """
    ranked = [F.struct(F.col(q(c)).alias("v"), F.lit(-i).alias("r"), F.lit(label).alias("c"))
              for i, (c, label) in enumerate(columns)]
    best = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    return wide.withColumn(out, F.when(best["v"] > 0, best["c"]))


def winner_item(tallied: DataFrame, group: Sequence[str], item: str, votes: str,
                ordinal: str | Sequence[str], out: str = "winner_item") -> DataFrame:
    """First half of A10: the single biggest item per group; ties -> lowest ordinal.

    ``ordinal`` is one or more columns (numbers or text) giving the tie
    order.  One aggregation over the tally: ``min_by`` over
    ``struct(-votes, ordinal...)``.  (A max-then-join-back variant would
    compute the tally twice; this sort-based aggregation reads it once.)
    """
    ords = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    order = F.struct(-F.col(q(votes)), *[F.col(q(o)) for o in ords])
    return (tallied.where(F.col(q(votes)).isNotNull())
            .groupBy(*[F.col(q(g)) for g in group])
            .agg(F.min_by(F.col(q(item)), order).alias(out)))


def shares(wide: DataFrame, total_col: str, categories: Sequence[str],
           prefix: str = "share_", residual: str | None = "share_residual") -> DataFrame:
    """A11 (+X5): each category column as a percentage of the group total.

    Votes outside the listed categories stay in the denominator; their
    share is reported as ``residual`` instead of being hidden.
    """
    cols = {f"{prefix}{c}": share(F.col(q(c)), F.col(q(total_col))) for c in categories}
    if residual:
        listed = sum([F.col(q(c)) for c in categories][1:], F.col(q(categories[0])))
        cols[residual] = share(F.col(q(total_col)) - listed, F.col(q(total_col)))
    return wide.withColumns(cols)
