"""Projections, renames and filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from periodfact.functions import casefold_key


def q(name: str) -> str:
    """Backtick-quote a column name (names may hold spaces, dots, parentheses)."""
    return "`" + name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns of ``df`` in schema order, minus ``exclude``."""
    banned = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in banned]


def round_columns(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """Half-up rounding of several columns in one projection."""
    return df.withColumns({c: F.round(F.col(q(c)), scale) for c in cols})


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """Keep the first ``n`` columns."""
    return df.select(*[F.col(q(c)) for c in df.columns[:n]])


def strip_agg_names(df: DataFrame) -> DataFrame:
    """``sum(x)`` / ``avg(x)`` -> ``x``."""
    import re
    pat = re.compile(r"^[a-z_]+\((.*)\)$")
    mapping = {}
    for c in df.columns:
        m = pat.match(c)
        if m:
            mapping[c] = m.group(1)
    return df.withColumnsRenamed(mapping) if mapping else df


def safe_names(names: Sequence[str], max_len: int = 64, keep: int = 54) -> list[str]:
    """P4 on a list: names over ``max_len`` are cut to ``keep`` characters.

    A cut name that collides with an earlier name gets ``_<position>``.
    """
    out: list[str] = []
    seen: set[str] = set()
    for i, name in enumerate(names):
        new = name[:keep] if len(name) > max_len else name
        if new in seen:
            new = f"{new}_{i}"
        seen.add(new)
        out.append(new)
    return out


def safe_column_names(df: DataFrame, max_len: int = 64, keep: int = 54) -> DataFrame:
    """Rename columns whose names exceed a store's identifier limit."""
    return df.toDF(*safe_names(df.columns, max_len, keep))


def measure_gap(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """P5: difference of two measures."""
    return df.withColumn(out, F.col(q(a)) - F.col(q(b)))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Deny list by name (never by position)."""
    return df.drop(*names)


def filter_category(df: DataFrame, col: str, value: str) -> DataFrame:
    """keep rows whose label equals ``value`` ignoring blanks and case."""
    return df.where(casefold_key(F.col(q(col))) == casefold_key(F.lit(value)))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """drop rows (blocks) without a key."""
    cond = None
    for k in keys:
        c = F.col(q(k)).isNotNull() & (F.trim(F.col(q(k)).cast("string")) != "")
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df
