"""Declared table schemas (K2): names, types and what happens to values that don't fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from periodfact.operators.columns import q


@dataclass(frozen=True)
class Contract:
    """The columns of a stored table, in order: (name, SQL type).

    ``misfits``: a value that its type can't hold becomes null and is counted
    (``count``), or fails the job (``error``).
    """

    columns: Sequence[tuple[str, str]]
    misfits: str = "count"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


def conform(df: DataFrame, contract: Contract, sources: Mapping[str, str] | None = None,
            constants: Mapping[str, Column] | None = None, rejects: Observation | None = None) -> DataFrame:
    """Exactly the contract's columns, in its order and types.

    ``sources`` maps a contract column to the frame's column of another name;
    ``constants`` gives columns that the frame doesn't have.  A column found in
    neither fails at once: nothing is filled in silently.  ``rejects`` counts
    the rows and, for each column, the values that became null, while the frame
    is written (no second pass; a global sort between the two would read, and
    count, some rows twice).
    """
    sources, constants = dict(sources or {}), dict(constants or {})
    if contract.misfits not in ("count", "error"):
        raise ValueError(f"unknown handling {contract.misfits!r}")
    unknown = [c for c in [*sources, *constants] if c not in contract.names]
    if unknown:
        raise ValueError(f"not in the contract: {unknown}")
    values = {name: constants[name] if name in constants else F.col(q(sources.get(name, name))) for name in contract.names}
    absent = [name for name in contract.names if name not in constants and sources.get(name, name) not in df.columns]
    if absent:
        raise ValueError(f"columns of the contract that the frame lacks: {absent}")

    def stored(name: str, kind: str) -> Column:
        value, fitted = values[name], values[name].try_cast(kind)
        if kind.startswith("varchar"):
            room = int(kind[kind.index("(") + 1:-1])
            value = value.cast("string")
            fitted = F.when(F.length(value) <= room, value)
        if contract.misfits == "error":
            lost = F.raise_error(F.concat(F.lit(f"{name} does not fit {kind}: "), value.cast("string"))).cast(fitted_type(kind))
            fitted = F.when(value.isNotNull() & fitted.isNull(), lost).otherwise(fitted)
        return fitted

    if rejects is not None:
        lost = [F.count_if(values[n].isNotNull() & stored(n, t).isNull()).alias(n) for n, t in contract.columns]
        df = df.observe(rejects, F.count("*").alias("rows"), *lost)
    return df.select(*[stored(n, t).cast(fitted_type(t)).alias(n) for n, t in contract.columns])


def fitted_type(kind: str) -> str:
    """The type of a frame's column: text of a bounded length is a string there."""
    return "string" if kind.startswith("varchar") else kind
