"""Plans: the registered verification queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from periodfact.plans import queries as Q

FLAGSHIP = "period_fact"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name in dir(Q):
        if name.startswith("q_"):
            out[name[2:]] = getattr(Q, name)
    from periodfact.plans import facts, learning
    out.update(learning.queries())
    out.update(facts.queries())
    return out


def oracle_sql() -> dict[str, str]:
    from periodfact.plans import oracle, oracle_facts
    return oracle.oracle_sql() | oracle_facts.oracle_sql()


__all__ = ["queries", "oracle_sql", "FLAGSHIP"]
