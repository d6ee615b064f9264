"""Connected components over a table of links, wholly as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed


def _size(links: DataFrame) -> tuple:
    """Tells two sets of links apart: their number and a sum of hashes (one row)."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """id, comp: the smallest id that each linked id can reach; the smallest ids themselves aren't listed.

    Large and small stars in turn: each id's links are moved to the smallest id
    that it sees, first those to larger ids, then those to smaller ones.  The
    number of rounds grows with the logarithm of the longest chain.  ``links``
    has columns a < b; an empty table gives an empty result.
    """
    now = checkpointed(links.select("a", "b").distinct())
    size = _size(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct())
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        now = checkpointed(small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                           .union(small.select(F.col("m").alias("a"), "b")).distinct())
        before, size = size, _size(now)
        if size == before:
            break
    return now.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("comp"))
