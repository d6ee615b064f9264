"""Inputs of the verification plans: the driver's parquet tables.

Periods, items, codes and categories are mapped onto those tables as
follows (domain words are configuration, the operators are generic):

* period  = year of ``l_shipdate`` / ``o_orderdate`` (1995-2001)
* item    = ``l_partkey`` (a candidate or list), votes = ``l_quantity``
* code    = ``p_brand`` (a party code, 25 values)
* category = ``p_type`` (an orientation, 6 values) plus ``ABSENT``, a
  listed category with no data, which exercises the zero fill
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodfact.operators.periods import with_period

# The category list of the verification fact, in list order
# (order decides winner ties and column order).
CATEGORIES = ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO", "ABSENT"]

# Second family's lookup, market segment -> category.
SEGMENT_CATEGORY = [
    ("AUTOMOBILE", "LARGE"),
    ("BUILDING", "STANDARD"),
    ("FURNITURE", "MEDIUM"),
    ("HOUSEHOLD", "SMALL"),
    ("MACHINERY", "ECONOMY"),
]


def col_name(category: str) -> str:
    return category.lower()


_READS: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a DataFrame; one relation per (session, path) is reused,
    so listing the files and reading the footers happens once per plan set."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str],
                  ordinal: str | None = "ordinal") -> DataFrame:
    """A small fixed table as a local relation (no Python worker at run time),
    with its list position as an explicit ordinal for first-match lookups."""
    from pyspark.sql import functions as F
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)],
                        *([F.lit(i).cast("long").alias(ordinal)] if ordinal else []))
               for i, r in enumerate(rows)]
    return spark.range(1).select(F.inline(F.array(*structs)))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_period(read(spark, sf_dir, "lineitem"), "l_shipdate")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_period(read(spark, sf_dir, "orders"), "o_orderdate")


#: Rows that one task sorts and gathers.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over tasks of about ``TASK_ROWS`` of its ``rows``.

    Up to a task for each core is left to Spark; beyond, a fixed number of
    shuffle partitions would let the memory of a task grow with the table.
    """
    spark = df.sparkSession
    tasks, width = -(-rows // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df if tasks <= min(width, spark.sparkContext.defaultParallelism) else df.repartition(max(tasks, width), *keys)
