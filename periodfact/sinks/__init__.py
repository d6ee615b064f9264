"""Sinks: whole-table replace, fact append, model results (K1-K4).

Writes are distributed DataFrame writes (no ``toPandas``) and atomic per
job through Spark's commit protocol; nothing goes row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def save_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: Sequence[str] = ()) -> None:
    """K1: replace (or append to) a table: a path, or a catalog table name."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target or ":" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
              properties: Mapping[str, str] | None = None, num_partitions: int | None = None) -> None:
    """K1 for a database: the writer's own JDBC path, one connection per task."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def append_facts(facts: DataFrame, target: str, fmt: str = "parquet",
                 partition_by: Sequence[str] = ("family",)) -> None:
    """K3: append the fact rows of all families in one write."""
    save_table(facts, target, mode="append", fmt=fmt, partition_by=partition_by)


def replace_facts(facts: DataFrame, target: str, fmt: str = "parquet",
                  keys: Sequence[str] = ("family", "period")) -> None:
    """K3, repeatable: the rows of every (family, period) in ``facts`` take the place of those stored before.

    Partitions that ``facts`` doesn't touch stay, so the same append can run
    again (after a failure, or with corrected files) without doubling a row.
    One task writes each partition, whose rows are few.
    """
    (facts.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(*keys).save(target))


def save_results(scores: DataFrame, predictions: DataFrame, target_dir: str,
                 fmt: str = "parquet") -> None:
    """K4: replace the model-score and prediction tables."""
    base = target_dir.rstrip("/")
    save_table(scores, f"{base}/model_scores", fmt=fmt)
    save_table(predictions, f"{base}/future_predictions", fmt=fmt)
