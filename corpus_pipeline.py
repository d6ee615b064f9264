"""A corpus made ready for training: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.  A stage's file goes once the next
stage is written; the last one, which the returned plan reads, stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodfact.llm import neardup, packing, quality, secret_scan, toxicity
from periodfact.llm.common import remove, table, written
from periodfact.llm.queries import RANKS, vocabulary
from periodfact.session import ensure_checkpoint_dir, scratch_path, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model holds for toxic go."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return quality.reject(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of the smallest id."""
    return neardup.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked in the text; ``n_chars`` follows."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs, vocabulary(RANKS))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]

#: Classifier, near-duplicate search and packing have no SQL form: tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = written(stage(spark, docs, sf_dir), path)
        if before is not None:
            remove(before)  # the stage that read it has been written
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
