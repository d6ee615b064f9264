"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodfact.session import ensure_checkpoint_dir, scratch_path

#: White space of the word definition used by every contract: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
#: Rows turned into Python objects at a time; bounds a worker's memory beside its Arrow batch.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write to a shared path and read back: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(path: str):
    """(pyarrow's file system, the place in it) of a path as Spark writes it."""
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def remove(path: str) -> None:
    """Delete a folder that ``written`` made and nothing reads any more."""
    fs, folder = file_system(path)
    fs.delete_dir(folder)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``written`` to a fresh folder of the shared scratch space."""
    return written(df, scratch_path(df.sparkSession, name))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``; Spark's cleaner removes it where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set (as this package's sessions do), else it stays."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside ``SPACES``, in order (array of strings)."""
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
