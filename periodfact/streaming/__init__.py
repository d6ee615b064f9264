"""Incremental fact building with Structured Streaming.

The reference rebuilds its fact by looping over years and appending a row
whenever a result file for that year exists.  Here the folder of period
files is a streaming file source: each trigger picks up only the files
that arrived since the last one, builds their fact rows with the same
batch operators, and appends them.  Progress lives in a checkpoint under
the shared ``spark.checkpoint.dir``; every micro-batch writes its own
folder in overwrite mode, so a retried batch replaces its own output
instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from periodfact.session import ensure_checkpoint_dir
from periodfact.sources import period_from_path


def stream_period_files(spark: SparkSession, folder: str, schema: StructType | str,
                        period_pattern: str, file_glob: str = "*.csv", sep: str = ";",
                        period: str = "period", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of period files (header CSV) with the period from the file name."""
    reader = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
              .option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder).withColumn(period, period_from_path(period_pattern))


def append_facts_stream(stream: DataFrame, build_fact: Callable[[DataFrame], DataFrame],
                        target: str, name: str, once: bool = True) -> StreamingQuery:
    """Run ``build_fact`` on every new batch of rows and append its result.

    ``once=True`` processes what is there and stops (``availableNow``),
    which is how a scheduled job catches up; otherwise the query keeps
    running.  Output goes to ``target/batch=<id>`` (overwrite), which keeps
    a retried batch idempotent; read ``target`` to see all facts.
    """
    spark = stream.sparkSession
    checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/periodfact-streams/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fact = build_fact(batch)
        fact.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
