"""Sources: delimited files, period-stamped file sets, database tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def positional_schema(n_cols: int, types: Mapping[int, object] | None = None,
                      prefix: str = "c") -> StructType:
    """``c0..c{n-1}`` as the schema of a file with duplicated headers.

    With ``header=True`` and an explicit schema the reader skips the header
    line and binds columns by position, so duplicate or drifting header
    names (``Prenom`` / ``Prénom``) no longer matter.
    """
    types = dict(types or {})
    return StructType([StructField(f"{prefix}{i}", types.get(i, StringType()), True)
                       for i in range(n_cols)])


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
                   sep: str = ";", encoding: str = "UTF-8", header: bool = True,
                   keep_corrupt: bool = False, **options: str) -> DataFrame:
    """Header CSV, semicolon, UTF-8.

    With a schema nothing is inferred (no extra pass over the data).  The
    fallback infers types, which reads the input twice: fine for small
    indicator files only.  ``keep_corrupt`` adds ``_corrupt_record`` for rows
    that do not fit the schema (PERMISSIVE mode) so they can be reported.
    """
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        if keep_corrupt:
            if isinstance(schema, str):
                schema = StructType.fromDDL(schema)
            schema = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_sources(spark: SparkSession, catalog: Mapping[str, object], **defaults) -> dict[str, DataFrame]:
    """A named set of sources; values are a path or ``(path, schema)``. Lazy."""
    out = {}
    for name, spec in catalog.items():
        path, schema = (spec if isinstance(spec, tuple) else (spec, None))
        out[name] = read_delimited(spark, path, schema, **defaults)
    return out


def period_from_path(pattern: str, group: int = 1) -> F.Column:
    """Integer period taken from the source file path by a regex group."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group).try_cast("int")


def read_period_files(spark: SparkSession, glob: str | list[str], period_pattern: str,
                      schema: StructType | str | None = None, period: str = "period",
                      **options) -> DataFrame:
    """S3: every file of a family in one scan, the period taken from its name.

    Files that do not exist are simply not matched by the glob (no
    per-period existence check on the driver).  Files in one call must share
    a layout; group files by (layout, column count) and call once per group.
    """
    df = read_delimited(spark, glob, schema, **options)
    return df.withColumn(period, period_from_path(period_pattern))


def read_lines(spark: SparkSession, glob: str | list[str], period_pattern: str, header: bool = False,
               encoding: str = "UTF-8") -> DataFrame:
    """S3 for ragged files: file, period, line of every line, whatever its width, in one scan.

    With ``header`` the first line of each file is left out; without, header
    lines are rows like others (see :mod:`periodfact.operators.ragged`).
    """
    lines = read_delimited(spark, glob, "line string", sep="\x01", encoding=encoding, header=header, quote="", escape="\x01")
    return lines.select(F.col("_metadata.file_path").alias("file"), period_from_path(period_pattern).alias("period"), "line")


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table as a DataFrame; parallel when a partition column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def read_store(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read back a table written by :mod:`periodfact.sinks` (Parquet by default)."""
    return spark.read.format(fmt).load(path)


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows the reader could not fit to the schema, with their raw text."""
    return df.where(F.col(CORRUPT).isNotNull()).select(*df.columns)


def reject_report(df: DataFrame) -> DataFrame:
    """One row: rows read, rows rejected by the schema, in the parsing pass.

    (Spark refuses a raw-file query that references only the corrupt record
    column, so the report also counts the first parsed column.)
    """
    first = [c for c in df.columns if c != CORRUPT][0]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(CORRUPT)).alias("rejected"),
                  F.count(F.col(first)).alias(f"non_null_{first}"))


def count_files(spark: SparkSession, pattern: str) -> int:
    """Number of paths a glob matches (one file-system listing on the driver)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return 0 if found is None else len(found)


def files_exist(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches anything."""
    return count_files(spark, pattern) > 0
