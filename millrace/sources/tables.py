"""Parquet tables, in batch and as bounded streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def event_time_schema(schema: T.StructType) -> T.StructType:
    """The same schema with zone-less timestamps read as instants.

    Watermarks are only defined on TIMESTAMP. A read schema, unlike a cast,
    keeps filters on these columns pushable to the scan.
    """
    return T.StructType([
        T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
        for f in schema
    ])


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = table_path(folder, name)
    df = spark.read.parquet(path)
    schema = event_time_schema(df.schema)
    # Sessions set up by this package infer instants, so files are listed once.
    return df if schema == df.schema else spark.read.schema(schema).parquet(path)


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The table as a stream; each trigger takes up to ``max_files_per_trigger`` files.

    The bracketed dot makes the path a pattern. The streaming file source
    accepts a single file only that way, and a directory of files equally.
    """
    path = table_path(folder, name)
    schema = event_time_schema(spark.read.parquet(path).schema)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{folder.rstrip('/')}/{name}[.]parquet")


#: Rows of a file that ``in_batches`` writes, at least.
ROWS_PER_FILE = 200_000


def in_batches(parts: Sequence[DataFrame], folder: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Tables of one schema as a stream that takes each of them as one micro-batch, in this order.

    A source counts files, and a table of many rows is written as several. So
    all are written as equally many, which a trigger takes together: the number
    of micro-batches does not depend on the number of rows, nor does a batch
    hold a part of one table and of the next. Tables without rows are left out,
    and the smallest other decides how many files there are.
    """
    counts = [part.count() for part in parts]
    parts = [part for part, n in zip(parts, counts) if n] or parts[:1]
    files = max(1, min(filter(None, counts), default=0) // rows_per_file)
    for part in parts:
        # Round robin leaves none of the files without rows.
        part.repartition(files).write.option("maxRecordsPerFile", 0).mode("append").parquet(folder)
    return parts[0].sparkSession.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(folder)
