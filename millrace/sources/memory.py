"""In-memory rows: tables with inferred types and streams with declared ones."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_elements(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small table with named columns; types come from the Python values."""
    return spark.createDataFrame(list(rows), list(names))


def from_collection(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table with declared types, checked against the values."""
    return spark.createDataFrame(list(rows), schema)


def replay(
    spark: SparkSession, batches: Iterable[Sequence[tuple]], schema: T.StructType | str, folder: str
) -> DataFrame:
    """A stream that delivers each element of ``batches`` as one micro-batch.

    One file per batch is appended in order; the file source reads them oldest
    first, one per trigger.
    """
    read_schema = schema
    for batch in batches:
        frame = spark.createDataFrame(list(batch), schema).coalesce(1)
        read_schema = frame.schema
        frame.write.mode("append").json(folder)
    return spark.readStream.schema(read_schema).option("maxFilesPerTrigger", 1).json(folder)
