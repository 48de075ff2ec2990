"""Row filters, limits and distinct rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsons import is_json


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is true; NULL is not."""
    return df.filter(condition)


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def limit_rows(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """The first ``n`` rows, by ``order_by`` if given, else as they arrive.

    With an order Spark keeps ``n`` rows per task and merges those, so nothing
    is sorted as a whole.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations, deduplicated within each task before the shuffle.

    On a stream every combination seen is kept as state, and each is emitted
    once, when it first arrives.
    """
    chosen = df.select(*columns) if columns else df
    return chosen.dropDuplicates()


def distinct_within_watermark(df: DataFrame, *columns: str) -> DataFrame:
    """First rows of combinations on a watermarked stream.

    State of a combination is dropped once the watermark has passed it, so it
    stays bounded; a repetition later than that counts as new.
    """
    return df.dropDuplicatesWithinWatermark(list(columns))


def with_validity(df: DataFrame, column: str = "value", flag: str = "valid") -> DataFrame:
    """Mark, in one pass, the rows whose text is JSON."""
    return df.withColumn(flag, is_json(F.col(column)))


def split_by_validity(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows whose text is JSON, and the rest for a dead-letter output."""
    valid = is_json(F.col(column))
    return df.filter(valid), df.filter(~valid)
