"""Tumbling event-time windows, batch form (the plan is the same on streams)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_bounds(window: Column, start_as: str = "window_start", end_as: str = "window_end") -> list[Column]:
    """Start (inclusive) and end (exclusive) of a window as epoch milliseconds."""
    return [
        F.unix_millis(window.getField("start")).alias(start_as),
        F.unix_millis(window.getField("end")).alias(end_as),
    ]


def tumbling_count(
    df: DataFrame, keys: Sequence[str], time: str, size: str, count_as: str = "cnt"
) -> DataFrame:
    """Rows per key and window; windows are aligned to the epoch."""
    counted = df.groupBy(*keys, F.window(time, size).alias("__w")).agg(F.count("*").alias(count_as))
    return counted.select(*keys, *window_bounds(F.col("__w")), count_as)
