"""Keyed sums read out by event-time timers, batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import running_aggregates


def keyed_sum_at_timers(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    delay_seconds: int = 2,
    timer_as: str = "timer",
    sum_as: str = "sum",
    chunks: int | None = None,
) -> DataFrame:
    """For every key and distinct time t: the sum over rows up to t + delay.

    Rows and timers are put on one time line per key, rows before timers of
    the same instant, and the running sum is read at the timers. A row without
    a time comes before all others and has no timer. Rows of one
    key and instant are added up first, in the tasks that read them.
    """
    at = df.groupBy(*keys, time).agg(F.sum(value).alias("__v"))
    steps = F.array(
        F.struct(F.col(time).alias("at"), F.lit(0).alias("is_timer"), F.col("__v").alias("v")),
        F.struct(
            (F.col(time) + F.expr(f"INTERVAL {delay_seconds} SECONDS")).alias("at"),
            F.lit(1).alias("is_timer"),
            F.lit(None).cast(at.schema["__v"].dataType).alias("v"),
        ),
    )
    line = at.select(*keys, F.inline(steps))
    summed = running_aggregates(line, keys, ["at", "is_timer"], {"__sum": ("sum", "v")}, chunks=chunks)
    return summed.filter("is_timer = 1 AND at IS NOT NULL").select(
        *keys, F.col("at").alias(timer_as), F.col("__sum").alias(sum_as)
    )
