"""Grouped aggregates on built-in functions.

Counts, sums and extremes combine within each task before the shuffle, so a
key that holds a third of all rows sends one row per task, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_count_max(
    df: DataFrame, keys: Sequence[str], counted: str, measured: Column, count_as: str, max_as: str
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(counted).alias(count_as), F.max(measured).alias(max_as))


def group_count_sum(
    df: DataFrame, keys: Sequence[str], summed: Column, count_as: str = "cnt", sum_as: str = "sum"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_as), F.sum(summed).alias(sum_as))


def top_per_group(df: DataFrame, keys: Sequence[str], value: str, n: int = 2) -> DataFrame:
    """The ``n`` largest values per key, equal ones each on a row of their own.

    A zero uses up a place but is not returned; NULLs are neither. The rank
    filter sits right on the window, which lets Spark keep only ``n`` rows per
    key in each task before the shuffle.
    """
    largest_first = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    ranked = df.select(*keys, value).withColumn("__rank", F.row_number().over(largest_first))
    return ranked.filter(F.col("__rank") <= n).filter(F.col(value) != 0).drop("__rank")


def top_of_changes(df: DataFrame, keys: Sequence[str], value: str, n: int = 2, op: str = "op") -> DataFrame:
    """``top_per_group`` over what a change log leaves: rows whose op starts with ``-`` take a value back.

    A value counts as often as it was given more than taken back. These sums
    combine before the shuffle, and a value given a million times is ``n`` rows.
    """
    sign = F.when(F.col(op).startswith("-"), -1).otherwise(1)
    left = df.groupBy(*keys, value).agg(F.sum(sign).alias("__n")).filter("__n > 0")
    times = F.sequence(F.lit(1), F.least(F.col("__n"), F.lit(n)).cast("int"))
    return top_per_group(left.select(*keys, value, F.explode(times)), keys, value, n)
