"""Inner joins and lateral table functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import split_text


def join_inner(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner equi-join on (left name, right name) pairs; all columns are kept.

    No side is forced to broadcast: Spark does that below its size threshold
    and otherwise sorts and merges, splitting keys that turn out skewed.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"rename before joining, on both sides: {sorted(clash)}")
    condition = [left[l] == right[r] for l, r in on]
    return left.join(right, condition, "inner")


def join_within(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str, right_time: str, within: str
) -> DataFrame:
    """Inner equi-join of rows whose right time is at most ``within`` after the left one.

    On streams with watermarks on both times, state is freed once the watermark
    has passed what a row can still meet. A hot key sits in one state partition,
    as state is not split at run time; the time bound is what limits it.
    """
    latest = F.col(left_time) + F.expr(f"INTERVAL {within}")
    bound = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= latest)
    equal = [F.col(a) == F.col(b) for a, b in on]
    return left.join(right, reduce(Column.__and__, equal, bound), "inner")


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold at least that share of a table's rows; there are at most 1 / share of them."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    return [r[key] for r in counts.filter(F.col("n") >= F.lit(share * total)).select(key).collect()] if total else []


def join_spread(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    hot: Sequence,
    lanes: int,
    join: Callable[[DataFrame, DataFrame, list[tuple[str, str]]], DataFrame] = join_inner,
) -> DataFrame:
    """A join of two streams whose hot keys are spread over ``lanes`` state partitions.

    A stream join keeps all rows of a key in one partition's state, and Spark
    does not split state at run time. Here left rows of the keys in ``hot`` are
    dealt over lanes and the right rows of these keys, which should be the
    fewer, are copied to each. ``hot`` comes from ``heavy_keys`` over rows of
    the past; state is laid out by it, so a query keeps its set for as long as
    it keeps its checkpoint. ``join`` is given both sides and the key pairs;
    bind ``join_within`` to it for a time bound.
    """
    a, b = on
    lane, other = "__lane", "__other_lane"
    is_hot = (lambda c: F.coalesce(F.col(c).isin(list(hot)), F.lit(False))) if hot else (lambda c: F.lit(False))
    dealt = left.withColumn(lane, F.when(is_hot(a), F.pmod(F.xxhash64(*left.columns), F.lit(lanes)).cast("int")).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(lanes - 1))
    copied = right.withColumn(other, F.explode(F.when(is_hot(b), every).otherwise(F.array(F.lit(0)))))
    return join(dealt, copied, [on, (lane, other)]).drop(lane, other)


def lateral_split(df: DataFrame, column: str, separator: str, alias: str) -> DataFrame:
    """One row per piece of a text column, beside the row it came from."""
    return df.withColumn(alias, F.explode(split_text(F.col(column), separator)))


def table_function(fn: Callable, return_type: str):
    """A Python generator function as a table function.

    Rows go to Python pickled, a batch at a time: the Arrow form builds a data
    frame per input row, which took some twenty times as long when measured.
    """

    class Rows:
        def eval(self, *args):
            yield from fn(*args)

    return F.udtf(Rows, returnType=return_type, useArrow=False)


def register_table_function(spark: SparkSession, name: str, fn: Callable, return_type: str):
    """Make a generator function callable in SQL as ``LATERAL name(...)``."""
    return spark.udtf.register(name, table_function(fn, return_type))


def join_lateral(df: DataFrame, function, *args: str | Column) -> DataFrame:
    """Each row beside every row the table function yields for it.

    Pass just the columns the function reads: only those go to Python.
    """
    columns = [F.col(a) if isinstance(a, str) else a for a in args]
    return df.lateralJoin(function(*[c.outer() for c in columns]))


def flat_map(df: DataFrame, function, *args: str | Column) -> DataFrame:
    """Only the rows the table function yields, named f0, f1, ... ."""
    wide = join_lateral(df, function, *args)
    made = wide.columns[len(df.columns):]
    start = len(df.columns)
    names = [f"c{i}" for i in range(start)] + [f"f{i}" for i in range(len(made))]
    return wide.toDF(*names).select(*names[start:])
