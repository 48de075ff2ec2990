"""Running aggregates per key that do not need a key to fit in one task.

Rows are range-partitioned by key and order, so a large key is cut into many
chunks of even size. Every chunk is scanned on its own, and what the earlier
chunks of the same key add up to is carried in. A plain window over ``PARTITION
BY key``, which sorts all rows of a key in one task, is there for callers who
know that their keys are small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

_CHUNK = "__chunk"

_FOLD = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "xor": F.bit_xor}


def _combine(kind: str, earlier: Column, later: Column) -> Column:
    if kind == "max":
        return F.greatest(earlier, later)
    if kind == "min":
        return F.least(earlier, later)
    both = earlier.bitwiseXOR(later) if kind == "xor" else earlier + later
    return F.when(earlier.isNull(), later).when(later.isNull(), earlier).otherwise(both)


def running_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
    previous: Mapping[str, str] | None = None,
    chunks: int | None = None,
    plain: bool = False,
) -> DataFrame:
    """Add, to every row, aggregates over the rows of its key up to it.

    ``aggregates`` maps a new column to (``sum`` | ``count`` | ``max`` |
    ``min`` | ``xor``, column). ``previous`` maps a new column to one of those names and
    gives its value before the row. ``order_by`` must be unique within a key.

    ``chunks`` asks for a cut into about so many. ``plain`` asks for one window
    per key instead, for keys that each fit one task.
    """
    previous = dict(previous or {})
    if plain:
        return df.select("*", *_scan(keys, order_by, aggregates, previous))
    return _in_chunks(df, keys, order_by, aggregates, previous, chunks)


def _scan(
    partition: Sequence[str],
    order_by: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
    previous: Mapping[str, str],
    prefix: str = "",
) -> list[Column]:
    ordered = Window.partitionBy(*partition).orderBy(*order_by)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return [
        *[_FOLD[kind](c).over(upto).alias(f"{prefix}{n}") for n, (kind, c) in aggregates.items()],
        *[_FOLD[aggregates[n][0]](aggregates[n][1]).over(before).alias(f"{prefix}{p}") for p, n in previous.items()],
    ]


def _in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    aggregates: Mapping[str, tuple[str, str]],
    previous: Mapping[str, str],
    chunks: int | None,
) -> DataFrame:
    # Written out once: the row and the carry side then see the same cut even
    # if executors are lost, and the carry side reads only what it adds up.
    spread = [*keys, *order_by]
    cut = df.repartitionByRange(chunks, *spread) if chunks else df.repartitionByRange(*spread)
    path = scratch_dir(df.sparkSession, "chunks")
    cut.withColumn(_CHUNK, F.spark_partition_id()).write.parquet(path)
    cut = df.sparkSession.read.schema(cut.withColumn(_CHUNK, F.lit(0)).schema).parquet(path)

    # One row per key and chunk. Only keys spanning chunks need a carry; a cut
    # crosses one key at most, so there are less than twice as many such rows
    # as chunks, which bounds both the windows and the broadcast.
    per_chunk = cut.groupBy(*keys, _CHUNK).agg(*[_FOLD[kind](c).alias(n) for n, (kind, c) in aggregates.items()])
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: "sum" if kind == "count" else kind for n, (kind, _) in aggregates.items()}
    carry = per_chunk.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.col(_CHUNK).alias("__key_chunk"),
        F.row_number().over(by_chunk).alias("__nth"),
        *[_FOLD[kind](n).over(earlier).alias(f"__carry_{n}") for n, kind in carried.items()],
    ).filter("__nth > 1").drop("__nth")

    local = cut.select("*", *_scan([_CHUNK, *keys], order_by, aggregates, previous, prefix="__local_"))
    same = [local[_CHUNK] == carry["__key_chunk"], *[local[k].eqNullSafe(carry[f"__key_{k}"]) for k in keys]]
    joined = local.join(F.broadcast(carry), reduce(Column.__and__, same), "left")
    source = {**{n: n for n in aggregates}, **previous}
    return joined.select(
        *df.columns,
        *[
            _combine(aggregates[n][0], F.col(f"__carry_{n}"), F.col(f"__local_{name}")).alias(name)
            for name, n in source.items()
        ],
    )
