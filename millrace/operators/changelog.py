"""Grouped aggregates as a change log, batch form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import running_aggregates


def changelog_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    arrival: str,
    aggregates: Mapping[str, tuple[str, str]],
    chunks: int | None = None,
) -> DataFrame:
    """What a per-record aggregation emits when rows arrive by ``arrival``.

    The first row of a key inserts (``+I``). A later one takes back the old
    result (``-U``) and gives the new (``+U``), or emits nothing when the
    result stays the same. Columns: keys, ``arrival``, ``op``, the aggregates.
    """
    names = list(aggregates)
    inner = {**aggregates, "__seen": ("count", "__one")}
    previous = {**{f"__old_{n}": n for n in names}, "__seen_before": "__seen"}
    columns = list(dict.fromkeys([*keys, arrival, *[c for _, c in aggregates.values()]]))
    rows = running_aggregates(
        df.select(*columns).withColumn("__one", F.lit(1)), keys, [arrival], inner, previous, chunks
    )

    def change(op: str, prefix: str) -> Column:
        return F.struct(F.lit(op).alias("op"), *[F.col(f"{prefix}{n}").alias(n) for n in names])

    same = reduce(Column.__and__, [F.col(f"__old_{n}").eqNullSafe(F.col(n)) for n in names])
    changes = (
        F.when(F.col("__seen_before") == 0, F.array(change("+I", "")))
        .when(~same, F.array(change("-U", "__old_"), change("+U", "")))
    )
    return rows.select(*keys, arrival, F.explode(changes).alias("c")).select(*keys, arrival, "c.*")
