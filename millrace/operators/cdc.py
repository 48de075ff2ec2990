"""Change-data envelopes: forwarding and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import object_parse
from millrace.schemas import CUSTOMER_ROW, cdc_envelope


def cdc_unpack(
    df: DataFrame, column: str = "value", row_schema: str = CUSTOMER_ROW, key: str = "id"
) -> DataFrame:
    """One flat row per change event; tombstones, with a NULL value, are left out, and so are bad events.

    ``before_*`` and ``after_*`` hold the row images, ``key`` comes from
    whichever image is there, and ``changed`` names the fields that differ
    between the two (all fields of a row that was created or deleted).
    """
    fields = T.DataType.fromDDL(row_schema).names
    e = F.col("e")
    # A filter would be moved below the parse and repeat it; an array of one event or none is not.
    parsed = df.select(F.explode(F.filter(F.array(_event(F.col(column), row_schema)), _is_change)).alias("e"))
    before, after = e.getField("before"), e.getField("after")

    def differs(name: str) -> Column:
        return F.when(~before.getField(name).eqNullSafe(after.getField(name)), F.lit(name))

    return parsed.select(
        e.getField("op").alias("op"),
        e.getField("source").getField("table_name").alias("table_name"),
        e.getField("source").getField("commit_lsn").alias("commit_lsn"),
        e.getField("ts_ms").alias("ts_ms"),
        F.coalesce(after.getField(key), before.getField(key)).alias(key),
        *[before.getField(n).alias(f"before_{n}") for n in fields],
        *[after.getField(n).alias(f"after_{n}") for n in fields],
        F.array_compact(F.array(*[differs(n) for n in fields])).alias("changed"),
    )


def cdc_dead_letters(df: DataFrame, column: str = "value", row_schema: str = CUSTOMER_ROW) -> DataFrame:
    """Events that are neither a tombstone nor a change event, as they came."""
    return df.filter(F.col(column).isNotNull() & ~_is_change(_event(F.col(column), row_schema)))


def _event(text: Column, row_schema: str) -> Column:
    return object_parse(text, f"STRUCT<{cdc_envelope(row_schema)}>")


def _is_change(e: Column) -> Column:
    """A JSON object with an operation and at least one row image."""
    image = e.getField("before").isNotNull() | e.getField("after").isNotNull()
    return F.coalesce(e.getField("op").isNotNull() & image, F.lit(False))
