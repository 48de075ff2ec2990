"""Inputs that Spark derives from the driver tables, row for row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.jsons import json_value
from millrace.functions.scalars import ISO_SECONDS, to_bigint
from millrace.session import scratch_dir
from millrace.sources.endpoints import Endpoint, text_files
from millrace.sources.tables import load_table

ROW = "id BIGINT, name STRING, segment STRING, balance DOUBLE"


def k() -> Column:
    return to_bigint(json_value(F.col("props"), "$.k"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "events")


def events_with_k(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).withColumn("k", k())


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """(id, data): every event as nested JSON text."""
    data = F.struct(
        F.col("event_type").alias("kind"),
        k().alias("score"),
        F.struct(F.col("user_id").cast("string").alias("user"), F.date_format("ts", ISO_SECONDS).alias("at")).alias("seen"),
    )
    return events(spark, folder).select(F.col("event_id").alias("id"), F.to_json(data).alias("data"))


def mixed_strings(spark: SparkSession, folder: str) -> DataFrame:
    """(event_id, value): event properties; those of error events are cut short."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    value = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    return events(spark, folder).select("event_id", value.alias("value"))


def change_events(spark: SparkSession, folder: str) -> DataFrame:
    """(value): customers as change events; the segment decides on the kind."""
    segment = F.col("c_mktsegment")

    def image(balance: Column) -> Column:
        return F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            segment.alias("segment"),
            balance.alias("balance"),
        )

    op = F.when(segment == "BUILDING", "c").when(segment == "MACHINERY", "d").otherwise("u")
    envelope = F.struct(
        F.struct(F.lit("customers").alias("table_name"), F.lit("0001").alias("commit_lsn")).alias("source"),
        op.alias("op"),
        (F.col("c_custkey") * 1000).alias("ts_ms"),
        F.when(op != "c", image(F.col("c_acctbal"))).alias("before"),
        F.when(op != "d", image(-F.col("c_acctbal"))).alias("after"),
    )
    return load_table(spark, folder, "customer").select(F.to_json(envelope).alias("value"))


def as_topic(strings: DataFrame, label: str) -> Endpoint:
    """Strings laid down as text files, the stand-in for a topic."""
    folder = scratch_dir(strings.sparkSession, label)
    strings.select("value").write.text(folder)
    return text_files(folder)


def empty_topic(spark: SparkSession, label: str) -> Endpoint:
    return text_files(scratch_dir(spark, label))
