"""Where string events come from and go to.

An endpoint is a format name with options. Every job takes endpoints, so the
same job runs on a broker in production and on folders of text files in tests.
The broker format needs the public ``spark-sql-kafka-0-10`` package on the
submit command line.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsons import STRICT, is_json


@dataclass(frozen=True)
class Endpoint:
    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None


def kafka_source(
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    partitions: Sequence[int] | None = None,
) -> Endpoint:
    """A topic, or chosen partitions of it, read from ``starting_offsets``.

    Lost data stops the query. ``max_offsets_per_trigger`` bounds what one
    micro-batch, and so one hot key within it, can hold; nothing is skipped.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: list(partitions)})
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return Endpoint("kafka", options)


def kafka_sink(servers: str, topic: str) -> Endpoint:
    return Endpoint("kafka", {"kafka.bootstrap.servers": servers, "topic": topic})


def text_files(path: str, max_files_per_trigger: int | None = None, extension: str | None = None) -> Endpoint:
    """One event per line."""
    options = {}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if extension:
        options["extension"] = extension
    return Endpoint("text", options, path)


def kafka_partition_sources(servers: str, topic: str, partitions: int, **kwargs) -> list[Endpoint]:
    """One endpoint per partition, to give each a watermark of its own."""
    return [kafka_source(servers, topic, partitions=[p], **kwargs) for p in range(partitions)]


def _as_strings(df: DataFrame, also: Sequence[str]) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"), *also)


def read_strings(spark: SparkSession, source: Endpoint, also: Sequence[str] = ()) -> DataFrame:
    """Batch read of the events as one ``value STRING`` column.

    ``also`` names further columns of the source to keep, such as a broker
    record's own ``timestamp``.
    """
    return _as_strings(spark.read.format(source.format).options(**source.options).load(source.path), also)


def stream_strings(spark: SparkSession, source: Endpoint, also: Sequence[str] = ()) -> DataFrame:
    """Streaming form of ``read_strings``."""
    return _as_strings(spark.readStream.format(source.format).options(**source.options).load(source.path), also)


BAD = "__bad"


def json_rows(strings: DataFrame, schema: T.StructType | str, bad: str = "fail") -> DataFrame:
    """Typed rows from JSON strings, read strictly.

    An event that is not JSON, is no object or does not fit the schema ends the
    job (``bad="fail"``) or is left out (``"drop"``); ``bad_events`` gives
    those left out. NULL events are bad.
    """
    if bad not in ("fail", "drop"):
        raise ValueError(f"bad is fail or drop, not {bad!r}")
    parsed = strings.select(_parsed(schema).alias("j"), F.col("value"))
    if bad == "drop":
        return parsed.filter(_fits()).select("j.*").drop(BAD)
    message = F.concat(F.lit("not an event of this schema: "), F.coalesce(F.col("value"), F.lit("NULL")))
    checked = F.when(_fits(), F.col("j")).otherwise(F.raise_error(message))
    return parsed.select(checked.alias("j")).select("j.*").drop(BAD)


def bad_events(strings: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The events (``value``) that ``json_rows`` refuses, for dead letters."""
    return strings.withColumn("j", _parsed(schema)).filter(~_fits()).select("value")


def _parsed(schema: T.StructType | str) -> Column:
    fields = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*fields.fields, T.StructField(BAD, T.StringType())])
    return F.from_json("value", marked, {**STRICT, "columnNameOfCorruptRecord": BAD})


def _fits() -> Column:
    # Of an array the reader takes the first element, and of text after an object it takes no notice.
    is_object = is_json(F.col("value")) & F.coalesce(F.col("value").rlike(r"^\s*\{"), F.lit(False))
    return is_object & F.col("j").isNotNull() & F.col(f"j.{BAD}").isNull()


def stream_json_rows(spark: SparkSession, source: Endpoint, schema: T.StructType | str, bad: str = "fail") -> DataFrame:
    return json_rows(stream_strings(spark, source), schema, bad)


def register_stream_table(
    spark: SparkSession, name: str, source: Endpoint, schema: T.StructType | str, bad: str = "fail"
) -> DataFrame:
    """Name a JSON event stream so SQL can select from it."""
    df = stream_json_rows(spark, source, schema, bad)
    df.createOrReplaceTempView(name)
    return df
