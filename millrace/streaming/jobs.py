"""Event forwarding jobs between endpoints."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.jsons import is_json
from millrace.sinks.writers import as_json_value, stream_to
from millrace.sources.endpoints import Endpoint, stream_strings, text_files


def reserialise(text: Column, indent: int | None = None) -> Column:
    """JSON text parsed and written again, key order kept; NULL stays NULL."""

    @F.pandas_udf("string")
    def rewritten(values: pd.Series) -> pd.Series:
        return values.map(lambda v: json.dumps(json.loads(v), indent=indent), na_action="ignore")

    return rewritten(text)


def forward(
    spark: SparkSession, source: Endpoint, sink: Endpoint, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Every event, unchanged and unchecked."""
    return stream_to(stream_strings(spark, source), sink, checkpoint, available_now)


def forward_valid(
    spark: SparkSession,
    source: Endpoint,
    sink: Endpoint,
    dead_letters: Endpoint,
    checkpoint: str,
    available_now: bool = False,
    rewrite: bool = False,
) -> StreamingQuery:
    """Events that are JSON to ``sink``, the others to ``dead_letters``.

    A bad event never stops the stream. One query reads and checks each event
    once, so both outputs stand at the same offset: on a broker the topic is
    chosen row by row, files are those of ``outcome_files``. ``rewrite``
    normalises the spacing of what is sent on; otherwise texts pass untouched.
    """
    valid = is_json(F.col("value"))
    rows = stream_strings(spark, source).select("value", valid.alias("valid"))
    if rewrite:
        sent = F.when(F.col("valid"), F.col("value"))
        rows = rows.select(F.coalesce(reserialise(sent), "value").alias("value"), "valid")
    if sink.format == "kafka":
        topic = F.when(F.col("valid"), sink.options["topic"]).otherwise(dead_letters.options["topic"])
        options = {k: v for k, v in sink.options.items() if k != "topic"}
        return stream_to(rows.select("value", topic.alias("topic")), Endpoint("kafka", options), checkpoint, available_now)
    folder, _, name = sink.path.rpartition("/")
    if name != VALID or dead_letters.path != f"{folder}/{INVALID}":
        raise ValueError("give the two endpoints of outcome_files")
    outcome = F.when(F.col("valid"), "valid").otherwise("invalid").alias("outcome")
    writer = rows.select("value", outcome).writeStream.option("checkpointLocation", checkpoint).partitionBy("outcome")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.format(sink.format).options(**sink.options).start(folder)


VALID, INVALID = "outcome=valid", "outcome=invalid"


def outcome_files(folder: str) -> tuple[Endpoint, Endpoint]:
    """Text files for valid events and for dead letters, side by side in a folder."""
    return text_files(f"{folder}/{VALID}"), text_files(f"{folder}/{INVALID}")


def produce_json_rows(
    df: DataFrame, sink: Endpoint, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """A stream of rows as JSON objects."""
    return stream_to(as_json_value(df), sink, checkpoint, available_now)
