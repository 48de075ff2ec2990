"""Streaming and batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.endpoints import Endpoint


def as_json_value(df: DataFrame) -> DataFrame:
    """Serialise each row as a JSON object in a single ``value`` column; NULL fields stay, as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def _stream_writer(df: DataFrame, checkpoint: str, available_now: bool, mode: str):
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    return writer.trigger(availableNow=True) if available_now else writer


def stream_to(
    df: DataFrame, sink: Endpoint, checkpoint: str, available_now: bool = False, mode: str = "append"
) -> StreamingQuery:
    """Start writing ``df`` to an endpoint; a broker receives at least once."""
    writer = _stream_writer(df, checkpoint, available_now, mode)
    writer = writer.format(sink.format).options(**sink.options)
    if sink.path:
        writer = writer.option("path", sink.path)
    return writer.start()


def stream_to_parquet(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True, mode: str = "append"
) -> StreamingQuery:
    return stream_to(df, Endpoint("parquet", path=path), checkpoint, available_now, mode)


def stream_to_console(df: DataFrame, checkpoint: str, available_now: bool = False, mode: str = "append",
                      rows: int = 20) -> StreamingQuery:
    """Show up to ``rows`` rows of each micro-batch on the driver's standard output."""
    writer = _stream_writer(df, checkpoint, available_now, mode)
    return writer.format("console").option("numRows", rows).option("truncate", "false").start()


def _row_file_options(suffix: str | None, max_records_per_file: int | None) -> dict[str, str]:
    options = {"extension": suffix, "maxRecordsPerFile": max_records_per_file}
    return {name: str(value) for name, value in options.items() if value}


def write_row_files(
    df: DataFrame, path: str, suffix: str | None = None, max_records_per_file: int | None = None
) -> None:
    """Row-format text files with a chosen suffix, rolled by record count."""
    df.write.options(**_row_file_options(suffix, max_records_per_file)).csv(path)


def stream_row_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    suffix: str | None = None,
    max_records_per_file: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Streaming form; every task of a trigger also rolls a new part file."""
    sink = Endpoint("csv", _row_file_options(suffix, max_records_per_file), path)
    return stream_to(df, sink, checkpoint, available_now)
