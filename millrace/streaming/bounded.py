"""Run a stream over bounded input to its very end.

Append output holds back windows and timers the watermark has not passed, and
the end of a bounded input does not move the watermark. So once the input is
used up, the query is resumed from its checkpoint with one more record, far
later than any other. It moves the watermark and is then filtered out, before
any operator of the query sees it. A column of its own marks it, so rows of any
time, and of none, are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sinks.writers import stream_to_parquet

#: Seconds since 1970 of the last record: tens of thousands of years ahead, later than any date that can be written.
END_SECONDS = 10**12
_LAST = "__last"
_STRICT_LATE = "spark.sql.streaming.statefulOperator.allowMultiple"
_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


@contextmanager
def late_rows(spark: SparkSession, strict: bool) -> Iterator[None]:
    """Settings for queries started inside; the session has its own again afterwards.

    Of several watermarks the slowest counts. With ``strict`` late rows are
    dropped by the current watermark; without it Spark compares with that of
    one micro-batch earlier, which keeps late rows it could have dropped. Strict
    queries can hold only one stateful operator.
    """
    wanted = {_POLICY: "min"} | ({_STRICT_LATE: "false"} if strict else {})
    before = spark.conf.getAll
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in wanted:
            if name in before:
                spark.conf.set(name, before[name])
            else:
                spark.conf.unset(name)


def _last_record(like: DataFrame, time: str) -> DataFrame:
    return like.sparkSession.range(1).select(
        *[
            (F.timestamp_seconds(F.lit(END_SECONDS)) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema if f.name != _LAST
        ],
        F.lit(True).alias(_LAST),
    )


Watermark = Callable[[DataFrame, str], DataFrame]


def _watermarked(df: DataFrame, time: str, watermark: Watermark) -> DataFrame:
    # A filter on the event time stays above the watermark, so the last record counts for it.
    last = F.col(_LAST) & F.col(time).eqNullSafe(F.timestamp_seconds(F.lit(END_SECONDS)))
    return watermark(df, time).filter(~last).drop(_LAST)


def _marked(df: DataFrame) -> DataFrame:
    return df.withColumn(_LAST, F.lit(False))


class _Run:
    """One query with its folder; every ``go`` resumes it and takes what is new."""

    def __init__(self, spark: SparkSession, folder: str, result: DataFrame, strict_late: bool):
        self.spark, self.folder, self.result, self.strict_late = spark, folder, result, strict_late

    def go(self) -> None:
        with late_rows(self.spark, self.strict_late):
            query = stream_to_parquet(self.result, f"{self.folder}/out", f"{self.folder}/checkpoint")
        query.awaitTermination()

    def output(self) -> DataFrame:
        return self.spark.read.schema(self.result.schema).parquet(f"{self.folder}/out")


def run_to_end(
    sources: DataFrame | Sequence[DataFrame],
    time: str,
    watermark: Watermark,
    build: Callable[..., DataFrame],
    label: str = "bounded",
    strict_late: bool = False,
) -> DataFrame:
    """All rows ``build(*sources)`` appends, including those due at the end.

    ``sources`` are streams over bounded input that have the ``time`` column.
    Each is given its watermark and handed to ``build``, which returns the
    streaming result. Output goes to files in the shared scratch folder, never
    through the driver.
    """
    sources = [sources] if isinstance(sources, DataFrame) else list(sources)
    spark = sources[0].sparkSession
    folder = scratch_dir(spark, label)
    ended = []
    sources = [_marked(s) for s in sources]
    for i, source in enumerate(sources):
        spark.createDataFrame([], source.schema).write.parquet(f"{folder}/end-{i}")
        end = spark.readStream.schema(source.schema).parquet(f"{folder}/end-{i}")
        ended.append(_watermarked(source.unionByName(end), time, watermark))
    run = _Run(spark, folder, build(*ended), strict_late)
    run.go()
    for i, source in enumerate(sources):
        _last_record(source, time).write.mode("append").parquet(f"{folder}/end-{i}")
    run.go()
    return run.output()


def run_in_phases(
    phases: Sequence[DataFrame],
    time: str,
    watermark: Watermark,
    build: Callable[[DataFrame], DataFrame],
    label: str = "phases",
    strict_late: bool = False,
) -> DataFrame:
    """Like ``run_to_end`` over batch tables that arrive one after another.

    The watermark a phase leaves behind decides what of the next one is late.
    """
    spark = phases[0].sparkSession
    folder = scratch_dir(spark, label)
    phases = [_marked(p) for p in phases]
    phases[0].write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(phases[0].schema).parquet(f"{folder}/in")
    run = _Run(spark, folder, build(_watermarked(stream, time, watermark)), strict_late)
    run.go()
    for phase in [*phases[1:], _last_record(stream, time)]:
        phase.select(*stream.columns).write.mode("append").parquet(f"{folder}/in")
        run.go()
    return run.output()


def run_available(df: DataFrame, label: str = "available", mode: str = "append") -> DataFrame:
    """Run a stream without event-time state over what is there now."""
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    query = stream_to_parquet(df, f"{folder}/out", f"{folder}/checkpoint", mode=mode)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")
