"""Windows by the clocks of a source's partitions.

Spark has one watermark for a source, that of its latest event. Where order holds
only within a partition, a fast partition then makes the rows of a slow one late.
Here each partition has a clock of its own, the latest event time it has shown; the
stream's clock is the earliest of these. Partitions need not be known beforehand: one
counts from the micro-batch in which it first has rows. One that has had no rows for
``idle`` micro-batches is left out until it has some again, so that it can't hold back
all the others. The stream's clock never goes back.

Counts of a micro-batch are taken by partition and window in one shuffle and are small;
the ledger of clocks has a row for each partition, and open windows one for each
key and window. All three are tables named by the micro-batch, so one that is run
again writes the same again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.windows import window_bounds
from millrace.session import scratch_dir

_NEVER = -(1 << 62)


class PartitionClocks:
    """Counts per key and tumbling window of a stream, closed by the clocks of its partitions.

    Columns: keys, ``window_start`` and ``window_end`` in ms, ``cnt``. Rows of
    windows that are closed when they come are dropped and counted in
    ``late``. Rows without a time have no window; those without a partition
    share one. ``lateness_ms`` holds the clock back.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], time: str, partition: str, size: str, idle: int = 2,
                 lateness_ms: int = 0):
        self.spark, self.keys, self.time, self.partition, self.size = spark, list(keys), time, partition, size
        self.idle, self.lateness_ms = idle, lateness_ms
        self.folder = scratch_dir(spark, "clocks")
        self.window = [*self.keys, "window_start", "window_end"]

    def _read(self, kind: str, batch: int, like: DataFrame) -> DataFrame:
        if batch < 0:
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(f"{self.folder}/{kind}/{batch}")

    def _write(self, df: DataFrame, kind: str, batch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{kind}/{batch}")
        return self._read(kind, batch, df)

    def step(self, rows: DataFrame, batch: int) -> None:
        """One micro-batch; for ``foreachBatch``. Micro-batches are numbered without gaps."""
        # A clock that the batch before has left decides what is late in this one.
        at = F.unix_millis(self.time)
        counts = self._write(rows.filter(F.col(self.time).isNotNull()).groupBy(
            F.col(self.partition).alias("part"), *self.keys, F.window(self.time, self.size).alias("w")).agg(
            F.max(at).alias("seen_ms"), F.count("*").alias("cnt")).select(
            "part", *self.keys, *window_bounds(F.col("w")), "seen_ms", "cnt"), "counts", batch)
        mine = counts.groupBy("part").agg(F.max("seen_ms").alias("seen_ms")).withColumn("batch", F.lit(batch)).withColumn(
            "clock_ms", F.lit(_NEVER))
        ledger = self._read("ledger", batch - 1, mine)
        before = ledger.agg(F.max("clock_ms")).first()[0]
        before = _NEVER if before is None else before
        known = ledger.unionByName(mine).groupBy("part").agg(F.max("seen_ms").alias("seen_ms"), F.max("batch").alias("batch"))
        least = known.filter(F.col("batch") > batch - self.idle).agg(F.min("seen_ms")).first()[0]
        clock = before if least is None else max(before, least - self.lateness_ms)
        # ``clock_ms`` is that of the stream, the same in every row.
        self._write(known.withColumn("clock_ms", F.lit(clock)).select(*mine.columns), "ledger", batch)

        on_time = counts.filter(F.col("window_end") > before).select(*self.window, "cnt")
        self._write(counts.filter(F.col("window_end") <= before).agg(F.sum("cnt").alias("cnt")), "late", batch)
        held = self._write(self._read("open", batch - 1, on_time).unionByName(on_time).groupBy(*self.window).agg(
            F.sum("cnt").alias("cnt")), "held", batch)
        self._write(held.filter(F.col("window_end") <= clock), "closed", batch)
        self._write(held.filter(F.col("window_end") > clock), "open", batch)
        self.last, self.schema = batch, held.schema

    def run(self, stream: DataFrame) -> None:
        """Take what is there now; resumes where the last run has ended."""
        query = stream.writeStream.foreachBatch(self.step).option(
            "checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    def closed(self, at_end: bool = False) -> DataFrame:
        """Windows closed so far; with ``at_end`` also those still open."""
        paths = [f"{self.folder}/closed/{b}" for b in range(self.last + 1)]
        if at_end:
            paths.append(f"{self.folder}/open/{self.last}")
        return self.spark.read.schema(self.schema).parquet(*paths)

    def late(self) -> int:
        """Rows dropped so far."""
        paths = [f"{self.folder}/late/{b}" for b in range(self.last + 1)]
        return self.spark.read.schema("cnt BIGINT").parquet(*paths).agg(F.sum("cnt")).first()[0] or 0
