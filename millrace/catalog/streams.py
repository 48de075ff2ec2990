"""Event-time and stateful queries run as streams over the whole tables."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.catalog.batch import DAY_COUNTS, K, MINUTE_COUNTS, TOP2
from millrace.catalog.inputs import events, k
from millrace.catalog.registry import registered
from millrace.catalog.userdefined import TOP2_OF_SUMS
from millrace.operators.aggregates import top_of_changes
from millrace.operators.joins import heavy_keys, join_inner, join_spread, join_within
from millrace.operators.rows import distinct_rows
from millrace.operators.userdefined import CountSum, Largest
from millrace.operators.windows import tumbling_count, window_bounds
from millrace.session import scratch_dir
from millrace.sources.tables import in_batches, load_table, stream_table
from millrace.streaming import stateful
from millrace.streaming.bounded import run_available, run_in_phases, run_to_end
from millrace.streaming.eventtime import merge_watermarked, watermark_bounded, watermark_monotonous
from millrace.streaming.partitions import PartitionClocks

# Lateness beyond the table's span: no timer fires before all rows are in, however they are split into micro-batches.
BEYOND = "4000 days"
TIMERS = """
    SELECT DISTINCT user_id, epoch_us(ts) // 1000 + 2000 AS timer_ms,
           round(sum(value) OVER (PARTITION BY user_id), 2) AS "sum"
    FROM events"""
#: Micro-batches of the arrival schedule: by time, but one event in five comes a batch late.
PHASES, DELAYED = 4, 5
ARRIVALS = f"""
    span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) + 1 AS hi FROM events),
    a AS (SELECT user_id, value, epoch_us(ts) AS us, least({PHASES - 1}, (epoch_us(ts) - lo) * {PHASES} // (hi - lo)
                 + CASE WHEN event_id % {DELAYED} = 0 THEN 1 ELSE 0 END) AS batch FROM events, span)"""
#: Event times a thousand times as dense, so that seconds of lateness matter.
DENSE = 1_704_067_200_000_000


def late_counts(seconds: int) -> str:
    """Windows of two seconds without what comes when the watermark has passed the window's end."""
    return f"""
    WITH {ARRIVALS},
         e AS (SELECT batch, {DENSE} + (us - {DENSE}) // 1000 AS us FROM a),
         w AS (SELECT batch, max(max(us)) OVER (ORDER BY batch) // 1000 - {seconds * 1000} AS watermark FROM e GROUP BY batch),
         k AS (SELECT us // 2000000 * 2000 AS start FROM e LEFT JOIN w ON w.batch = e.batch - 1
               WHERE watermark IS NULL OR us // 2000000 * 2000 + 2000 > watermark)
    SELECT start AS window_start, start + 2000 AS window_end, count(*) AS event_count FROM k GROUP BY start"""


#: A timer fires in the first batch, not before its row's, that takes the watermark past it; the last is the end of all.
FIRINGS = f"""
    WITH {ARRIVALS},
         w AS (SELECT batch, max(max(us)) OVER (ORDER BY batch) // 1000 - 2000 AS watermark FROM a GROUP BY batch
               UNION ALL SELECT {PHASES}, 9000000000000000),
         f AS (SELECT DISTINCT user_id, us // 1000 + 2000 AS timer_ms, min(w.batch) AS fired
               FROM a JOIN w ON w.batch >= a.batch AND watermark > us // 1000 + 2000 GROUP BY user_id, us, a.batch),
         s AS (SELECT user_id, b.batch, sum(value) AS "sum" FROM a JOIN (SELECT batch FROM w) AS b ON a.batch <= b.batch
               GROUP BY ALL)
    SELECT user_id, timer_ms, round("sum", 2) AS "sum" FROM f JOIN s USING (user_id) WHERE s.batch = fired"""


def in_files(spark, d, table, columns, time=None, n=3):
    """The table as a stream of several micro-batches: in order of ``time`` (rows without one first), or dealt out without order."""
    folder = scratch_dir(spark, f"laid-{table}")
    df = load_table(spark, d, table).select(*columns)
    if time:
        at = F.unix_micros(time)
        cuts = df.select(at.cast("double").alias("t")).approxQuantile("t", [i / n for i in range(1, n)], 0.01)
        bounds = [float("-inf"), *cuts, float("inf")]
        parts = [df.filter((at >= a) & (at < b)) for a, b in zip(bounds[:-1], bounds[1:])]
        parts[0] = parts[0].union(df.filter(at.isNull()))
    else:
        parts = [df.filter(F.pmod(F.xxhash64(*columns), F.lit(n)) == i) for i in range(n)]
    return in_batches(parts, folder)


def arrivals(spark, d, *columns):
    """Events by the arrival schedule, a table for each micro-batch; written once, by batch."""
    df = events(spark, d).withColumn("us", F.unix_micros("ts"))
    span = df.agg(F.min("us").alias("lo"), (F.max("us") + 1).alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 1
    place = F.expr(f"(us - {lo}) * {PHASES} div {hi - lo}")
    late = F.when(F.col("event_id") % DELAYED == 0, 1).otherwise(0)
    folder = scratch_dir(spark, "arrivals")
    df.select(*columns, F.least(F.lit(PHASES - 1), place + late).cast("int").alias("batch")).write.partitionBy(
        "batch").parquet(folder)
    laid = spark.read.parquet(folder)
    return [laid.filter(F.coalesce("batch", F.lit(0)) == i).drop("batch") for i in range(PHASES)]


def _late_counts(spark, d, watermark):
    """Counts per two seconds of dense event time; the watermark each batch leaves decides what of the next is late."""
    dense = F.timestamp_micros(DENSE + F.floor((F.unix_micros("ts") - DENSE) / 1000))
    phases = [p.select(dense.alias("at")) for p in arrivals(spark, d, "ts")]

    def counts(df):
        counted = df.groupBy(F.window("at", "2 seconds").alias("w")).agg(F.count("*").alias("event_count"))
        return counted.select(*window_bounds(F.col("w")), "event_count")

    return run_in_phases(phases, "at", watermark, counts, strict_late=True)


def _minute_counts(df):
    counted = df.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("event_count"))
    return counted.select(*window_bounds(F.col("w")), "event_count")


@registered("watermark_monotonous", late_counts(0))
def _(spark, d):
    return _late_counts(spark, d, watermark_monotonous)


@registered("watermark_bounded", late_counts(2))
def _(spark, d):
    return _late_counts(spark, d, watermark_bounded("2 seconds"))


@registered("watermark_5s", late_counts(5))
def _(spark, d):
    return _late_counts(spark, d, watermark_bounded("5 seconds"))


@registered("bounded_flush", MINUTE_COUNTS)
def _(spark, d):
    return run_to_end(
        in_files(spark, d, "events", ["ts"], "ts"), "ts", watermark_monotonous, _minute_counts
    )


@registered("late_data", """
    WITH seen AS (SELECT max(ts) AS watermark FROM events WHERE event_type = 'view')
    SELECT event_type, epoch_ms(day) AS window_start, epoch_ms(day + INTERVAL 1 DAY) AS window_end, count(*) AS cnt
    FROM (SELECT event_type, date_trunc('day', ts) AS day FROM events), seen
    WHERE event_type = 'view' OR day + INTERVAL 1 DAY > watermark
    GROUP BY event_type, day""")
def _(spark, d):
    # Views come first and move the watermark; what then arrives for windows
    # they have closed is late.
    df = events(spark, d).select("event_type", "ts")
    views = df.filter("event_type = 'view'")
    others = df.filter("event_type <> 'view'")
    return run_in_phases(
        [views, others], "ts", watermark_monotonous,
        lambda e: tumbling_count(e, ["event_type"], "ts", "1 day"),
        strict_late=True,
    )


@registered("partition_watermark", DAY_COUNTS)
def _(spark, d):
    # Two partitions of a topic: all others are there at once, errors come in several micro-batches. Were the
    # watermark that of the fastest partition, all errors but the first would be late.
    folder = scratch_dir(spark, "partitions")
    df = events(spark, d).select("event_type", "ts")
    df.filter("event_type <> 'error'").coalesce(1).write.parquet(folder)
    others = spark.readStream.schema(df.schema).parquet(folder)
    errors = in_files(spark, d, "events", ["event_type", "ts"], "ts").filter("event_type = 'error'")
    return run_to_end(
        [errors, others], "ts", watermark_monotonous,
        lambda *p: tumbling_count(merge_watermarked(p), ["event_type"], "ts", "1 day"),
        strict_late=True,
    )


#: Micro-batches by time; partition 2 falls idle after the first, and partition 3 comes with the third, its older rows as well.
STEPS, IDLE = 6, 2
CLOCKS = f"""
    WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) + 1 AS hi FROM events),
         q AS (SELECT event_type, epoch_us(ts) AS us, event_id % 4 AS p, (epoch_us(ts) - lo) * {STEPS} // (hi - lo) AS q
               FROM events, span),
         a AS (SELECT event_type, us, CASE WHEN p = 2 AND q > 0 THEN 0 ELSE p END AS p,
                      CASE WHEN p = 3 THEN greatest(q, 2) ELSE q END AS batch FROM q),
         b AS (SELECT DISTINCT batch FROM a),
         seen AS (SELECT b.batch, p, max(us) // 1000 AS ms, max(a.batch) AS last FROM b JOIN a ON a.batch <= b.batch
                  GROUP BY b.batch, p),
         least AS (SELECT batch, min(ms) AS ms FROM seen WHERE last > batch - {IDLE} GROUP BY batch),
         clock AS (SELECT batch, max(ms) OVER (ORDER BY batch) AS ms FROM least),
         k AS (SELECT event_type, us // 86400000000 * 86400000 AS start FROM a LEFT JOIN clock ON clock.batch = a.batch - 1
               WHERE ms IS NULL OR us // 86400000000 * 86400000 + 86400000 > ms)
    SELECT event_type, start AS window_start, start + 86400000 AS window_end, count(*) AS cnt FROM k GROUP BY ALL"""


@registered("partition_clocks", CLOCKS)
def _(spark, d):
    df = events(spark, d).select("event_type", "ts", F.unix_micros("ts").alias("us"), (F.col("event_id") % 4).alias("p"))
    span = df.agg(F.min("us").alias("lo"), (F.max("us") + 1).alias("hi")).first()
    q = F.expr(f"(us - {span['lo'] or 0}) * {STEPS} div {(span['hi'] or 1) - (span['lo'] or 0)}")
    batch = F.coalesce(F.when(F.col("p") == 3, F.greatest(q, F.lit(2))).otherwise(q), F.lit(0))
    laid, folder = scratch_dir(spark, "laid"), scratch_dir(spark, "partitions")
    df.select("event_type", "ts", F.when((F.col("p") == 2) & (q > 0), 0).otherwise(F.col("p")).alias("p"),
              batch.cast("int").alias("batch")).write.partitionBy("batch").parquet(laid)
    rows = spark.read.parquet(laid)
    clocks = PartitionClocks(spark, ["event_type"], "ts", "p", "1 day", idle=IDLE)
    for i in range(STEPS):
        # Partitions are folders of the source, there as soon as they have rows.
        rows.filter(F.col("batch") == i).drop("batch").write.partitionBy("p").mode("append").parquet(folder)
        clocks.run(spark.readStream.schema(df.select("event_type", "ts", "p").schema).parquet(folder))
    return clocks.closed(at_end=True)


@registered("stream_map", f"SELECT event_id, event_type, {K} AS k FROM events")
def _(spark, d):
    return run_available(stream_table(spark, d, "events").select("event_id", "event_type", k().alias("k")))


@registered("distinct_stream", "SELECT DISTINCT c_mktsegment FROM customer")
def _(spark, d):
    return run_available(distinct_rows(stream_table(spark, d, "customer"), "c_mktsegment"))


@registered("keyed_sum_timers_stream", FIRINGS)
def _(spark, d):
    sums = run_in_phases(
        arrivals(spark, d, "user_id", "ts", "value"), "ts", watermark_bounded("2 seconds"),
        lambda e: stateful.keyed_sum_at_timers(e, ["user_id"], "ts", "value"),
    )
    return sums.withColumn("sum", F.round("sum", 2))


@registered("state_ttl", """
    SELECT DISTINCT user_id, epoch_us(ts) // 1000 + 2000 AS timer_ms, CAST(NULL AS DOUBLE) AS "sum" FROM events""")
def _(spark, d):
    sums = run_to_end(
        in_files(spark, d, "events", ["user_id", "ts", "value"]), "ts", watermark_bounded(BEYOND),
        lambda e: stateful.keyed_sum_at_timers(e, ["user_id"], "ts", "value", ttl_seconds=0),
    )
    # Timers fire in a later micro-batch than their rows: by then each sum has run out.
    return sums.withColumn("sum", F.round("sum", 2))


#: Sums that start anew after a day and a half without an access; what a row finds is the last access before it.
TTL_MS = 129_600_000
EXPIRING = f"""
    WITH {ARRIVALS},
         r AS (SELECT user_id, value, us // 1000 AS ms, batch, row_number() OVER (PARTITION BY user_id ORDER BY batch, us) AS n FROM a),
         w AS (SELECT batch, max(max(ms)) OVER (ORDER BY batch) - 2000 AS watermark FROM r GROUP BY batch
               UNION ALL SELECT {PHASES}, 9000000000000000),
         found AS (SELECT r.user_id, r.n,
                          max(CASE WHEN p.batch < r.batch AND watermark > p.ms + 2000 THEN p.ms + 2000 ELSE p.ms END) AS accessed
                   FROM r JOIN r AS p ON p.user_id = r.user_id AND p.n < r.n LEFT JOIN w ON w.batch = r.batch - 1
                   GROUP BY r.user_id, r.n),
         s AS (SELECT r.*, sum(CASE WHEN ms - accessed > {TTL_MS} THEN 1 ELSE 0 END) OVER (PARTITION BY r.user_id ORDER BY r.n) AS part
               FROM r LEFT JOIN found ON found.user_id = r.user_id AND found.n = r.n),
         run AS (SELECT *, sum(value) OVER (PARTITION BY user_id, part ORDER BY n) AS total FROM s),
         f AS (SELECT DISTINCT user_id, ms + 2000 AS timer_ms, min(w.batch) AS fired
               FROM r JOIN w ON w.batch >= r.batch AND watermark > ms + 2000 GROUP BY user_id, ms, r.batch)
    SELECT f.user_id, timer_ms, round(max_by(total, n), 2) AS "sum"
    FROM f JOIN run ON run.user_id = f.user_id AND run.batch <= fired GROUP BY f.user_id, timer_ms, fired"""


@registered("state_ttl_event", EXPIRING)
def _(spark, d):
    sums = run_in_phases(
        arrivals(spark, d, "user_id", "ts", "value"), "ts", watermark_bounded("2 seconds"),
        lambda e: stateful.keyed_sum_at_timers(e, ["user_id"], "ts", "value", ttl_seconds=TTL_MS / 1000, ttl_clock="event"),
    )
    return sums.withColumn("sum", F.round("sum", 2))


@registered("changelog_stream", f"""
    SELECT event_type, count(*) AS cnt, CAST(max({K}) AS BIGINT) AS max_k FROM events GROUP BY event_type""")
def _(spark, d):
    log = run_available(
        stateful.changelog_aggregate(
            in_files(spark, d, "events", ["event_id", "event_type", "props"]).withColumn("k", k()),
            ["event_type"],
            {"cnt": ("count", "event_id"), "max_k": ("max", "k")},
        )
    )
    # What is given minus what is taken back leaves the last result.
    sign = F.when(F.col("op").startswith("-"), -1).otherwise(1)
    return log.groupBy("event_type").agg(
        F.sum(sign * F.col("cnt")).alias("cnt"), F.sum(sign * F.col("max_k")).alias("max_k")
    )


@registered("keyed_sum_timers_spread", TIMERS)
def _(spark, d):
    sums = run_to_end(
        in_files(spark, d, "events", ["user_id", "ts", "value"]), "ts", watermark_bounded(BEYOND),
        lambda e: stateful.keyed_sum_at_timers(e, ["user_id"], "ts", "value", spread=4),
    )
    return sums.withColumn("sum", F.round("sum", 2))


@registered("udaf_stream", f"""
    SELECT user_id, count(*) AS cnt, CAST(sum({K}) AS BIGINT) AS "sum" FROM events GROUP BY user_id""")
def _(spark, d):
    df = in_files(spark, d, "events", ["event_id", "user_id", "event_type", "props"]).withColumn("k", k())
    log = run_available(stateful.user_aggregate(df, ["user_id"], CountSum("k"), ["k"]))
    sign = F.when(F.col("op").startswith("-"), -1).otherwise(1)
    return log.groupBy("user_id").agg(F.sum(sign * F.col("cnt")).alias("cnt"), F.sum(sign * F.col("sum")).alias("sum"))


@registered("udtaf_stream", TOP2)
def _(spark, d):
    df = in_files(spark, d, "events", ["event_id", "user_id", "event_type", "props"]).withColumn("k", k())
    log = run_available(stateful.user_aggregate(df, ["event_type"], Largest("k"), ["k"]))
    # What is given minus what is taken back, row by row, leaves the last result.
    sign = F.when(F.col("op").startswith("-"), -1).otherwise(1)
    columns = [c for c in log.columns if c != "op"]
    left = log.groupBy(*columns).agg(F.sum(sign).alias("n")).filter("n > 0")
    return left.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")


@registered("udtaf_retract_stream", TOP2_OF_SUMS)
def _(spark, d):
    df = in_files(spark, d, "events", ["event_id", "user_id", "event_type", "props"]).withColumn("k", k())
    sums = stateful.changelog_aggregate(df, ["event_type", "user_id"], {"sum": ("sum", "k")})
    log = run_available(stateful.top_of_changes(sums, ["event_type"], "sum"))
    return top_of_changes(log, ["event_type"], "sum")


@registered("join_streams", """
    SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, d):
    orders = stream_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customers = stream_table(spark, d, "customer").select("c_custkey", "c_name")
    return run_available(join_inner(orders, customers, [("o_custkey", "c_custkey")]))


@registered("join_streams_spread", """
    SELECT o_orderkey, customer, c_custkey, c_name
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS customer FROM orders)
    JOIN customer ON customer = c_custkey""")
def _(spark, d):
    # A third of the orders is one customer's.
    def of_customer(df):
        return df.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("customer"))

    hot = heavy_keys(of_customer(load_table(spark, d, "orders")), "customer", 0.05)
    orders = of_customer(in_files(spark, d, "orders", ["o_orderkey", "o_custkey"]))
    customers = stream_table(spark, d, "customer").select("c_custkey", "c_name")
    return run_available(join_spread(orders, customers, ("customer", "c_custkey"), hot, lanes=16))


@registered("keyed_process_fn", f"""
    SELECT user_id, epoch_ms(date_trunc('day', ts)) AS window_start,
           epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) AS window_end,
           count(*) AS cnt, CAST(sum({K}) AS BIGINT) AS "sum"
    FROM events GROUP BY user_id, date_trunc('day', ts)""")
def _(spark, d):
    return run_to_end(
        stream_table(spark, d, "events").withColumn("k", k()).select("user_id", "ts", "k"), "ts",
        watermark_monotonous,
        lambda e: stateful.window_process(e, ["user_id"], "ts", "1 day", CountSum("k"), ["k"]),
    )


GAP_MS = 86_400_000


class Sessions(StatefulProcessor):
    """A user's own processor: counts events until none has come for a day."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "cnt BIGINT, last_ms BIGINT")

    def _closed(self, key, cnt, last):
        return Row(user_id=key[0], closed_ms=last + GAP_MS, cnt=cnt)

    def handleInputRows(self, key, rows, timerValues):
        cnt, last = self.state.get() or (0, 0)
        for ms in sorted(row["ms"] for row in rows):
            if cnt and ms - last > GAP_MS:
                yield self._closed(key, cnt, last)
                cnt = 0
            cnt, last = cnt + 1, ms
        self.state.update((cnt, last))
        self.handle.registerTimer(last + GAP_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        stored = self.state.get()
        # A timer of an earlier event finds the session still open.
        if stored and stored[1] + GAP_MS <= timerValues.getCurrentWatermarkInMs():
            self.state.clear()
            yield self._closed(key, *stored)

    def close(self) -> None:
        pass


@registered("keyed_process_own", f"""
    WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events),
         g AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) <= {GAP_MS} THEN 0 ELSE 1 END AS fresh
               FROM e),
         n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ms, fresh ROWS UNBOUNDED PRECEDING) AS nth FROM g)
    SELECT user_id, max(ms) + {GAP_MS} AS closed_ms, count(*) AS cnt FROM n GROUP BY user_id, nth""")
def _(spark, d):
    return run_to_end(
        in_files(spark, d, "events", ["user_id", "ts"], "ts"), "ts", watermark_monotonous,
        lambda e: stateful.process_keyed(
            e.select("user_id", "ts", F.unix_millis("ts").alias("ms")), ["user_id"], Sessions(),
            "user_id BIGINT, closed_ms BIGINT, cnt BIGINT"),
    )


@registered("join_streams_within", """
    SELECT c.event_id AS click_id, p.event_id AS purchase_id
    FROM events AS c JOIN events AS p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 30 DAYS
    WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def _(spark, d):
    columns = ["event_id", "user_id", "event_type", "ts"]
    clicks = in_files(spark, d, "events", columns, "ts").filter("event_type = 'click'").select("ts", "user_id", "event_id")
    bought = in_files(spark, d, "events", columns, "ts").filter("event_type = 'purchase'").select("ts", "user_id", "event_id")
    joined = run_to_end(
        [clicks, bought], "ts", watermark_monotonous,
        lambda c, p: join_within(
            c.select("user_id", F.col("ts").alias("clicked"), F.col("event_id").alias("click_id")),
            p.select(F.col("user_id").alias("buyer"), F.col("ts").alias("paid"), F.col("event_id").alias("purchase_id")),
            [("user_id", "buyer")], "clicked", "paid", "30 DAYS"),
    )
    return joined.select("click_id", "purchase_id")
