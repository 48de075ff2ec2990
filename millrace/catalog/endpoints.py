"""Sources and sinks for string events, run on text files in place of topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.batch import CDC, K, unpacked_changes
from millrace.catalog.inputs import as_topic, change_events, empty_topic, events, mixed_strings
from millrace.catalog.registry import registered
from millrace.session import scratch_dir
from millrace.sinks.writers import as_json_value, stream_row_files, stream_to_console
from millrace.sources.endpoints import (
    bad_events,
    read_strings,
    register_stream_table,
    stream_json_rows,
    stream_strings,
)
from millrace.sources.polling import poll_to_end
from millrace.sources.tables import stream_table
from millrace.streaming.bounded import run_available
from millrace.streaming.jobs import forward, forward_valid, outcome_files, produce_json_rows

PROPS = "SELECT props AS value FROM events"
MIXED = "CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END"


def _props(spark, d):
    return events(spark, d).select(F.col("props").alias("value"))


@registered("kafka_string_source", PROPS)
def _(spark, d):
    topic = as_topic(_props(spark, d), "topic")
    return run_available(stream_strings(spark, topic), "strings")


@registered("kafka_poll_source", PROPS)
def _(spark, d):
    return read_strings(spark, as_topic(_props(spark, d), "topic"))


@registered("poll_source_groups", """
    SELECT 1 AS run, 'a' AS grp, event_id FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT 2, 'a', event_id FROM events WHERE event_id % 2 = 1
    UNION ALL SELECT 3, 'b', event_id FROM events""")
def _(spark, d):
    # Half of the events is polled; when the others have come, the same group takes only these, another group takes all.
    topic, df = scratch_dir(spark, "polled"), events(spark, d)
    runs = []
    for run, (group, some) in enumerate([("a", 0), ("a", 1), ("b", None)], 1):
        if some is not None:
            df.filter(F.col("event_id") % 2 == some).select(F.col("event_id").cast("string")).write.mode("append").text(topic)
        lines = poll_to_end(spark, topic, group)
        runs.append(lines.select(F.lit(run).alias("run"), F.lit(group).alias("grp"), F.col("value").cast("bigint").alias("event_id")))
    return runs[0].union(runs[1]).union(runs[2])


@registered("kafka_json_row_source", """
    SELECT CAST(event_id AS INTEGER) AS f0, CASE WHEN event_id % 5 > 0 THEN event_type END AS f1, NULL::VARCHAR AS bad
    FROM events WHERE event_type <> 'error'
    UNION ALL SELECT NULL, NULL, '{"f0":' || event_id || ',"f1"' FROM events WHERE event_type = 'error'""")
def _(spark, d):
    # Some fields are null; error events are cut short and go to dead letters.
    kind = F.when(F.col("event_id") % 5 > 0, F.col("event_type"))
    pairs = as_json_value(events(spark, d).filter("event_type <> 'error'").select(
        F.col("event_id").alias("f0"), kind.alias("f1")))
    cut = events(spark, d).filter("event_type = 'error'").select(
        F.concat(F.lit('{"f0":'), "event_id", F.lit(',"f1"')).alias("value"))
    topic = as_topic(pairs.union(cut), "topic")
    rows = run_available(stream_json_rows(spark, topic, "f0 INT, f1 STRING", bad="drop"), "json-rows")
    dead = run_available(bad_events(stream_strings(spark, topic), "f0 INT, f1 STRING"), "dead-letters")
    return rows.withColumn("bad", F.lit(None).cast("string")).unionByName(
        dead.select(F.lit(None).cast("int").alias("f0"), F.lit(None).cast("string").alias("f1"), F.col("value").alias("bad")))


@registered("kafka_sql_table", f"SELECT {K} AS k FROM events")
def _(spark, d):
    register_stream_table(spark, "props_stream", as_topic(_props(spark, d), "topic"), "k BIGINT")
    return run_available(spark.sql("SELECT * FROM props_stream"), "sql-table")


@registered("kafka_passthrough_sink", f"SELECT {MIXED} AS value FROM events")
def _(spark, d):
    sent = empty_topic(spark, "sent")
    source = as_topic(mixed_strings(spark, d), "topic")
    forward(spark, source, sent, scratch_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return read_strings(spark, sent)


@registered("kafka_validated_sink", f"SELECT {MIXED} AS value, event_type <> 'error' AS valid FROM events")
def _(spark, d):
    sent, dead = outcome_files(scratch_dir(spark, "outcomes"))
    source = as_topic(mixed_strings(spark, d), "topic")
    checkpoint = scratch_dir(spark, "checkpoint")
    forward_valid(spark, source, sent, dead, checkpoint, available_now=True, rewrite=True).awaitTermination()
    good = read_strings(spark, sent).withColumn("valid", F.lit(True))
    return good.unionByName(read_strings(spark, dead).withColumn("valid", F.lit(False)))


@registered("kafka_json_row_sink", """
    SELECT '{"f0":' || event_id || ',"f1":' || CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || event_type || '"' END
           || '}' AS value FROM events""")
def _(spark, d):
    sent = empty_topic(spark, "sent")
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    pairs = stream_table(spark, d, "events").select(F.col("event_id").alias("f0"), kind.alias("f1"))
    produce_json_rows(pairs, sent, scratch_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return read_strings(spark, sent)


@registered("file_sink", "SELECT event_id, event_type, '.ext' AS suffix FROM events")
def _(spark, d):
    path = scratch_dir(spark, "files")
    pairs = stream_table(spark, d, "events").select("event_id", "event_type")
    stream_row_files(pairs, path, scratch_dir(spark, "checkpoint"), "ext", available_now=True).awaitTermination()
    written = spark.read.schema("event_id BIGINT, event_type STRING").csv(path)
    suffix = F.regexp_extract("_metadata.file_name", r"\.[a-z]+$", 0)
    return written.select("event_id", "event_type", suffix.alias("suffix"))


@registered("console_sink", "SELECT count(DISTINCT event_type) AS shown, count(*) AS taken FROM events")
def _(spark, d):
    # The console collects what it shows, so it gets the small result only.
    # What it was given is read from the query's own progress.
    counts = stream_table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("cnt"))
    query = stream_to_console(counts, scratch_dir(spark, "checkpoint"), available_now=True, mode="complete")
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows]
    return spark.createDataFrame(
        [(progress[-1].sink.numOutputRows, sum(p.numInputRows for p in progress))], "shown BIGINT, taken BIGINT")


@registered("cdc_forward", CDC)
def _(spark, d):
    sent = empty_topic(spark, "sent")
    source = as_topic(change_events(spark, d), "topic")
    forward(spark, source, sent, scratch_dir(spark, "checkpoint"), available_now=True).awaitTermination()
    return unpacked_changes(read_strings(spark, sent))
