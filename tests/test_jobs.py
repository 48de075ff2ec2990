"""Jobs between endpoints, on folders of text in place of topics."""

import json
import os

import pytest

from fixtures import NEW, NOTES, OLD, change, rows
from millrace.operators.cdc import cdc_unpack
from millrace.session import scratch, scratch_dir
from millrace.sinks.writers import stream_row_files, stream_to_console, write_row_files
from millrace.sources.endpoints import (
    kafka_partition_sources, kafka_sink, kafka_source, read_strings, register_stream_table, stream_json_rows,
    stream_strings, text_files,
)
from millrace.sources.memory import from_collection, replay
from millrace.streaming.bounded import run_available
from millrace.streaming.jobs import forward, forward_valid, outcome_files, produce_json_rows, reserialise

STRINGS = ['{"b": 1,  "a": "é"}', "{broken", "", "[1,2]", "not json", '{"x": NaN}', '{"k": 1}{"k": 2}']


@pytest.fixture
def topic(spark, folder):
    spark.createDataFrame([(s,) for s in STRINGS], "value STRING").write.text(f"{folder}/topic")
    return text_files(f"{folder}/topic")


def test_forward_leaves_events_alone(spark, folder, topic):
    sent = text_files(f"{folder}/sent")
    forward(spark, topic, sent, f"{folder}/cp", available_now=True).awaitTermination()
    assert rows(read_strings(spark, sent)) == sorted([(s,) for s in STRINGS], key=str)


def test_forward_resumes_without_repeating(spark, folder, topic):
    sent = text_files(f"{folder}/sent")
    for _ in range(2):
        forward(spark, topic, sent, f"{folder}/cp", available_now=True).awaitTermination()
    spark.createDataFrame([("late",)], "value STRING").write.mode("append").text(topic.path)
    forward(spark, topic, sent, f"{folder}/cp", available_now=True).awaitTermination()
    assert rows(read_strings(spark, sent)) == sorted([(s,) for s in [*STRINGS, "late"]], key=str)


@pytest.mark.parametrize("rewrite", [False, True])
def test_forward_valid(spark, folder, topic, rewrite):
    sent, dead = outcome_files(f"{folder}/out")
    query = forward_valid(spark, topic, sent, dead, f"{folder}/cp", True, rewrite)
    query.awaitTermination()
    # Each event is read once.
    assert sum(p.numInputRows for p in query.recentProgress) == len(STRINGS)
    good = [STRINGS[0], STRINGS[3], STRINGS[5]]
    want = [json.dumps(json.loads(g)) if rewrite else g for g in good]
    assert rows(read_strings(spark, sent)) == sorted([(w,) for w in want], key=str)
    assert rows(read_strings(spark, dead)) == sorted([(s,) for s in STRINGS if s not in good], key=str)


def test_json_rows_there_and_back(spark, folder):
    pairs = replay(spark, [NOTES[:3], NOTES[3:]], "f0 INT, f1 STRING", f"{folder}/in")
    sent = text_files(f"{folder}/sent")
    produce_json_rows(pairs, sent, f"{folder}/cp", available_now=True).awaitTermination()
    assert ('{"f0":12,"f1":null}',) in rows(read_strings(spark, sent))
    back = run_available(stream_json_rows(spark, sent, "f0 INT, f1 STRING"))
    assert rows(back) == sorted(NOTES, key=str)


def test_sql_over_a_stream(spark, folder, topic):
    register_stream_table(spark, "messages", topic, "b INT", bad="drop")
    out = run_available(spark.sql("SELECT b FROM messages"))
    assert rows(out) == [(1,)]


def test_change_events_end_to_end(spark, folder):
    events = [change("u", OLD, NEW), change("c", None, NEW)]
    spark.createDataFrame([(e,) for e in events], "value STRING").write.text(f"{folder}/cdc")
    sent = text_files(f"{folder}/sent")
    forward(spark, text_files(f"{folder}/cdc"), sent, f"{folder}/cp", available_now=True).awaitTermination()
    flat = run_available(cdc_unpack(stream_strings(spark, sent)))
    assert sorted((r.op, r.id) for r in flat.collect()) == [("c", 52), ("u", 52)]


def test_row_files_have_the_suffix(spark, folder):
    df = from_collection(spark, [("roof", 0, 5, 2), ("roof", 5, 10, 1)], "k STRING, s BIGINT, e BIGINT, n BIGINT")
    write_row_files(df.coalesce(1), f"{folder}/batch", "ext", max_records_per_file=1)
    parts = [f for f in os.listdir(f"{folder}/batch") if f.startswith("part")]
    assert len(parts) == 2 and all(p.endswith(".ext") for p in parts)
    assert rows(spark.read.schema(df.schema).csv(f"{folder}/batch")) == rows(df)
    stream = replay(spark, [[("a", 1), ("c", 3)], [("b", 2)]], "k STRING, n INT", f"{folder}/in")
    stream_row_files(stream, f"{folder}/stream", f"{folder}/cp", "ext", 1, available_now=True).awaitTermination()
    parts = [f for f in os.listdir(f"{folder}/stream") if f.startswith("part")]
    assert len(parts) == 3 and all(p.endswith(".ext") for p in parts)
    assert rows(spark.read.schema("k STRING, n INT").csv(f"{folder}/stream")) == [("a", 1), ("b", 2), ("c", 3)]


def test_console(spark, folder):
    stream = replay(spark, [[("roof", 7)]], "k STRING, n INT", f"{folder}/in")
    query = stream_to_console(stream, f"{folder}/cp", available_now=True)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress] == [1]
    assert "ConsoleTable" in query.lastProgress.sink.description


def test_kafka_options():
    source = kafka_source("h1:9092,h2:9092", "t", "g", max_offsets_per_trigger=1000)
    assert source.format == "kafka" and source.options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "startingOffsets": "earliest", "failOnDataLoss": "true",
        "subscribe": "t", "kafka.group.id": "g", "maxOffsetsPerTrigger": "1000",
    }
    part = kafka_source("h:9092", "t", starting_offsets="latest", partitions=[0, 2])
    assert json.loads(part.options["assign"]) == {"t": [0, 2]} and "subscribe" not in part.options
    assert kafka_sink("h:9092", "t").options == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_one_source_per_partition():
    sources = kafka_partition_sources("h:9092", "t", 3, group_id="g")
    assert [json.loads(s.options["assign"]) for s in sources] == [{"t": [0]}, {"t": [1]}, {"t": [2]}]


def test_pretty_printing(spark):
    df = spark.createDataFrame([('{"a":{"b":1}}',), (None,)], "value STRING")
    pretty = rows(df.select(reserialise(df["value"], indent=4)))
    assert pretty == sorted([(json.dumps({"a": {"b": 1}}, indent=4),), (None,)], key=str)


def test_scratch_is_shared(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_is_removed(spark, folder):
    """Tables, streams and checkpoints of a run, nested ones too; nothing of what was written outside."""
    outside = scratch_dir(spark, "outside")
    spark.range(3).write.parquet(outside)
    with scratch(spark):
        inside = scratch_dir(spark, "inside")
        spark.range(3).write.parquet(inside)
        with scratch(spark):
            nested = scratch_dir(spark, "nested")
            spark.range(3).write.parquet(nested)
        assert os.path.exists(inside.removeprefix("file:")) and not os.path.exists(nested.removeprefix("file:"))
        assert spark.read.parquet(inside).count() == 3
    assert not os.path.exists(os.path.dirname(inside.removeprefix("file:")))
    assert spark.read.parquet(outside).count() == 3 and scratch_dir(spark, "x").rpartition("/")[0] == outside.rpartition("/")[0]
