"""The polling source: offsets, groups, what is not there yet, and what ends the job."""

import os

import pytest
from pyspark.errors import PySparkException

from millrace.sinks.writers import stream_to_parquet
from millrace.sources import polling
from millrace.sources.polling import LineReader, Stretch, poll_lines, poll_to_end


def append(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "a", newline="") as file:
        file.write(text)


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_a_group_goes_on_where_it_was(spark, folder):
    topic = f"{folder}/topic"
    append(topic, "0", "a\nb\nc")
    append(topic, "1", "x\r\n\ny\n")
    append(topic, "_hidden", "no\n")
    assert values(poll_to_end(spark, topic, "g")) == ["", "a", "b", "x", "y"]
    assert values(poll_to_end(spark, topic, "g")) == []
    append(topic, "0", "c\nd\n")
    append(topic, "2", "new\n")
    assert values(poll_to_end(spark, f"file://{topic}", "g")) == ["cc", "d", "new"]
    assert values(poll_to_end(spark, topic, "late", "latest")) == []
    append(topic, "2", "newer\n")
    assert values(poll_to_end(spark, topic, "late", "latest")) == ["newer"]
    assert values(poll_to_end(spark, topic, "h")) == ["", "a", "b", "cc", "d", "new", "newer", "x", "y"]


def test_a_query_resumes_from_its_checkpoint(spark, folder):
    """Without loss or repeat, whatever the group has done meanwhile; groups are written while the stream runs, too."""
    topic = f"{folder}/topic"
    append(topic, "0", "a\n")
    for more in ("", "b\nc\n", "d\n"):
        append(topic, "0", more)
        stream_to_parquet(poll_lines(spark, topic, "g"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    assert values(spark.read.parquet(f"{folder}/out")) == ["a", "b", "c", "d"]
    assert LineReader({"path": topic, "group": "g"}).initialOffset() in ({"0": 6}, {"0": 8})


def test_a_lost_partition_ends_the_job(spark, folder):
    topic = f"{folder}/topic"
    append(topic, "0", "a\nb\n")
    poll_to_end(spark, topic, "g")
    os.truncate(f"{topic}/0", 2)
    with pytest.raises(PySparkException, match="fewer lines"):
        poll_to_end(spark, topic, "g")
    os.remove(f"{topic}/0")
    with pytest.raises(PySparkException, match="fewer lines"):
        poll_to_end(spark, topic, "g")
    with pytest.raises(PySparkException, match="earliest or latest"):
        poll_to_end(spark, topic, "g", "now")


def test_stretches_share_no_line(folder, monkeypatch):
    """However a partition is cut into tasks, each line is read once."""
    text = "".join(f"{'é' * (i % 7)}{i}\n" for i in range(500))
    append(folder, "0", text + "open end")
    reader = LineReader({"path": folder})
    end = reader.latestOffset()
    assert end == {"0": len(text.encode())}
    for size in (1, 3, 100, 10**6):
        monkeypatch.setattr(polling, "TASK_BYTES", size)
        stretches = reader.partitions({}, end)
        lines = [v for s in stretches for b in reader.read(s) for v in b.column("value").to_pylist()]
        assert lines == text.splitlines()
    assert reader.partitions(end, end) == [] and list(reader.read(Stretch("0", 0, 0, 0))) == []
