"""A source that is polled, with offsets that belong to a consumer group.

A topic is a folder with a file for each partition, to which lines are appended; names
that begin with _ or . are no partitions, and new ones may come. The
offset of a partition is the byte its next line begins at. A poll finds the lines that
are complete; a partition with nothing new is passed over, and so is a last line
that has no end yet. A partition that has become shorter, or is gone, ends the job:
its offsets no longer mean anything.

When Spark has finished a micro-batch, the group's offsets are written beside the
topic; Spark says so when it begins the next one, so ``settle`` does it for a query
that has ended. A query with a checkpoint resumes from that. A new query starts where
its group has got to, and a group that has no offsets at the earliest or latest line.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from millrace.session import scratch_dir
from millrace.sinks.writers import stream_to_parquet

FORMAT = "polled_lines"
#: Bytes that one task reads, and lines it hands over at once.
TASK_BYTES, LINES = 32 << 20, 10_000


class Stretch(InputPartition):
    """Lines of a partition that begin in [start, end); ``first`` is where the poll begins, which is the start of a line."""

    def __init__(self, part: str, first: int, start: int, end: int):
        self.part, self.first, self.start, self.end = part, first, start, end


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.group = options["path"], options.get("group")
        self.starting = options.get("startingoffsets", "earliest")
        if self.starting not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets is earliest or latest, not {self.starting!r}")

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (
            fs.LocalFileSystem(), self.path)

    def _group_file(self, folder: str) -> str:
        return f"{folder}/_groups/{self.group}.json"

    def _complete(self, store: fs.FileSystem, path: str, size: int) -> int:
        """The end of the last whole line."""
        with store.open_input_file(path) as file:
            end = size
            while end > 0:
                start = max(0, end - (1 << 16))
                file.seek(start)
                at = file.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def initialOffset(self) -> dict:
        store, folder = self._open()
        if self.group and store.get_file_info(self._group_file(folder)).type == fs.FileType.File:
            with store.open_input_stream(self._group_file(folder)) as file:
                return json.loads(file.read())
        return self.latestOffset() if self.starting == "latest" else {}

    def latestOffset(self) -> dict:
        store, folder = self._open()
        files = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return {f.base_name: self._complete(store, f.path, f.size)
                for f in sorted(files, key=lambda f: f.base_name) if f.is_file and f.base_name[0] not in "_."}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for part in sorted({*start, *end}):
            a, b = start.get(part, 0), end.get(part, -1)
            if b < a:
                raise RuntimeError(f"{part} of {self.path} has fewer lines than were read: {b} of {a} bytes")
            out += [Stretch(part, a, x, min(x + TASK_BYTES, b)) for x in range(a, b, TASK_BYTES)]
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        store, folder = self._open()
        with io.BufferedReader(store.open_input_file(f"{folder}/{partition.part}")) as file:
            at = partition.start
            if at > partition.first:  # the line that reaches into this stretch belongs to the one before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            file.seek(at)
            lines: list[tuple[str, str, int]] = []
            while at < partition.end:
                line = file.readline()
                lines.append((line.rstrip(b"\r\n").decode(), partition.part, at))
                at += len(line)
                if len(lines) >= LINES:
                    yield self._batch(lines)
                    lines = []
            if lines:
                yield self._batch(lines)

    def _batch(self, lines: list[tuple[str, str, int]]) -> pa.RecordBatch:
        value, part, position = zip(*lines)
        return pa.RecordBatch.from_arrays(
            [pa.array(value, pa.string()), pa.array(part, pa.string()), pa.array(position, pa.int64())],
            names=["value", "part", "position"])

    def commit(self, end: dict) -> None:
        """The group's offsets, under another name first, so that no reader finds half a file."""
        if self.group:
            store, folder = self._open()
            store.create_dir(f"{folder}/_groups")
            part = f"{self._group_file(folder)}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as file:
                file.write(json.dumps(end).encode())
            store.move(part, self._group_file(folder))

    def stop(self) -> None:
        pass


class PolledLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value STRING, part STRING, position BIGINT"

    def streamReader(self, schema) -> LineReader:
        return LineReader(dict(self.options))


def poll_lines(spark: SparkSession, path: str, group: str | None = None, starting: str = "earliest") -> DataFrame:
    """The lines of a topic as a stream: value, part, position."""
    spark.dataSource.register(PolledLines)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting)
    return (reader.option("group", group) if group else reader).load()


def settle(query: StreamingQuery, path: str, group: str) -> None:
    """Write the group's offsets up to the last micro-batch of a query that has ended well and reads this topic alone."""
    if query.exception() is not None:
        raise query.exception()
    ends = [json.loads(p.json)["sources"][0]["endOffset"] for p in query.recentProgress]
    ends = [end for end in ends if end]
    if ends:
        LineReader({"path": path, "group": group}).commit(ends[-1])


def poll_to_end(spark: SparkSession, path: str, group: str, starting: str = "earliest") -> DataFrame:
    """What a group has not had of a topic yet, up to what is there now; the group's offsets move on."""
    folder, lines = scratch_dir(spark, "poll"), poll_lines(spark, path, group, starting)
    query = stream_to_parquet(lines, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    settle(query, path, group)
    return spark.read.schema(lines.schema).parquet(f"{folder}/out")
