"""A live feed of growing files as a Spark source of its own, as batch or as stream.

A feed is a folder of text files to which a forwarder appends one message per line, and to which
files may be added. The offset of a file is a byte position behind a line; a batch reads from one
position to another in ranges of ``rangeBytes``, one task each, so that one large file is read by
many tasks. A line belongs to the range in which it begins. A line that has no end yet waits.

The id of a message is its file and byte position: replays give the same id, and a line that
stands twice in a file is two messages.

Spark's readers know no positions inside text files, so files are opened by Python: driver and
executors must see the folder under one path, as on a shared mount.

Options: ``rangeBytes`` (8 MiB), ``startingOffsets`` and, for batches, ``endingOffsets``: positions
by file name as JSON (default: all there is), and ``committed``: a file that is told up to where
everything has been processed, so that a forwarder may cut off what lies before.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "tidemark_feed"
SCHEMA = "value string, message_id string, file string, position long"
_RANGE = 8 << 20
_BLOCK = 1 << 16
_ROWS = 4096


@dataclass
class Range(InputPartition):
    """The lines of a file that begin from ``first`` to before ``last``."""

    file: str
    first: int
    last: int


def _line_end(path: str) -> int:
    """The position behind the last line that is complete."""
    with open(path, "rb") as file:
        at = file.seek(0, os.SEEK_END)
        while at > 0:
            start = max(0, at - _BLOCK)
            file.seek(start)
            found = file.read(at - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return 0


class _Feed:
    def __init__(self, options: dict) -> None:
        self.path = options["path"].removeprefix("file://").removeprefix("file:").rstrip("/") or "/"
        self.range_bytes = int(options.get("rangeBytes", _RANGE))
        self.first = json.loads(options.get("startingOffsets", "{}"))
        self.last = json.loads(options["endingOffsets"]) if "endingOffsets" in options else None
        self.committed = options.get("committed")

    def ends(self) -> dict[str, int]:
        names = sorted(name for name in os.listdir(self.path) if not name.startswith((".", "_")))
        files = [name for name in names if os.path.isfile(f"{self.path}/{name}")]
        return {name: _line_end(f"{self.path}/{name}") for name in files}

    def ranges(self, start: dict, end: dict) -> list[Range]:
        return [
            Range(name, at, min(at + self.range_bytes, last))
            for name, last in end.items()
            for at in range(start.get(name, 0), last, self.range_bytes)
        ]

    def lines(self, part: Range) -> Iterator[pa.RecordBatch]:
        values, positions = [], []

        def batch() -> pa.RecordBatch:
            ids = [f"{part.file}:{position}" for position in positions]
            columns = [
                pa.array(values, pa.string()),
                pa.array(ids, pa.string()),
                pa.array([part.file] * len(values), pa.string()),
                pa.array(positions, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["value", "message_id", "file", "position"])

        if part.first == part.last:
            return
        with open(f"{self.path}/{part.file}", "rb") as file:
            at = part.first
            if at > 0:  # the line that goes on over the border belongs to the range before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            while at < part.last:
                line = file.readline()
                if not line:
                    raise OSError(f"{part.file} ends at {at}, but had {part.last} bytes")
                values.append(line.rstrip(b"\r\n").decode(errors="replace"))
                positions.append(at)
                at += len(line)
                if len(values) == _ROWS:
                    yield batch()
                    values, positions = [], []
        if values:
            yield batch()


class _BatchReader(DataSourceReader):
    def __init__(self, feed: _Feed) -> None:
        self.feed = feed

    def partitions(self) -> list[Range]:
        end = self.feed.ends() if self.feed.last is None else self.feed.last
        # Spark wants one part at least.
        return self.feed.ranges(self.feed.first, end) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.feed.lines(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, feed: _Feed) -> None:
        self.feed = feed

    def initialOffset(self) -> dict:
        return self.feed.first

    def latestOffset(self) -> dict:
        # A file that is gone keeps no place: positions only name what can be read.
        return {**self.feed.first, **self.feed.ends()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.feed.ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.feed.lines(partition)

    def commit(self, end: dict) -> None:
        if self.feed.committed:
            draft = f"{self.feed.committed}.draft"
            with open(draft, "w") as file:
                json.dump(end, file)
            os.replace(draft, self.feed.committed)


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _BatchReader:
        return _BatchReader(_Feed(self.options))

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(_Feed(self.options))


def read_feed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(FeedSource)
    return spark.read.format(NAME).options(path=path, **options).load()


def stream_feed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(FeedSource)
    return spark.readStream.format(NAME).options(path=path, **options).load()
