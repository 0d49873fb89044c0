"""A table that a Spark sink of its own writes: tasks stage files, the driver publishes a batch once.

A task writes its rows to one Parquet file in ``staged``. When all tasks of a batch have ended, the
driver moves their files to ``data`` and publishes the batch: one small file, made in one step
under the name of run and batch, that lists the files with their number of rows and first and last
time. Readers read what is listed, so a task that fails or runs twice, a batch that breaks off and
a driver that dies in between leave nothing that is seen. A batch that is replayed finds its
name taken and throws its own files away.

It takes batches (``df.write``, a batch of its own each, or one with the options ``run`` and
``batch``) and streams in any output mode (``df.writeStream``; the run is the id of the
checkpoint). Of keys that are written again, in running stats or by another run, the row that was
published last counts: give ``keys`` to ``read``.

Spark's Python sinks have no file system of their own: driver and executors must see the folder
under one path, as on a shared mount.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from tidemark.functions import clock
from tidemark.operators.upserts import latest_row

NAME = "tidemark_published"
_ENTRY = "file string, rows long, first long, last long"
_VERSION_DIGITS = 20


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written; ``file`` is None if it had no rows."""

    file: str | None
    rows: int = 0
    first: int | None = None
    last: int | None = None


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:").rstrip("/") or "/"


class _Folder:
    def __init__(self, options: dict) -> None:
        self.path = local(options["path"])
        self.time = options.get("time")

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        """Write a task's rows as they come, one batch of them in memory at a time."""
        name, writer, rows, bounds = f"{uuid.uuid4().hex}.parquet", None, 0, []
        try:
            for batch in batches:
                if writer is None:
                    os.makedirs(f"{self.path}/staged", exist_ok=True)
                    writer = pq.ParquetWriter(f"{self.path}/staged/{name}", batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
                if self.time is not None:
                    # Whatever its unit and zone, a time is microseconds here.
                    column = batch.column(self.time)
                    zone = getattr(column.type, "tz", None)
                    times = column.cast(pa.timestamp("us", zone)).cast(pa.int64())
                    bounds += [at for at in pc.min_max(times).as_py().values() if at is not None]
                    bounds = [min(bounds), max(bounds)] if bounds else []
        finally:
            if writer is not None:
                writer.close()
        if writer is None:
            return Staged(None)
        return Staged(name, rows, *bounds)

    def publish(self, messages: Sequence[Staged | None], run: str, batch: int) -> bool:
        """Make a batch seen, once; gives whether it was this time."""
        place = f"{self.path}/published/{run}"
        name = f"{place}/{batch:012d}.json"
        staged = [message for message in messages if message is not None and message.file]
        if os.path.exists(name):
            self.discard(messages)
            return False
        os.makedirs(place, exist_ok=True)
        os.makedirs(f"{self.path}/data", exist_ok=True)
        version = f"{time.time_ns():0{_VERSION_DIGITS}d}"
        lines = []
        for message in staged:
            file = f"{version}-{message.file}"
            os.rename(f"{self.path}/staged/{message.file}", f"{self.path}/data/{file}")
            lines.append(json.dumps({**message.__dict__, "file": file}) + "\n")
        draft = f"{place}/_{uuid.uuid4().hex}"
        with open(draft, "w") as out:
            out.writelines(lines)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(draft, name)  # fails where it exists, unlike a rename
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True

    def discard(self, messages: Sequence[Staged | None]) -> None:
        for message in messages:
            if message is not None and message.file and os.path.exists(f"{self.path}/staged/{message.file}"):
                os.unlink(f"{self.path}/staged/{message.file}")


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.folder = _Folder(options)
        self.run = options.get("run") or f"batch-{uuid.uuid4().hex}"
        self.batch = int(options.get("batch", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.folder.stage(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        self.folder.publish(messages, self.run, self.batch)

    def abort(self, messages: list[Staged | None]) -> None:
        self.folder.discard(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict) -> None:
        self.folder = _Folder(options)
        self.run, self.checkpoint = options.get("run"), options.get("checkpointLocation")
        if not self.run and not self.checkpoint:
            raise ValueError("a stream needs the option run, or a checkpointLocation of its own")

    def _run(self) -> str:
        if self.run:
            return self.run
        with open(f"{local(self.checkpoint)}/metadata") as file:
            return json.loads(file.read())["id"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.folder.stage(iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self.folder.publish(messages, self._run(), batchId)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.folder.discard(messages)


class PublishedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: T.StructType, overwrite: bool) -> _BatchWriter:
        if overwrite:
            raise ValueError("this table only appends; keys are overwritten when read")
        return _BatchWriter(self.options)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> str:
    """The name of the format, known to the session."""
    spark.dataSource.register(PublishedSink)
    return NAME


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The published files with their rows and, where the writer was told ``time``, its bounds."""
    if not os.path.isdir(f"{local(path)}/published"):
        return spark.createDataFrame([], _ENTRY)
    listed = spark.read.schema(_ENTRY).option("recursiveFileLookup", "true")
    return listed.json(f"{path}/published")


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = (),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """The rows of all published batches.

    ``keys`` keeps the row of each key that was published last. ``since`` and ``until`` leave out
    files that have no time between them; exact bounds are the query's business, and under
    ``keys`` files must hold a key at one time only, as windows and stable ids do.
    The names of the files pass through the driver, as in any listing.
    """
    files = entries(spark, path)
    if since is not None:
        files = files.where(F.col("last") >= F.unix_micros(clock.instant(since)))
    if until is not None:
        files = files.where(F.col("first") <= F.unix_micros(clock.instant(until)))
    names = [f"{path.rstrip('/')}/data/{row.file}" for row in files.select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*names)
    if not keys:
        return rows
    version = F.substring("_metadata.file_name", 1, _VERSION_DIGITS)
    return latest_row(rows.withColumn("_version", version), keys, ["_version"]).drop("_version")


def remove_unseen(spark: SparkSession, path: str, older_than_seconds: float) -> int:
    """Remove files that no batch lists, left by tasks or drivers that died; gives their number.

    ``older_than_seconds`` spares those of a batch that is being written.
    """
    root, limit, removed = local(path), time.time() - older_than_seconds, 0
    seen = {row.file for row in entries(spark, path).select("file").collect()}
    for part in ("staged", "data"):
        if os.path.isdir(f"{root}/{part}"):
            for each in os.scandir(f"{root}/{part}"):
                if each.name not in seen and each.stat().st_mtime < limit:
                    os.unlink(each.path)
                    removed += 1
    return removed
