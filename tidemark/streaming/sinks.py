"""Writing tables from streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators.ticks import keys_present
from tidemark.sources import published

# File formats that only append: a replayed batch would be there twice.
_APPENDING = ("avro", "csv", "json", "orc", "text", "xml")


@dataclass(frozen=True)
class Table:
    """Where a stream writes: a folder of Parquet, or any store Spark has a connector for.

    ``source`` names the feed that is written. Each source has its own part of the table: the
    rows of several feeds, or of history and a live stream, stand side by side.

    Connectors take their settings (namespace, table, hosts) in ``options`` and do the keyed
    overwrite themselves. They get every row: a store that refuses rows without a key needs
    ``split_null_keys`` before it. The sink of ``sources.published`` is told run and batch, too.
    """

    path: str | None
    source: str
    keys: Sequence[str]
    time: str
    period: str
    pattern: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.format in _APPENDING:
            raise ValueError(f"{self.format} cannot replace what a replayed batch wrote before")

    @property
    def on_files(self) -> bool:
        return self.format == "parquet"

    def partitioned(self, rows: DataFrame) -> DataFrame:
        period = clock.partition_key(F.col(self.time), self.pattern)
        return rows.withColumns(
            {schemas.REJECTED: ~keys_present(self.keys), self.period: period}
        )


def trades_table(path: str | None, source: str, **settings) -> Table:
    return Table(
        path,
        source,
        schemas.TRADES_KEY,
        "ingestion_time",
        schemas.TRADES_PERIOD,
        clock.HOURLY,
        **settings,
    )


def aggregations_table(path: str | None, source: str, **settings) -> Table:
    return Table(
        path,
        source,
        schemas.TRADE_AGGREGATIONS_KEY,
        "window_start",
        schemas.AGGREGATIONS_PERIOD,
        clock.DAILY,
        **settings,
    )


def late_table(path: str | None, source: str, **settings) -> Table:
    """Where ticks go that came after their window was closed."""
    return aggregations_table(path, source, **settings)


def batch_writer(
    table: Table, run: str | Callable[[], str], files_per_period: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes one micro-batch in one distributed job.

    On files, a batch owns the partitions of its source, run and number and overwrites just
    those, so a batch that is replayed after a failure replaces what it wrote before, and no
    other writer's rows. Failures are raised: the stream stops and resumes from its checkpoint
    with no rows lost.

    Every task writes a file for every period it has rows of, unless ``files_per_period`` bounds
    them by one more shuffle (``_evened``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = run if isinstance(run, str) else run()
        if not table.on_files:
            writer = batch.write.format(table.format).options(**table.options)
            if table.format == published.NAME:
                writer = writer.options(run=run_id, batch=batch_id)
            writer.mode("append").save(table.path)
            return
        rows = table.partitioned(batch).withColumns(
            {
                schemas.SOURCE: F.lit(table.source),
                schemas.RUN_ID: F.lit(run_id),
                schemas.BATCH_ID: F.lit(batch_id).cast("bigint"),
            }
        )
        if files_per_period is not None:
            rows = _evened(rows, table, files_per_period)
        (
            rows.write.format(table.format)
            .options(**table.options)
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(schemas.REJECTED, table.period, *schemas.WRITER)
            .save(table.path)
        )

    return write


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: a new one for each new checkpoint."""
    [line] = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads(line.value)["id"]


def _evened(rows: DataFrame, table: Table, files_per_period: int) -> DataFrame:
    """Rows of a period together, in files of Spark's advisory size or in a fixed number.

    Adaptive execution merges small and splits large periods by their real size. Streams with
    state run without it, and ignore the hint: there each period gets a number of slots.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", table.period)
    slot = F.pmod(F.xxhash64(*table.keys), F.lit(files_per_period))
    return rows.repartition(table.period, slot)


def start_batches(
    rows: DataFrame,
    table: Table,
    checkpoint: str,
    mode: str,
    name: str | None = None,
    trigger: dict | None = None,
    files_per_period: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Write every micro-batch with ``batch_writer``, after ``prepare`` has made its rows."""
    run = cache(lambda: run_of(rows.sparkSession, checkpoint))
    write = batch_writer(table, run, files_per_period)
    return start_each(rows, lambda batch, number: write(prepare(batch), number), checkpoint, mode, name, trigger)


def start_each(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every micro-batch and its number to a function."""
    return _start(rows.writeStream.foreachBatch(write).outputMode(mode), checkpoint, name, trigger)


def start_append(
    rows: DataFrame,
    table: Table,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write with the connector's own streaming sink."""
    writer = rows.writeStream.format(table.format).options(**table.options).outputMode("append")
    if table.path is not None:
        writer = writer.option("path", table.path)
    return _start(writer, checkpoint, name, trigger)


def _start(writer, checkpoint: str, name: str | None, trigger: dict | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()
