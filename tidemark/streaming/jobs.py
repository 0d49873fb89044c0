"""The streaming jobs: one tick stream feeds the trade table and the window stats.

Each table can be kept in two ways. *Batches*: every micro-batch is written as it comes, stats
as running values that overwrite each other by key, with trades of any lateness accepted.
*Append*: rows are final when written, stats once per window after the watermark has closed it.
Stats can be kept in a third way, as *deltas*: each micro-batch writes the sums of its own trades,
which are added up when read, so trades of any lateness count and no state is kept.
"""

from __future__ import annotations

import itertools
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import clock, ids
from tidemark.operators import ticks as tick_ops
from tidemark.operators.envelopes import parse_envelopes
from tidemark.operators.windows import LATENESS, WINDOW_SIZE, window_stats, window_sums
from tidemark.session import keep_state_off_heap, pin_utc
from tidemark.streaming import sinks
from tidemark.streaming.metrics import count_rows
from tidemark.streaming.sinks import Table

# Run and batch number of backfills; streams have ids of their own and count from 0.
BACKFILL_RUN = "backfill"
BACKFILL = -1
# Files that a batch of stats writes per day of windows; a hot day is worth more.
FILES_PER_DAY = 1

TICK_IDENTITY = ("message_id", "position", "symbol", "price", "volume", "timestamp")


def ticks_of(messages: DataFrame) -> DataFrame:
    """Ticks of a message source, with what a stable id needs."""
    return parse_envelopes(messages, keep=["message_id"], with_position=True)


def tick_id() -> Column:
    """The stable id of the ticks of ``ticks_of``."""
    return ids.stable_id(*[F.col(c) for c in TICK_IDENTITY])


def start_raw_batches(
    ticks: DataFrame,
    table: Table,
    checkpoint: str,
    row_id: Column | None = None,
    **settings,
) -> StreamingQuery:
    """Trade rows with exact event time, a stable id unless another is given."""
    rows = tick_ops.raw_rows_exact(ticks, tick_id() if row_id is None else row_id)
    rows = count_rows(tick_ops.with_batch_stamp(rows))
    return sinks.start_batches(rows, table, checkpoint, "append", **settings)


def start_raw_append(
    ticks: DataFrame, table: Table, checkpoint: str, **settings
) -> StreamingQuery:
    """Trade rows with event time in whole seconds and the event time as id."""
    pin_utc(ticks.sparkSession)  # the id is a time as text
    rows = tick_ops.with_batch_stamp(tick_ops.raw_rows_by_event_time(ticks))
    if not table.on_files:
        return sinks.start_append(count_rows(rows), table, checkpoint, **settings)
    return sinks.start_batches(count_rows(rows), table, checkpoint, "append", **settings)


def start_stats_upsert(
    ticks: DataFrame,
    table: Table,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    watermark: str | None = None,
    files_per_day: int | None = FILES_PER_DAY,
    **settings,
) -> StreamingQuery:
    """Running stats of the windows each batch changed.

    Without a watermark state grows with every window ever seen. With one, state is bounded
    and later trades are dropped and counted (``rows_dropped_as_late``).
    """
    keep_state_off_heap(ticks.sparkSession)
    settings["files_per_period"] = files_per_day
    stats = _stats(ticks, table, size, watermark)
    return sinks.start_batches(stats, table, checkpoint, "update", **settings)


def start_stats_append(
    ticks: DataFrame,
    table: Table,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    watermark: str = LATENESS,
    files_per_day: int | None = FILES_PER_DAY,
    **settings,
) -> StreamingQuery:
    """Final stats of each window, once the watermark has passed its end."""
    keep_state_off_heap(ticks.sparkSession)
    stats = _stats(ticks, table, size, watermark)
    if not table.on_files:
        return sinks.start_append(stats, table, checkpoint, **settings)
    settings["files_per_period"] = files_per_day
    return sinks.start_batches(stats, table, checkpoint, "append", **settings)


def start_stats_delta(
    ticks: DataFrame,
    table: Table,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    files_per_day: int | None = FILES_PER_DAY,
    **settings,
) -> StreamingQuery:
    """The sums of each batch's own trades, to be read with ``tables.read_deltas``.

    The stream is stateless: windows never close, nothing is late and nothing is remembered. A
    batch that is replayed replaces its own sums, as each batch owns its partitions.
    """
    rows = count_rows(tick_ops.with_batch_stamp(tick_ops.with_event_time(ticks)))

    def own_sums(batch: DataFrame) -> DataFrame:
        return window_sums(batch, size, extra=[F.max("ingestion_time").alias("written_at")])

    return sinks.start_batches(
        rows, table, checkpoint, "append", files_per_period=files_per_day, prepare=own_sums, **settings
    )


def backfill(
    ticks: DataFrame, trades: Table, stats: Table, stamp: datetime, size: str = WINDOW_SIZE
) -> None:
    """Write both tables from a batch of ticks, all windows included.

    ``stamp`` is the ingestion time of all rows; running again with the same tables and stamp
    replaces what was written. The tables' source must be this backfill's own: what other
    sources have of a window is added to what it has.
    """
    rows = tick_ops.raw_rows_exact(ticks, tick_id())
    rows = rows.withColumn("ingestion_time", clock.instant(stamp))
    sinks.batch_writer(trades, BACKFILL_RUN)(rows, BACKFILL)
    result = _stats(ticks, stats, size, None)
    if stats.on_files:
        result = result.withColumn("written_at", clock.instant(stamp))
    # A batch has no state that fixes its number of tasks: files follow the size of a day.
    sinks.batch_writer(stats, BACKFILL_RUN, files_per_period=1)(result, BACKFILL)


def _stats(ticks: DataFrame, table: Table, size: str, watermark: str | None) -> DataFrame:
    """Stamped sums for files, which are added up when read, and averages for a store."""
    ticks = tick_ops.with_event_time(ticks)
    if not table.on_files:
        return window_stats(ticks, size, watermark)
    sums = window_sums(ticks, size, watermark)
    return tick_ops.with_batch_stamp(sums).withColumnRenamed("ingestion_time", "written_at")


def run_until_any_ends(*queries: StreamingQuery, poll_seconds: float = 1.0) -> None:
    """Block until one of the given queries ends, then stop the others; a failure is raised.

    Other queries of the session may start and end as they like.
    """
    try:
        waiting = itertools.cycle(queries)
        while all(query.isActive for query in queries):
            next(waiting).awaitTermination(poll_seconds)
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        query.awaitTermination()
