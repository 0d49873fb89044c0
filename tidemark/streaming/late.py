"""Late ticks kept beside final stats, and added to the windows they missed.

Spark drops a tick whose window ended at or before the watermark of the batch before. Here the
stats and the ticks they are made of are two branches of one stream, so both see the same
micro-batches: each batch writes the windows that it closed, and its ticks that Spark has dropped
with the watermark they came behind. ``correct`` turns the kept ticks into sums of a source of
their own, and readers of the stats add up sources.
"""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import ticks as tick_ops
from tidemark.operators.windows import LATENESS, WINDOW_SIZE, window_sums
from tidemark.session import keep_state_off_heap
from tidemark.sources import tables
from tidemark.streaming import sinks
from tidemark.streaming.sinks import Table

CORRECTIONS = "corrections"
_TICK = [name for name in schemas.LATE_TICKS.names if name != "watermark"]


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds before which a batch drops windows: the watermark of the batch before.

    It stands in the checkpoint from before that batch ran, so a replay finds it again.
    """
    if batch_id == 0:
        return 0
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id - 1}")
    [line] = lines.where(F.col("value").contains('"batchWatermarkMs"')).collect()
    return json.loads(line.value)["batchWatermarkMs"]


def start_stats_append(
    ticks: DataFrame,
    stats: Table,
    late: Table,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    watermark: str = LATENESS,
    files_per_day: int | None = 1,
    **settings,
) -> StreamingQuery:
    """Final stats of each window in ``stats``, and the ticks that came too late in ``late``.

    A batch is kept until both tables are written, so that the stream's state is asked once.
    """
    spark = ticks.sparkSession
    keep_state_off_heap(spark)
    timed = tick_ops.with_event_time(ticks).withWatermark("event_time", watermark)
    sums = tick_ops.with_batch_stamp(window_sums(timed, size)).withColumnRenamed("ingestion_time", "written_at")
    window = F.window("event_time", size)
    windowed = tick_ops.with_batch_stamp(
        timed.where(F.col("event_time").isNotNull()).select(
            window.start.alias("window_start"), window.end.alias("window_end"),
            "symbol", "price", "volume", "event_time",
        )
    )
    both = sums.withColumn("closed", F.lit(True)).unionByName(
        windowed.withColumn("closed", F.lit(False)), allowMissingColumns=True
    )
    run = cache(lambda: sinks.run_of(spark, checkpoint))
    write_stats = sinks.batch_writer(stats, run, files_per_day)
    write_late = sinks.batch_writer(late, run, files_per_day)

    def write(batch: DataFrame, batch_id: int) -> None:
        passed = F.timestamp_millis(F.lit(late_watermark(batch.sparkSession, checkpoint, batch_id)))
        batch.persist()
        try:
            write_stats(batch.where("closed").select(*schemas.AGGREGATION_SUMS.names), batch_id)
            missed = batch.where(~F.col("closed") & (F.col("window_end") <= passed)).select(*_TICK)
            write_late(missed.withColumn("watermark", passed).select(*schemas.LATE_TICKS.names), batch_id)
        finally:
            batch.unpersist()

    return sinks.start_each(both, write, checkpoint, "append", **settings)


def correct(
    spark: SparkSession,
    late_path: str,
    stats: Table,
    stamp: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
) -> None:
    """Add late ticks to the windows they missed: all that are kept of the days of [since, until].

    They are summed anew each time, under a source of their own, and replace what the last
    correction wrote for the same days: running it again, or after further late ticks, counts
    each tick once.
    """
    late = tables.read_late(spark, late_path, since, until)
    sums = late.groupBy("window_start", "window_end", "symbol").agg(
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"),
        F.count("*").alias("trade_count"),
    )
    stamped = sums.withColumn("written_at", clock.instant(stamp))
    source = replace(stats, source=f"{stats.source}.late")
    sinks.batch_writer(source, CORRECTIONS, files_per_period=1)(stamped, 0)
