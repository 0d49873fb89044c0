"""The windows in a stream's state, read back from its checkpoint and handed over.

A stateful stream keeps the number of shuffle partitions that it was started with. To go on with
another one, stop it, hand its windows over to the stats table and start a new job, under a
source of its own, from the offsets at which the old one ended: readers add up sources.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.sources import folders
from tidemark.streaming import sinks
from tidemark.streaming.sinks import Table

HANDED_OVER = "handed-over"
# The aggregates of window_sums in their order; Spark names state columns by function.
_SUMS = "struct<price_sum: double, price_count: bigint, trade_count: bigint>"


def read_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The windows a stats job has open, as of its last or of a given batch."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    sums = F.col("value").cast(_SUMS).alias("sums")
    rows = reader.load(checkpoint).select("key.window.*", "key.symbol", sums)
    return rows.select(
        F.col("start").alias("window_start"), F.col("end").alias("window_end"), "symbol", "sums.*"
    )


def partitions_of(spark: SparkSession, checkpoint: str) -> int:
    """The number of partitions that the state of a job is kept in."""
    metadata = spark.read.format("state-metadata").load(checkpoint)
    return metadata.agg(F.max("numPartitions")).first()[0]


def end_offsets(spark: SparkSession, checkpoint: str) -> str:
    """Where the last whole batch of a job with one source ended, as the source wrote it.

    It fits ``startingOffsets`` of sources that have such an option.
    """
    root = checkpoint.rstrip("/")
    last = max((int(name) for name in folders.files(spark, f"{root}/commits") if name.isdigit()), default=None)
    if last is None:
        raise ValueError(f"no batch of {checkpoint} has ended")
    lines = spark.read.text(f"{root}/offsets/{last}", wholetext=True).first().value.splitlines()
    _, _, offsets = lines  # version, settings, one line per source
    return offsets


def differences(windows: DataFrame, stored: DataFrame) -> DataFrame:
    """Windows of the state whose stored stats are missing or other, with both trade counts.

    For jobs that store running stats; averages may differ by what the order of sums leaves.
    """
    keys = list(schemas.TRADE_AGGREGATIONS_KEY)
    expected = windows.select(
        *keys,
        F.try_divide("price_sum", "price_count").alias("state_price"),
        F.col("trade_count").alias("state_count"),
    )
    found = stored.select(*keys, F.col("avg_price").alias("stored_price"), F.col("trade_count").alias("stored_count"))
    same = F.col("state_count").eqNullSafe(F.col("stored_count")) & F.coalesce(
        F.abs(F.col("state_price") - F.col("stored_price")) <= 1e-9 * F.greatest(F.abs("state_price"), F.lit(1.0)),
        F.col("state_price").isNull() & F.col("stored_price").isNull(),
    )
    return expected.join(found, keys, "left").where(~same)


def hand_over(spark: SparkSession, checkpoint: str, stats: Table, stamp: datetime) -> str:
    """Store the windows that a stopped job still holds; gives the offsets to go on from.

    They are rows of the job's own source and replace what it has stored of the same windows, so
    running stats stay as they are and open windows of an append job are no longer missing. Doing
    it twice changes nothing.
    """
    sums = read_windows(spark, checkpoint).withColumn("written_at", clock.instant(stamp))
    run = f"{HANDED_OVER}-{sinks.run_of(spark, checkpoint)}"
    sinks.batch_writer(stats, run, files_per_period=1)(sums.select(*schemas.AGGREGATION_SUMS.names), 0)
    return end_offsets(spark, checkpoint)
