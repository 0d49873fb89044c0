"""From ticks to rows of the raw trade table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock, ids
from tidemark.operators.upserts import latest_row


def with_event_time(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("event_time", clock.event_time(F.col("timestamp")))


def with_batch_stamp(rows: DataFrame) -> DataFrame:
    """Stamp rows with the ingestion time.

    Inside a streaming plan this is the start time of the micro-batch, which Spark keeps in
    the checkpoint: a replayed batch gets the same stamp, unlike one taken in foreachBatch.
    """
    return rows.withColumn("ingestion_time", F.current_timestamp())


def raw_rows_exact(ticks: DataFrame, row_id: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Trade rows with the event time in exact milliseconds and a chosen id."""
    return ticks.select(
        row_id.alias("id"),
        "symbol",
        "price",
        "volume",
        F.col("timestamp").alias("trade_timestamp"),
        *keep,
    )


def raw_rows_by_event_time(ticks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trade rows with the event time floored to seconds and the event time as id.

    The id is per millisecond and not per trade: see ``last_per_event_time``.
    """
    at = clock.event_time(F.col("timestamp"))
    return ticks.select(
        ids.event_time_id(at).alias("id"),
        "symbol",
        "price",
        "volume",
        clock.whole_second_millis(at).alias("trade_timestamp"),
        *keep,
    )


def last_per_event_time(ticks: DataFrame) -> DataFrame:
    """The one trade per event millisecond that survives in a table keyed by event time.

    Which one that is depends on arrival in a live table; here it is the greatest by
    symbol, price and volume. Groups on the number and makes the text once per result row.
    """
    timed = ticks.where(F.col("timestamp").isNotNull())
    trades = timed.select("timestamp", "symbol", "price", "volume")
    survivors = latest_row(trades, ["timestamp"], ["symbol", "price", "volume"])
    return survivors.select(
        ids.event_time_id(clock.event_time(F.col("timestamp"))).alias("id"),
        "symbol",
        "price",
        "volume",
    )


def keys_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def split_null_keys(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed table can take, and the rest for quarantine."""
    return rows.where(keys_present(keys)), rows.where(~keys_present(keys))
