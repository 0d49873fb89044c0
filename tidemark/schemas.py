"""Declared schemas of messages, ticks and tables. Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T


def columns(**types: str) -> T.StructType:
    """A flat schema of nullable columns."""
    schema = T.StructType()
    for name, kind in types.items():
        schema.add(name, kind)
    return schema


# Field names and types of the feed's JSON messages.
FEED_TRADE = columns(c="string", p="double", s="string", t="long", v="double")
ENVELOPE = T.StructType().add("data", T.ArrayType(FEED_TRADE)).add("type", "string")

# The part of ENVELOPE that ticks are made of. The JSON reader skips undeclared fields
# without building them, so trade conditions and message type cost nothing.
FEED_TICK = columns(p="double", s="string", t="long", v="double")
TICK_ENVELOPE = T.StructType().add("data", T.ArrayType(FEED_TICK))

TICKS = columns(symbol="string", price="double", volume="double", timestamp="long")

TRADES = columns(
    id="string",
    symbol="string",
    price="double",
    volume="double",
    trade_timestamp="long",
    ingestion_time="timestamp",
)

TRADE_AGGREGATIONS = columns(
    window_start="timestamp",
    window_end="timestamp",
    symbol="string",
    avg_price="double",
    trade_count="long",
)

# Stats on disk are sums, so that those of several sources add up, and know when they were
# written: of the rows of one source the newest counts.
AGGREGATION_SUMS = columns(
    window_start="timestamp",
    window_end="timestamp",
    symbol="string",
    price_sum="double",
    price_count="long",
    trade_count="long",
    written_at="timestamp",
)

# A tick that came when its window was closed, and the watermark that had passed the window.
LATE_TICKS = columns(
    window_start="timestamp",
    window_end="timestamp",
    symbol="string",
    price="double",
    volume="double",
    event_time="timestamp",
    watermark="timestamp",
    ingestion_time="timestamp",
)

TRADES_KEY = ("id",)
TRADE_AGGREGATIONS_KEY = ("window_start", "symbol")

# Partition columns added to the tables on disk. Rows without a full key go to the rejected
# part in the same write; hour and day are derived from a time column. A batch of trades has
# one stamp and so touches one hour, while the windows of a backfill span all its days.
REJECTED = "rejected"
TRADES_PERIOD = "ingestion_hour"
AGGREGATIONS_PERIOD = "window_day"

# Who wrote: the feed's label, the run (a new one for each new checkpoint) and its micro-batch.
# As partitions these make a replayed batch overwrite itself and nothing else.
SOURCE = "source"
RUN_ID = "run_id"
BATCH_ID = "batch_id"
WRITER = (SOURCE, RUN_ID, BATCH_ID)


def stored(columns: T.StructType, period: str) -> T.StructType:
    """A table's columns on disk: its own and the partition columns."""
    return T.StructType(
        [
            *columns.fields,
            T.StructField(REJECTED, T.BooleanType()),
            T.StructField(period, T.StringType()),
            T.StructField(SOURCE, T.StringType()),
            T.StructField(RUN_ID, T.StringType()),
            T.StructField(BATCH_ID, T.LongType()),
        ]
    )


STORED_TRADES = stored(TRADES, TRADES_PERIOD)
STORED_AGGREGATIONS = stored(AGGREGATION_SUMS, AGGREGATIONS_PERIOD)
STORED_LATE_TICKS = stored(LATE_TICKS, AGGREGATIONS_PERIOD)
