"""The test tables seen as trades: ``events`` rows and ``lineitem`` rows as ticks.

An event's type is its symbol and its value the price; a line item's return flag is the
symbol and its ship date the event time. Times are stored without a zone and mean UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock, ids
from tidemark.operators.windows import window_stats
from tidemark.schemas import columns
from tidemark.sources.files import stream_parquet

EVENTS = columns(
    event_id="long",
    ts="timestamp_ntz",
    user_id="long",
    event_type="string",
    value="double",
    props="string",
)
LINEITEM = columns(
    l_orderkey="long",
    l_partkey="long",
    l_suppkey="long",
    l_linenumber="integer",
    l_quantity="double",
    l_extendedprice="double",
    l_discount="double",
    l_tax="double",
    l_returnflag="string",
    l_linestatus="string",
    l_shipdate="timestamp_ntz",
)


def events(
    spark: SparkSession,
    sf_dir: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Events, with bounds on the stored time that reach the Parquet scan."""
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        rows = rows.where(F.col("ts") >= _zoneless(since))
    if until is not None:
        rows = rows.where(F.col("ts") < _zoneless(until))
    return rows


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")


def event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    return stream_parquet(spark, f"{sf_dir}/events.parquet", EVENTS, **options)


def event_ticks(rows: DataFrame) -> DataFrame:
    """Ticks with the event's id as message id, each event being a message of one tick."""
    return rows.select(
        F.col("event_id").alias("message_id"),
        F.lit(0).alias("position"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
        _millis("ts").alias("timestamp"),
    )


def lineitem_ticks(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("volume"),
        _millis("l_shipdate").alias("timestamp"),
    )


def event_trades(
    spark: SparkSession,
    sf_dir: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Stored trades, the hour of an event standing for its micro-batch's stamp."""
    if until is not None:
        until = until + timedelta(hours=1)
    ticks = event_ticks(events(spark, sf_dir, since, until))
    identity = ("message_id", "symbol", "price", "volume", "timestamp")
    return ticks.select(
        ids.stable_id(*[F.col(c) for c in identity]).alias("id"),
        "symbol",
        "price",
        "volume",
        F.col("timestamp").alias("trade_timestamp"),
        F.date_trunc("hour", clock.event_time(F.col("timestamp"))).alias("ingestion_time"),
    )


def event_stats(
    spark: SparkSession,
    sf_dir: str,
    size: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    ticks = event_ticks(events(spark, sf_dir, since, until))
    return window_stats(
        ticks.withColumn("event_time", clock.event_time(F.col("timestamp"))), size
    )


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _zoneless(moment: datetime) -> Column:
    return F.lit(clock.as_utc(moment).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
