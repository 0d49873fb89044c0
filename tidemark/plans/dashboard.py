"""Look-back queries over the trade table and the window stats.

Each takes the rows, the query time and the look-back in minutes. Rows without a symbol
belong to no group, and missing prices or volumes (null or NaN) are left out of a figure.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clock, labels
from tidemark.operators.upserts import latest_row

# Column names shown to dashboard users.
DISPLAY_NAMES = {
    "symbol": "Symbol",
    "total_trades": "Total Trades",
    "latest_price": "Latest Price",
    "time": "Time",
    "trade_count": "Trade Count",
    "total_volume": "Total Volume",
    "price": "Price",
}


# Look-backs in minutes when none is given.
COUNT_MINUTES = 10
PRICE_MINUTES = 5
TREND_MINUTES = 15


def trade_count_by_symbol(
    stats: DataFrame, now: datetime, lookback_minutes: float = COUNT_MINUTES
) -> DataFrame:
    """Total trades per symbol over the windows that start inside the look-back."""
    recent = _strictly_between(stats, "window_start", now, lookback_minutes)
    total = F.coalesce(F.sum("trade_count"), F.lit(0)).cast("bigint")
    return _with_symbol(recent).groupBy("symbol").agg(total.alias("total_trades")).orderBy("symbol")


def trade_count_share(
    stats: DataFrame, now: datetime, lookback_minutes: float = COUNT_MINUTES
) -> DataFrame:
    """Each symbol's part of all trades.

    The grand total is a scalar subquery over the same grouped rows, so both read one
    shuffle and no task sees all symbols.
    """
    totals = trade_count_by_symbol(stats, now, lookback_minutes)
    everything = totals.agg(F.sum("total_trades")).scalar()
    return totals.withColumn("share", F.col("total_trades") / everything)


def latest_price(
    trades: DataFrame, now: datetime, lookback_minutes: float = PRICE_MINUTES
) -> DataFrame:
    """Last known price per symbol by event time; null where a symbol never had one.

    Of trades with the same event and ingestion time the highest price counts. Leaving the
    id out of that choice keeps the table's widest column out of the scan.
    """
    price = _present("price")
    order = F.when(price.isNotNull(), F.struct("trade_timestamp", "ingestion_time", price))
    return (
        _with_symbol(_since(trades, now, lookback_minutes))
        .groupBy("symbol")
        .agg(F.max_by(price, order).alias("latest_price"))
        .orderBy("symbol")
    )


def latest_trade_row(
    trades: DataFrame, now: datetime, lookback_minutes: float = PRICE_MINUTES
) -> DataFrame:
    """The whole last trade of each symbol."""
    recent = _with_symbol(_since(trades, now, lookback_minutes))
    order = ["trade_timestamp", "ingestion_time", "id"]
    return latest_row(recent, ["symbol"], order).orderBy("symbol")


def latest_price_label(latest: DataFrame) -> DataFrame:
    """Caption and both price texts for each row of ``latest_price``."""
    price = F.col("latest_price")
    return latest.select(
        "symbol",
        labels.caption(F.col("symbol")).alias("caption"),
        labels.price_label(price).alias("rounded_text"),
        labels.price_label(price, two_decimals=False).alias("full_text"),
    )


def trends(trades: DataFrame, now: datetime, lookback_minutes: float = TREND_MINUTES) -> DataFrame:
    """Trade count, total volume and mean price per ingested batch and symbol, in one pass.

    The single trends below are projections of it: figures they leave out are not computed
    and their columns not read. Unknown volumes add 0, a mean of unknown prices is null.
    """
    return _trends(trades, now, lookback_minutes).orderBy("time", "symbol")


def trade_count_trend(
    trades: DataFrame, now: datetime, lookback_minutes: float = TREND_MINUTES
) -> DataFrame:
    return trends(trades, now, lookback_minutes).select("time", "symbol", "trade_count")


def volume_trend(
    trades: DataFrame, now: datetime, lookback_minutes: float = TREND_MINUTES
) -> DataFrame:
    return trends(trades, now, lookback_minutes).select("time", "symbol", "total_volume")


def price_trend(
    trades: DataFrame, now: datetime, lookback_minutes: float = TREND_MINUTES
) -> DataFrame:
    return trends(trades, now, lookback_minutes).select("time", "symbol", "price")


def volume_stacked(
    trades: DataFrame, now: datetime, lookback_minutes: float = TREND_MINUTES
) -> DataFrame:
    """``volume_trend`` with the height of each symbol's band when bands are stacked.

    The running sum sees one row per symbol and batch, never the trades.
    """
    below = (
        Window.partitionBy("time")
        .orderBy("symbol")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _trends(trades, now, lookback_minutes)
        .select("time", "symbol", "total_volume")
        .withColumn("stacked_volume", F.sum("total_volume").over(below))
        .orderBy("time", "symbol")
    )


def display_names(result: DataFrame) -> DataFrame:
    """The result under the column names shown to users."""
    return result.withColumnsRenamed({c: n for c, n in DISPLAY_NAMES.items() if c in result.columns})


def has_rows(result: DataFrame) -> bool:
    return not result.isEmpty()


def _trends(trades: DataFrame, now: datetime, lookback_minutes: float) -> DataFrame:
    recent = _strictly_between(trades, "ingestion_time", now, lookback_minutes)
    return (
        _with_symbol(recent)
        .groupBy(F.col("ingestion_time").alias("time"), "symbol")
        .agg(
            F.count("*").alias("trade_count"),
            F.coalesce(F.sum(_present("volume")), F.lit(0.0)).alias("total_volume"),
            F.avg(_present("price")).alias("price"),
        )
    )


def _with_symbol(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("symbol").isNotNull())


def _present(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name))


def _since(rows: DataFrame, now: datetime, minutes: float) -> DataFrame:
    start = clock.instant(clock.lookback_start(now, minutes))
    return rows.where(F.col("ingestion_time") >= start)


def _strictly_between(rows: DataFrame, time: str, now: datetime, minutes: float) -> DataFrame:
    start = clock.instant(clock.lookback_start(now, minutes))
    return rows.where((F.col(time) > start) & (F.col(time) < clock.instant(now)))
