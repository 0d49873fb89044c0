"""Average price and trade count per tumbling event-time window and symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_SIZE = "5 seconds"
LATENESS = "10 seconds"


def window_sums(
    ticks: DataFrame,
    size: str = WINDOW_SIZE,
    watermark: str | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """What ``window_stats`` is made of: sums that can be added up further.

    ``ticks`` need an ``event_time``; rows without one belong to no window. All aggregates
    combine on the map side, so a symbol that holds a third of all trades still sends one row
    per window and task through the shuffle. ``extra`` aggregates come last, by their names.
    """
    sums = [
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"),
        F.count("*").alias("trade_count"),
    ]
    return _windows(ticks, size, watermark, [*sums, *extra])


def window_stats(
    ticks: DataFrame, size: str = WINDOW_SIZE, watermark: str | None = None
) -> DataFrame:
    """Average price and trade count; see ``window_sums``."""
    stats = [F.avg("price").alias("avg_price"), F.count("*").alias("trade_count")]
    return _windows(ticks, size, watermark, stats)


def _windows(
    ticks: DataFrame, size: str, watermark: str | None, aggregates: Sequence[Column]
) -> DataFrame:
    if watermark is not None:
        ticks = ticks.withWatermark("event_time", watermark)
    groups = ticks.where(F.col("event_time").isNotNull()).groupBy(F.window("event_time", size), "symbol")
    found = groups.agg(*aggregates)
    return found.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        *[name for name in found.columns if name not in ("window", "symbol")],
    )
