"""Sums per hour and day of ingestion, and look-backs made of the largest blocks inside them.

A block is a whole hour or day. A look-back with open bounds takes the days inside it, the hours
between these and its bounds, and raw trades of what is left at both ends: less than an hour each.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock

LEVELS = {"day": timedelta(days=1), "hour": timedelta(hours=1)}
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class Range(NamedTuple):
    """From ``first`` to before ``last``; ``first`` itself is out where that is open."""

    first: datetime
    last: datetime
    open_first: bool = False


def sums(trades: DataFrame) -> DataFrame:
    """(level, block, symbol, trade_count, total_volume, price_sum, price_count) of trades.

    Of one batch or of a whole table: blocks of several add up.
    """
    hours = _sums(trades, F.date_trunc("hour", "ingestion_time"), *_of_trades())
    days = _sums(hours, F.date_trunc("day", "block"), *_of_sums())
    return hours.withColumn("level", F.lit("hour")).unionByName(days.withColumn("level", F.lit("day")))


def _of_trades() -> list[Column]:
    return [
        F.count("*").alias("trade_count"),
        F.sum("volume").alias("total_volume"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"),
    ]


def _of_sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("trade_count", "total_volume", "price_sum", "price_count")]


def _sums(rows: DataFrame, block: Column, *aggregates: Column) -> DataFrame:
    return rows.groupBy(block.alias("block"), "symbol").agg(*aggregates)


def cover(since: datetime, until: datetime) -> dict[str, list[Range]]:
    """Ranges of days, hours and raw trades that make up (since, until), each moment once."""
    rest = [Range(clock.as_utc(since), clock.as_utc(until), True)]
    found: dict[str, list[Range]] = {}
    for level, size in LEVELS.items():
        found[level], left = [], []
        for span in rest:
            # The first block that begins inside, and the end of the last that ends inside. A block
            # that begins on an open bound is not inside.
            behind = (span.first - _EPOCH) // size + 1
            if (span.first - _EPOCH) % size == timedelta(0) and not span.open_first:
                behind -= 1
            first, last = _EPOCH + behind * size, _EPOCH + ((span.last - _EPOCH) // size) * size
            if first < last:
                found[level].append(Range(first, last))
                left += [Range(span.first, first, span.open_first), Range(last, span.last)]
            else:
                left.append(span)
        rest = [span for span in left if span.first < span.last]
    return found | {"raw": rest}


def totals(trades: DataFrame, blocks: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """(symbol, trade_count, total_volume, price) of the trades ingested in (since, until)."""
    spans = cover(since, until)
    raw = trades.where(_within("ingestion_time", spans["raw"]))
    parts = raw.groupBy("symbol").agg(*_of_trades())
    inside = F.lit(False)
    for level in LEVELS:
        inside = inside | ((F.col("level") == level) & _within("block", spans[level]))
    parts = parts.unionByName(blocks.where(inside).groupBy("symbol").agg(*_of_sums()))
    added = parts.where(F.col("symbol").isNotNull()).groupBy("symbol").agg(*_of_sums())
    return added.select(
        "symbol",
        "trade_count",
        F.coalesce("total_volume", F.lit(0.0)).alias("total_volume"),
        F.try_divide("price_sum", "price_count").alias("price"),
    )


def _within(column: str, spans: list[Range]) -> Column:
    found = F.lit(False)
    for span in spans:
        first = clock.instant(span.first)
        after = F.col(column) > first if span.open_first else F.col(column) >= first
        found = found | (after & (F.col(column) < clock.instant(span.last)))
    return found
