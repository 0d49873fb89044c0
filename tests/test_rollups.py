"""Look-backs made of blocks against the same look-back over raw trades."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import rollups

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
MOMENTS = [timedelta(0), timedelta(hours=1), timedelta(days=1), timedelta(hours=5, minutes=7), timedelta(microseconds=1)]


def bounds(pick):
    first = START + sum((pick.choice(MOMENTS) * pick.randint(0, 3) for _ in range(3)), timedelta(0))
    return first, first + sum((pick.choice(MOMENTS) * pick.randint(0, 3) for _ in range(3)), timedelta(0))


def test_ranges_cover_each_moment_once():
    pick = random.Random(1)
    for _ in range(500):
        since, until = bounds(pick)
        spans = rollups.cover(since, until)
        every = sorted((span for found in spans.values() for span in found), key=lambda span: span.first)
        if since < until:
            assert every[0].first == since and every[0].open_first and every[-1].last == until
            assert all(a.last == b.first and not b.open_first for a, b in zip(every, every[1:], strict=False))
        else:
            assert not every
        for level, size in rollups.LEVELS.items():
            assert all((span.first - START) % size == (span.last - START) % size == timedelta(0) for span in spans[level])
        assert all(span.last - span.first <= timedelta(hours=1) or not spans["hour"] for span in spans["raw"])


def test_totals_match_raw_trades(spark):
    pick = random.Random(2)
    rows = []
    for _ in range(3000):
        at = START + sum((pick.choice(MOMENTS) * pick.randint(0, 4) for _ in range(4)), timedelta(0))
        rows.append((pick.choice(["A", "B", None]), pick.choice([None, 1.0, 2.5]), pick.choice([None, 3.0]), at))
    trades = spark.createDataFrame(rows, "symbol string, price double, volume double, ingestion_time timestamp")
    blocks = rollups.sums(trades).cache()
    for _ in range(8):
        since, until = bounds(pick)
        inside = trades.where(
            (F.col("ingestion_time") > clock.instant(since)) & (F.col("ingestion_time") < clock.instant(until))
        )
        want = inside.where("symbol IS NOT NULL").groupBy("symbol").agg(
            F.count("*"), F.coalesce(F.sum("volume"), F.lit(0.0)), F.avg("price")
        )
        got = rollups.totals(trades, blocks, since, until)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        # Nothing raw is read inside a block.
        for span in rollups.cover(since, until)["raw"]:
            assert span.last - span.first < timedelta(hours=1) + timedelta(microseconds=1) or until - since < timedelta(hours=2)
