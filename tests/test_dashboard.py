"""Dashboard queries against the same figures worked out by pandas on small frames."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from tidemark import schemas
from tidemark.plans import dashboard

NOW = datetime(2024, 5, 1, 12)
MINUTES = 30
START = NOW - timedelta(minutes=MINUTES)
UTC = "+00:00"


def trades_rows(seed):
    random.seed(seed)
    stamps = [START + timedelta(minutes=m) for m in (-1, 0, 1, 10, 29, 30, 31)]
    rows = []
    for i in range(300):
        rows.append(
            (
                f"id{i:04d}",
                random.choice(["A", "B", "C", None]),
                random.choice([None, float("nan"), round(random.random() * 9, 2)]),
                random.choice([None, float("nan"), float(random.randrange(9))]),
                1714000000000 + i * 7919 % 1009 * 1000 + i,
                random.choice(stamps),
            )
        )
    rows.append(("idx", "EMPTY", None, None, 1714000000000, START + timedelta(minutes=2)))
    return rows


@pytest.fixture(params=[1, 2])
def frame(request):
    return pd.DataFrame(trades_rows(request.param), columns=schemas.TRADES.names)


@pytest.fixture
def trades(spark, frame):
    text = [
        (*row[:5], row[5].isoformat(" ")) for row in frame.itertuples(index=False, name=None)
    ]
    none = [tuple(None if v is pd.NaT else v for v in row) for row in text]
    names = schemas.TRADES.names
    raw = spark.createDataFrame(
        none, "id string, symbol string, price double, volume double, t bigint, i string"
    ).toDF(*names)
    return raw.withColumn("ingestion_time", raw.ingestion_time.cast("timestamp"))


def inside(frame):
    return frame[(frame.ingestion_time > START) & (frame.ingestion_time < NOW)]


def collected(result):
    """Rows as tuples; times as naive UTC; NaN as None."""
    times = [c for c, kind in result.dtypes if kind == "timestamp"]
    for c in times:
        result = result.withColumn(c, result[c].cast("timestamp_ntz"))
    return [tuple(r) for r in result.collect()]


def expected(series):
    return [
        (*(k if isinstance(k, tuple) else (k,)), None if pd.isna(v) else v)
        for k, v in series.items()
    ]


def test_count_trend(trades, frame):
    want = expected(inside(frame).groupby(["ingestion_time", "symbol"]).size())
    assert collected(dashboard.trade_count_trend(trades, NOW, MINUTES)) == want


def test_volume_trend(trades, frame):
    want = expected(inside(frame).groupby(["ingestion_time", "symbol"]).volume.sum())
    assert collected(dashboard.volume_trend(trades, NOW, MINUTES)) == want


def test_price_trend(trades, frame):
    want = expected(inside(frame).groupby(["ingestion_time", "symbol"]).price.mean())
    got = collected(dashboard.price_trend(trades, NOW, MINUTES))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for (*_, ours), (*_, theirs) in zip(got, want):
        assert ours == pytest.approx(theirs)


def test_latest_price(trades, frame):
    since = frame[frame.ingestion_time >= START].sort_values("trade_timestamp")
    want = expected(since.groupby("symbol").price.last())
    assert collected(dashboard.latest_price(trades, NOW, MINUTES)) == want


def test_latest_price_breaks_ties_by_arrival_then_price(spark):
    rows = [
        ("a", "A", 5.0, 1.0, 7, "2024-05-01 11:59:00"),
        ("b", "A", 9.0, 1.0, 7, "2024-05-01 11:58:00"),
        ("c", "A", 6.0, 1.0, 7, "2024-05-01 11:59:00"),
    ]
    trades = spark.createDataFrame(
        rows, "id string, symbol string, price double, volume double, trade_timestamp bigint, i string"
    ).selectExpr("*", "cast(i as timestamp) as ingestion_time")
    assert collected(dashboard.latest_price(trades, NOW)) == [("A", 6.0)]


def test_latest_trade_row(trades, frame):
    since = frame[frame.ingestion_time >= START].sort_values("trade_timestamp")
    want = since.dropna(subset="symbol").groupby("symbol").tail(1).sort_values("symbol")
    got = collected(dashboard.latest_trade_row(trades, NOW, MINUTES))
    assert [(g[0], g[1], g[4]) for g in got] == list(
        want[["id", "symbol", "trade_timestamp"]].itertuples(index=False, name=None)
    )


def test_stacked_volumes_add_up(trades, frame):
    volumes = inside(frame).groupby(["ingestion_time", "symbol"]).volume.sum()
    want = [
        (*key, volume, stacked)
        for (key, volume), stacked in zip(
            volumes.items(), volumes.groupby(level=0).cumsum().tolist()
        )
    ]
    assert collected(dashboard.volume_stacked(trades, NOW, MINUTES)) == want


@pytest.fixture
def stats(spark):
    rows = [
        (START, "A", 100),  # open ends: neither this
        (START + timedelta(seconds=5), "A", 1),
        (START + timedelta(seconds=5), "B", 2),
        (START + timedelta(minutes=5), "A", 3),
        (START + timedelta(minutes=5), None, 50),
        (START + timedelta(minutes=6), "C", None),
        (NOW, "B", 100),  # nor this
    ]
    text = [(w.isoformat(" "), s, n) for w, s, n in rows]
    return spark.createDataFrame(text, "w string, symbol string, trade_count bigint").selectExpr(
        "cast(w as timestamp) as window_start", "symbol", "trade_count"
    )


def test_trade_count(stats):
    got = collected(dashboard.trade_count_by_symbol(stats, NOW, MINUTES))
    assert got == [("A", 4), ("B", 2), ("C", 0)]


def test_trade_count_share(stats):
    got = collected(dashboard.trade_count_share(stats, NOW, MINUTES))
    assert got == [("A", 4, 4 / 6), ("B", 2, 2 / 6), ("C", 0, 0.0)]


def test_empty_look_back_keeps_the_schema(trades, stats):
    later = NOW + timedelta(days=9)
    for query, rows in (
        (dashboard.trade_count_by_symbol, stats),
        (dashboard.trade_count_share, stats),
        (dashboard.latest_price, trades),
        (dashboard.trade_count_trend, trades),
    ):
        now, later_result = query(rows, NOW, MINUTES), query(rows, later, 1)
        assert dashboard.has_rows(now)
        assert not dashboard.has_rows(later_result)
        assert later_result.schema == now.schema


def test_display_names(trades, stats):
    shown = dashboard.display_names
    assert shown(dashboard.trade_count_by_symbol(stats, NOW)).columns == ["Symbol", "Total Trades"]
    assert shown(dashboard.latest_price(trades, NOW)).columns == ["Symbol", "Latest Price"]
    assert shown(dashboard.trade_count_trend(trades, NOW)).columns == ["Time", "Symbol", "Trade Count"]
    assert shown(dashboard.volume_trend(trades, NOW)).columns == ["Time", "Symbol", "Total Volume"]
    assert shown(dashboard.price_trend(trades, NOW)).columns == ["Time", "Symbol", "Price"]


def test_labels(trades):
    rows = dashboard.latest_price_label(dashboard.latest_price(trades, NOW, MINUTES)).collect()
    assert [r.caption for r in rows] == [f"Latest Price for {r.symbol}" for r in rows]
