from pyspark.sql import functions as F

from tidemark.operators import ticks as tick_ops
from tidemark.operators.upserts import latest_version
from tidemark.operators.windows import window_stats
from tidemark.streaming import jobs

TICKS = "symbol string, price double, volume double, timestamp bigint"
ROWS = [
    ("A", 10.0, 1.0, 1714567890100),
    ("B", 20.0, 2.0, 1714567890100),
    ("A", None, 3.0, 1714567890101),
    (None, 5.0, None, 1714567894999),
    ("A", 7.0, 1.0, None),
]


def test_rows_with_exact_time_keep_milliseconds(spark):
    ticks = spark.createDataFrame(ROWS, TICKS)
    rows = tick_ops.raw_rows_exact(ticks, F.lit("x"))
    assert rows.columns == ["id", "symbol", "price", "volume", "trade_timestamp"]
    assert {r.trade_timestamp for r in rows.collect()} == {r[3] for r in ROWS}


def test_rows_by_event_time_floor_to_seconds(spark):
    ticks = spark.createDataFrame(ROWS, TICKS)
    rows = tick_ops.raw_rows_by_event_time(ticks).collect()
    assert [(r.id, r.trade_timestamp) for r in rows] == [
        ("2024-05-01 12:51:30.1", 1714567890000),
        ("2024-05-01 12:51:30.1", 1714567890000),
        ("2024-05-01 12:51:30.101", 1714567890000),
        ("2024-05-01 12:51:34.999", 1714567894000),
        (None, None),
    ]


def test_one_trade_per_event_time_survives(spark):
    ticks = spark.createDataFrame(ROWS, TICKS)
    survivors = {tuple(r) for r in tick_ops.last_per_event_time(ticks).collect()}
    assert survivors == {
        ("2024-05-01 12:51:30.1", "B", 20.0, 2.0),
        ("2024-05-01 12:51:30.101", "A", None, 3.0),
        ("2024-05-01 12:51:34.999", None, 5.0, None),
    }


def test_split_null_keys_keeps_every_row(spark):
    ticks = spark.createDataFrame(ROWS, TICKS)
    valid, rejected = tick_ops.split_null_keys(ticks, ["symbol", "timestamp"])
    assert valid.count() == 3
    assert {tuple(r) for r in rejected.collect()} == {ROWS[3], ROWS[4]}


def test_stats_rules(spark):
    """Null prices count but do not average; no time, no window; no symbol is a symbol."""
    ticks = tick_ops.with_event_time(spark.createDataFrame(ROWS, TICKS))
    stats = {r.symbol: (r.avg_price, r.trade_count) for r in window_stats(ticks).collect()}
    assert stats == {"A": (10.0, 2), "B": (20.0, 1), None: (5.0, 1)}


def test_windows_are_half_open_and_start_at_the_epoch(spark):
    times = [0, 4999, 5000, -1]
    ticks = spark.createDataFrame([("A", 1.0, 1.0, t) for t in times], TICKS)
    stats = window_stats(tick_ops.with_event_time(ticks))
    seconds = stats.select(
        F.unix_seconds("window_start"), F.unix_seconds("window_end"), "trade_count"
    )
    assert {tuple(r) for r in seconds.collect()} == {(-5, 0, 1), (0, 5, 2), (5, 10, 1)}


def test_equal_trades_of_one_message_get_their_own_ids(spark):
    message = '{"data":[' + ",".join(['{"p":1,"s":"A","t":1,"v":1}'] * 3) + "]}"
    messages = spark.createDataFrame([("m1", message), ("m2", message)], "message_id string, value string")
    made = jobs.ticks_of(messages).select(jobs.tick_id().alias("id"))
    assert made.distinct().count() == 6
    again = jobs.ticks_of(messages).select(jobs.tick_id().alias("id"))
    assert made.exceptAll(again).count() == 0


def test_latest_version_takes_whole_rows(spark):
    log = spark.createDataFrame(
        [("k", 0, 1.0, "a"), ("k", 2, None, "c"), ("k", 1, 2.0, "b"), ("j", 0, 9.0, None),
         ("k", 2, None, "c")],
        "key string, version int, number double, text string",
    )
    latest = latest_version(log, ["key"], "version")
    assert {tuple(r) for r in latest.collect()} == {("k", None, "c"), ("j", 9.0, None)}
