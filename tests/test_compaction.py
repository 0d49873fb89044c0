"""Folded periods: readers beside them, crashes, later batches, views, removal."""

from datetime import datetime, timedelta

import pytest

from tests.test_streams import A, B, C, ONCE, SECOND, Feed, message
from tidemark.sources import compaction, folders, tables
from tidemark.streaming import jobs, sinks

LATER = datetime(2100, 1, 1)
AT_ONCE = timedelta(seconds=-10)


@pytest.fixture
def feed(folder):
    return Feed(folder("feed"))


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def write(spark, feed, path, checkpoint, source="feed"):
    table = sinks.trades_table(path, source)
    jobs.start_raw_batches(feed.ticks(spark), table, checkpoint, trigger=ONCE).awaitTermination()


def test_trades_are_folded_as_they_are(spark, feed, folder):
    path = folder("trades")
    feed.add(A, SECOND, C, A, message((None, 1, B)).replace('"None"', "null"))
    write(spark, feed, path, folder("ck"))
    write(spark, feed, path, folder("ck2"), "feed two: a=b/c")
    before = tables.read_trades(spark, path)
    want = rows(before)
    assert compaction.compact_trades(spark, path, datetime(2024, 1, 1)) == []
    hours = compaction.compact_trades(spark, path, LATER)
    assert len(hours) in (1, 2)
    after = tables.read_trades(spark, path)
    assert rows(after) == want == rows(before)
    assert len(after.inputFiles()) <= 2 * len(hours) < len(before.inputFiles())
    assert compaction.compact_trades(spark, path, LATER) == []
    assert compaction.remove_replaced(spark, path, timedelta(hours=1)) == 0
    assert compaction.remove_replaced(spark, path, AT_ONCE) == 10
    assert rows(tables.read_trades(spark, path)) == want
    assert rows(tables.read_trades(spark, path, since=datetime(2024, 1, 1), until=LATER)) == want
    assert tables.read_trades(spark, path, until=datetime(2024, 1, 1)).count() == 0


def test_later_batches_are_read_beside_and_folded_again(spark, feed, folder):
    path = folder("trades")
    feed.add(A, SECOND)
    write(spark, feed, path, folder("ck"))
    compaction.compact_trades(spark, path, LATER)
    feed.add(C)
    write(spark, feed, path, folder("ck"))
    assert tables.read_trades(spark, path).count() == 6
    folded = compaction.compact_trades(spark, path, LATER)
    assert tables.read_trades(spark, path).count() == 6
    compaction.remove_replaced(spark, path, AT_ONCE)
    assert tables.read_trades(spark, path).count() == 6
    assert len(folded) in (0, 1)  # the later batch may have met the next hour


def test_a_crash_before_publishing_changes_nothing(spark, feed, folder, monkeypatch):
    path = folder("trades")
    feed.add(A, SECOND, C)
    write(spark, feed, path, folder("ck"))

    def fail(*args):
        raise OSError("before publishing")

    monkeypatch.setattr(folders, "publish_folded", fail)
    with pytest.raises(OSError):
        compaction.compact_trades(spark, path, LATER)
    assert tables.read_trades(spark, path).count() == 6
    monkeypatch.undo()
    assert compaction.compact_trades(spark, path, LATER)
    assert tables.read_trades(spark, path).count() == 6
    with pytest.raises(FileExistsError):
        folders.publish_folded(spark, path, {"number": 1, "periods": {}})


def test_views_show_folded_rows_once(spark, feed, folder):
    tables.create_tables(spark, "folded_db", folder("db"))
    feed.add(A, SECOND, C)
    write(spark, feed, f"{folder('db')}/trades", folder("ck"))
    stats = sinks.aggregations_table(f"{folder('db')}/trade_aggregations", "it's")
    jobs.start_stats_upsert(feed.ticks(spark), stats, folder("ck2"), trigger=ONCE).awaitTermination()

    def shown():
        tables.refresh_tables(spark, "folded_db")
        views = ("SELECT id FROM folded_db.trades", "SELECT * FROM folded_db.trade_aggregations")
        return [rows(spark.sql(view)) for view in views]

    want = shown()
    assert len(want[0]) == 6
    compaction.compact_trades(spark, f"{folder('db')}/trades", LATER)
    compaction.compact_aggregations(spark, stats.path, LATER)
    assert shown() == want
    for path in (f"{folder('db')}/trades", stats.path):
        assert compaction.remove_replaced(spark, path, AT_ONCE) > 0
    assert shown() == want
    feed.add(message(("A", 11, B + 150)))
    write(spark, feed, f"{folder('db')}/trades", folder("ck"))
    compaction.compact_trades(spark, f"{folder('db')}/trades", LATER)
    assert len(shown()[0]) == 7
    spark.sql("DROP DATABASE folded_db CASCADE")


def test_stats_beside_readers(spark, feed, folder):
    table = sinks.aggregations_table(folder("stats"), "feed")
    feed.add(A, SECOND, C)
    jobs.start_stats_upsert(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    before = tables.read_aggregations(spark, table.path)
    want = rows(before)
    assert compaction.compact_aggregations(spark, table.path, LATER) == ["2024-05-01"]
    assert rows(before) == want == rows(tables.read_aggregations(spark, table.path))
    feed.add(message(("A", 50, B + 100)))
    jobs.start_stats_upsert(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    newer = rows(tables.read_aggregations(spark, table.path))
    assert newer != want and len(newer) == len(want)
    assert compaction.compact_aggregations(spark, table.path, LATER) == ["2024-05-01"]
    assert compaction.remove_replaced(spark, table.path, AT_ONCE) == 5
    assert rows(tables.read_aggregations(spark, table.path)) == newer
