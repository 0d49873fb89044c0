"""State read back from checkpoints, and jobs that go on with another number of partitions."""

import os
from datetime import datetime

import pytest

from tests.test_feed import append
from tests.test_late import stats_of
from tests.test_streams import A, B, C, LATE_AT_ONCE, ON_TIME, ONCE, SECOND, Feed, message
from tidemark.sources import feed as feeds
from tidemark.sources import tables
from tidemark.streaming import jobs, sinks, state

STAMP = datetime(2024, 6, 1)


def rows(frame):
    return {tuple(row) for row in frame.collect()}


def test_state_holds_what_is_stored(spark, folder):
    feed = Feed(folder("feed")).add(A, SECOND, C, LATE_AT_ONCE)
    table = sinks.aggregations_table(folder("stats"), "feed")
    jobs.start_stats_upsert(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    windows = state.read_windows(spark, folder("ck"))
    assert windows.count() == 4
    stored = tables.read_aggregations(spark, table.path)
    assert state.differences(windows, stored).count() == 0
    [other] = state.differences(windows, stored.where("symbol != 'B'")).collect()
    assert (other.symbol, other.state_count, other.stored_count) == ("B", 1, None)
    earlier = state.read_windows(spark, folder("ck"), batch_id=0)
    assert sorted((r.symbol, r.price_sum, r.trade_count) for r in earlier.collect()) == [("A", 30.0, 2), ("B", 1.0, 1)]
    assert state.partitions_of(spark, folder("ck")) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_a_job_goes_on_with_other_partitions(spark, folder, mode):
    root = folder("lines")
    os.makedirs(root)
    start = jobs.start_stats_append if mode == "append" else jobs.start_stats_upsert
    parts = [[A, SECOND], [ON_TIME, message(("A", 11, B + 300), ("B", 7, B + 30500))], [C]]
    offsets = "{}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for number, lines in enumerate(parts):
        append(root, "a.txt", "\n".join(lines) + "\n")
        table = sinks.aggregations_table(folder("stats"), f"feed.{number}")
        ticks = jobs.ticks_of(feeds.stream_feed(spark, root, startingOffsets=offsets))
        spark.conf.set("spark.sql.shuffle.partitions", str(2 + number))
        try:
            start(ticks, table, folder(f"ck{number}"), trigger=ONCE).awaitTermination()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert state.partitions_of(spark, folder(f"ck{number}")) == 2 + number
        for _ in range(2):  # handing over twice changes nothing
            offsets = state.hand_over(spark, folder(f"ck{number}"), table, STAMP)
        lines_feed = Feed(folder(f"all{number}")).add(*[line for part in parts[: number + 1] for line in part])
        assert rows(tables.read_aggregations(spark, folder("stats"))) == stats_of(spark, lines_feed)


def test_a_checkpoint_without_batches(spark, folder):
    with pytest.raises(ValueError, match="no batch"):
        state.end_offsets(spark, folder("nothing"))
