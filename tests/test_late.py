"""Stats as deltas, and late ticks that are kept and added to closed windows."""

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.test_streams import A, B, C, LATE, LATE_AT_ONCE, ON_TIME, ONCE, SECOND, Feed, message
from tidemark.operators import ticks as tick_ops
from tidemark.operators.windows import window_stats
from tidemark.sources import tables
from tidemark.streaming import jobs, late, metrics, sinks

STAMP = datetime(2024, 6, 1)
NULLS = (
    f'{{"data":[{{"p":2,"s":"B","t":{B + 60000}}},{{"p":1,"s":null,"t":{B}}},'
    f'{{"p":null,"s":"A","t":{B}}},{{"p":1,"s":"A","t":null}}],"type":"trade"}}'
)
FEED = [A, SECOND, C, LATE_AT_ONCE, ON_TIME, LATE, NULLS]


@pytest.fixture
def feed(folder):
    return Feed(folder("feed"))


def stats_of(spark, feed):
    """All ticks of the feed at once."""
    lines = spark.read.text(feed.path).withColumn("message_id", F.lit("m"))
    ticks = tick_ops.with_event_time(jobs.ticks_of(lines))
    return {tuple(row) for row in window_stats(ticks).where("symbol IS NOT NULL").collect()}


def run_delta(spark, feed, table, checkpoint, **options):
    query = jobs.start_stats_delta(feed.ticks(spark, **options), table, checkpoint, trigger=ONCE)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("per_batch", ["1", "3", "100"])
def test_deltas_add_up_for_any_split(spark, feed, folder, per_batch):
    feed.add(*FEED)
    table = sinks.aggregations_table(folder("deltas"), "feed")
    query = run_delta(spark, feed, table, folder("ck"), maxFilesPerTrigger=per_batch)
    assert all(not progress["stateOperators"] for progress in query.recentProgress)
    assert sum(metrics.rows_per_batch(query).values()) == 15
    feed.add(message(("A", 50, B + 100)))  # later than anything else
    run_delta(spark, feed, table, folder("ck"))
    got = {tuple(row) for row in tables.read_deltas(spark, table.path).collect()}
    assert got == stats_of(spark, feed)


def test_a_replayed_batch_replaces_its_delta(spark, feed, folder, monkeypatch):
    feed.add(A, SECOND)
    table = sinks.aggregations_table(folder("deltas"), "feed")
    write = sinks.batch_writer

    def failing(*args, **kwargs):
        inner = write(*args, **kwargs)

        def then_fail(batch, batch_id):
            inner(batch, batch_id)
            if batch_id == 1:
                raise OSError("after writing")

        return then_fail

    monkeypatch.setattr(sinks, "batch_writer", failing)
    with pytest.raises(StreamingQueryException):
        run_delta(spark, feed, table, folder("ck"))
    monkeypatch.undo()
    run_delta(spark, feed, table, folder("ck"))
    assert {tuple(row) for row in tables.read_deltas(spark, table.path).collect()} == stats_of(spark, feed)


def test_runs_of_a_replayed_feed_can_be_chosen(spark, feed, folder):
    feed.add(A)
    table = sinks.aggregations_table(folder("deltas"), "feed")
    for checkpoint in ("first", "second"):
        run_delta(spark, feed, table, folder(checkpoint))
    run = sinks.run_of(spark, folder("second"))
    assert tables.read_deltas(spark, table.path).agg(F.sum("trade_count")).first()[0] == 6
    chosen = tables.read_deltas(spark, table.path, runs=[run])
    assert {tuple(row) for row in chosen.collect()} == stats_of(spark, feed)


def run_late(spark, feed, stats, kept, checkpoint):
    query = late.start_stats_append(feed.ticks(spark), stats, kept, checkpoint, trigger=ONCE)
    query.awaitTermination()
    return query


def closed(rows):
    return {row for row in rows if row[1] <= datetime.fromtimestamp((B + 50000) / 1000)}


def test_late_ticks_are_kept_and_corrections_complete_the_stats(spark, feed, folder):
    feed.add(*FEED)
    stats = sinks.aggregations_table(folder("stats"), "feed")
    kept = sinks.late_table(folder("late"), "feed")
    query = run_late(spark, feed, stats, kept, folder("ck"))
    rows = tables.read_late(spark, kept.path).collect()
    # The last file's ticks without a symbol or price are late, too; one of them has no full key.
    assert {(row.symbol, row.price) for row in rows} == {("A", 99.0), ("A", None)} and len(rows) == 2
    # Spark counts what it drops per window and symbol, the rejected one included.
    assert sum(metrics.rows_dropped_as_late(query).values()) == 3
    watermarks = {row.watermark.timestamp() * 1000 for row in rows}
    assert all(B + 5000 <= each <= B + 50000 for each in watermarks)

    before = {tuple(row) for row in tables.read_aggregations(spark, stats.path).collect()}
    assert before != closed(stats_of(spark, feed))
    for _ in range(2):  # a second correction changes nothing
        late.correct(spark, kept.path, stats, STAMP)
        got = {tuple(row) for row in tables.read_aggregations(spark, stats.path).collect()}
        assert got == closed(stats_of(spark, feed))

    feed.add(message(("C", 3, B), ("A", 4, B + 200)))  # a window that had no row yet, and one that had
    run_late(spark, feed, stats, kept, folder("ck"))
    late.correct(spark, kept.path, stats, STAMP)
    got = {tuple(row) for row in tables.read_aggregations(spark, stats.path).collect()}
    assert got == closed(stats_of(spark, feed))


def test_a_batch_that_failed_between_its_tables_is_whole_after_a_replay(spark, feed, folder, monkeypatch):
    feed.add(*FEED)
    stats = sinks.aggregations_table(folder("stats"), "feed")
    kept = sinks.late_table(folder("late"), "feed")
    write = sinks.batch_writer

    def failing(table, *args, **kwargs):
        inner = write(table, *args, **kwargs)

        def fail_first(batch, batch_id):
            if table is kept and batch_id >= 5:
                raise OSError("before the late ticks")
            inner(batch, batch_id)

        return fail_first

    monkeypatch.setattr(sinks, "batch_writer", failing)
    with pytest.raises(StreamingQueryException):
        run_late(spark, feed, stats, kept, folder("ck"))
    monkeypatch.undo()
    run_late(spark, feed, stats, kept, folder("ck"))
    late.correct(spark, kept.path, stats, STAMP)
    got = {tuple(row) for row in tables.read_aggregations(spark, stats.path).collect()}
    assert got == closed(stats_of(spark, feed))
