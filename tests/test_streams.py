"""Streams over files, one file per micro-batch unless said otherwise."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import ids
from tidemark.operators import ticks as tick_ops
from tidemark.operators.windows import window_stats
from tidemark.sources import files, tables
from tidemark.streaming import jobs, metrics, sinks

B = 1714567890000
ONE_FILE = {"maxFilesPerTrigger": "1"}
ONCE = {"availableNow": True}


def message(*ticks):
    data = ",".join(f'{{"p":{p},"s":"{s}","t":{t},"v":1}}' for s, p, t in ticks)
    return f'{{"data":[{data}],"type":"trade"}}'


A = message(("A", 10, B + 100), ("A", 20, B + 200), ("B", 1, B + 100))
SECOND = message(("A", 30, B + 7000), ("A", 30, B + 300))
C = message(("A", 5, B + 30000))
LATE_AT_ONCE = message(("A", 99, B + 400), ("A", 6, B + 31000))
ON_TIME = message(("A", 6, B + 31000))
LATE = message(("A", 99, B + 400), ("A", 7, B + 32000))


class Feed:
    """A folder of message files; later files are newer."""

    def __init__(self, path):
        self.path = path
        self.count = 0
        os.makedirs(path)

    def add(self, *contents):
        for text in contents:
            self.count += 1
            path = f"{self.path}/{self.count:03d}.txt"
            with open(path, "w") as file:
                file.write(text + "\n")
            os.utime(path, (self.count, self.count))
        return self

    def ticks(self, spark, **options):
        return jobs.ticks_of(files.stream_messages(spark, self.path, **{**ONE_FILE, **options}))


@pytest.fixture
def feed(folder):
    return Feed(folder("feed"))


def emissions(spark, feed, checkpoint, mode, watermark):
    """Rows of each micro-batch as (symbol, average, count), and the finished query."""
    seen = []

    def keep(batch, batch_id):
        rows = batch.select("symbol", "avg_price", "trade_count").collect()
        seen.append(sorted(tuple(r) for r in rows))

    stats = window_stats(tick_ops.with_event_time(feed.ticks(spark)), watermark=watermark)
    query = (
        stats.writeStream.foreachBatch(keep)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    return [rows for rows in seen if rows], query


def test_update_mode_emits_running_values_of_any_age(spark, feed, folder):
    feed.add(A, SECOND, C, LATE_AT_ONCE)
    seen, query = emissions(spark, feed, folder("ck"), "update", None)
    assert seen == [
        [("A", 15.0, 2), ("B", 1.0, 1)],
        [("A", 20.0, 3), ("A", 30.0, 1)],
        [("A", 5.0, 1)],
        [("A", 5.5, 2), ("A", 39.75, 4)],
    ]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress] == [2, 3, 4, 4]


def test_append_mode_emits_closed_windows_once(spark, feed, folder):
    feed.add(A, SECOND, C, LATE_AT_ONCE)
    seen, _ = emissions(spark, feed, folder("ck"), "append", "10 seconds")
    assert seen == [[("A", 30.0, 1), ("A", 39.75, 4), ("B", 1.0, 1)]]


@pytest.mark.parametrize(
    "mode, want",
    [
        ("append", [[("A", 10.0, 1)]]),
        ("update", [[("A", 10.0, 1)], [("A", 5.0, 1)], [("A", 5.5, 2)], [("A", 6.0, 3)]]),
    ],
)
def test_late_rows_are_dropped_counted_and_stay_dropped(spark, feed, folder, mode, want):
    feed.add(message(("A", 10, B + 100)), C, ON_TIME, LATE)
    seen, query = emissions(spark, feed, folder("ck"), mode, "10 seconds")
    assert seen == want
    dropped = metrics.rows_dropped_as_late(query)
    assert sum(dropped.values()) == 1 and dropped[3] == 1
    again, _ = emissions(spark, feed, folder("ck"), mode, "10 seconds")
    assert again == []


def test_append_without_watermark_is_refused(spark, feed, folder):
    feed.add(A)
    with pytest.raises(Exception, match="watermark"):
        emissions(spark, feed, folder("ck"), "append", None)


def stats_of(spark, path, **settings):
    rows = tables.read_aggregations(spark, path, **settings).drop("window_end")
    seconds = rows.withColumn("window_start", F.unix_seconds("window_start") - B // 1000)
    return sorted(tuple(r) for r in seconds.collect())


def test_upsert_table_holds_the_newest_stats(spark, feed, folder):
    table = sinks.aggregations_table(folder("stats"), "feed")
    feed.add(A, SECOND)
    for more in ((), (C, LATE_AT_ONCE)):
        feed.add(*more)
        jobs.start_stats_upsert(
            feed.ticks(spark), table, folder("ck"), trigger=ONCE
        ).awaitTermination()
    assert stats_of(spark, table.path) == [
        (0, "A", 39.75, 4), (0, "B", 1.0, 1), (5, "A", 30.0, 1), (30, "A", 5.5, 2),
    ]


def test_append_table_and_restart(spark, feed, folder):
    table = sinks.aggregations_table(folder("stats"), "feed")
    feed.add(A, SECOND, C)
    for more in ((), (LATE_AT_ONCE,)):
        feed.add(*more)
        jobs.start_stats_append(
            feed.ticks(spark), table, folder("ck"), trigger=ONCE
        ).awaitTermination()
    want = [(0, "A", 39.75, 4), (0, "B", 1.0, 1), (5, "A", 30.0, 1)]
    first_close = stats_of(spark, table.path)
    assert len(first_close) == 3
    assert {r[:2] for r in first_close} == {w[:2] for w in want}


def test_files_per_day_bounds_the_files_of_a_batch(spark, feed, folder):
    days = range(3)
    ticks = [(s, 1, B + day * 86_400_000 + 5000 * i) for day in days for i, s in enumerate("ABCDEF")]
    feed.add(message(*ticks))
    table = sinks.aggregations_table(folder("stats"), "feed")
    jobs.start_stats_upsert(
        feed.ticks(spark), table, folder("ck"), trigger=ONCE, files_per_day=1
    ).awaitTermination()
    stored = tables.read_aggregations(spark, table.path)
    assert stored.count() == len(ticks)
    assert len(stored.inputFiles()) == len(days)


def test_a_day_is_written_by_every_task(spark, feed, folder):
    feed.add(message(*[(f"S{i}", 1, B + i) for i in range(200)]))
    table = sinks.aggregations_table(folder("stats"), "feed")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        jobs.start_stats_upsert(
            feed.ticks(spark), table, folder("ck"), trigger=ONCE, files_per_day=None
        ).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(tables.read_sums(spark, table.path).inputFiles()) == 8


def test_counts_of_all_batches_are_kept(spark, feed, folder):
    feed.add(A, SECOND, C, A, C)
    log = metrics.BatchLog(spark, folder("log"), every=2)
    spark.streams.addListener(log)
    table = sinks.trades_table(folder("trades"), "feed")
    try:
        jobs.start_raw_batches(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(log)
    log.flush()
    counts = metrics.logged_batches(spark, folder("log")).orderBy("batch_id").collect()
    assert [(row.batch_id, row.row_count, row.late_rows) for row in counts] == [
        (0, 3, 0), (1, 2, 0), (2, 1, 0), (3, 3, 0), (4, 1, 0),
    ]


def test_formats_that_cannot_replace_are_refused(folder):
    with pytest.raises(ValueError, match="replayed"):
        sinks.trades_table(folder("trades"), "feed", format="json")


def test_null_symbols_are_kept_apart_from_the_table(spark, feed, folder):
    feed.add('{"data":[{"p":1,"t":%d,"v":1},{"s":"A","p":2,"t":%d,"v":1}]}' % (B, B))
    table = sinks.aggregations_table(folder("stats"), "feed")
    jobs.start_stats_upsert(
        feed.ticks(spark), table, folder("ck"), trigger=ONCE
    ).awaitTermination()
    assert stats_of(spark, table.path) == [(0, "A", 2.0, 1)]
    [rejected] = tables.read_rejected(spark, table.path, schemas.STORED_AGGREGATIONS).collect()
    assert (rejected.symbol, rejected.price_sum, rejected.trade_count) == (None, 1.0, 1)


def test_raw_batches_and_row_counts(spark, feed, folder):
    feed.add(A, SECOND, '{"type":"ping"}', C)
    table = sinks.trades_table(folder("trades"), "feed")
    query = jobs.start_raw_batches(feed.ticks(spark), table, folder("ck"), trigger=ONCE)
    query.awaitTermination()
    counts = metrics.rows_per_batch(query)
    assert [counts[b] for b in sorted(counts)] == [3, 2, 0, 1]
    trades = tables.read_trades(spark, table.path)
    assert trades.columns == schemas.TRADES.names
    stored = metrics.stored_rows_per_batch(trades).collect()
    assert sorted(r.row_count for r in stored) == [1, 2, 3]
    assert {r.trade_timestamp for r in trades.collect()} >= {B + 100, B + 200, B + 7000}


def test_raw_batches_with_random_ids(spark, feed, folder):
    feed.add(A, SECOND)
    table = sinks.trades_table(folder("trades"), "feed")
    jobs.start_raw_batches(
        feed.ticks(spark), table, folder("ck"), row_id=ids.random_id(), trigger=ONCE
    ).awaitTermination()
    assert tables.read_trades(spark, table.path).select("id").distinct().count() == 5


def test_raw_append_keeps_null_times_apart(spark, feed, folder):
    feed.add(A, message(("A", 1, '"bad"')))
    table = sinks.trades_table(folder("trades"), "feed")
    jobs.start_raw_append(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    ids_seen = [r.id for r in tables.read_trades(spark, table.path).collect()]
    assert sorted(ids_seen) == [
        "2024-05-01 12:51:30.1", "2024-05-01 12:51:30.1", "2024-05-01 12:51:30.2",
    ]
    keyed = tables.read_trades(spark, table.path, keyed=True).orderBy("id").collect()
    assert [(r.id[-2:], r.symbol, r.price) for r in keyed] == [(".1", "B", 1.0), (".2", "A", 20.0)]
    rejected = tables.read_rejected(spark, table.path, schemas.STORED_TRADES)
    assert rejected.count() == 1


def test_a_failed_batch_is_replayed_without_loss_or_duplicates(
    spark, feed, folder, monkeypatch
):
    """The first try dies after its rows are written and before the batch is committed."""
    feed.add(A, SECOND)
    table = sinks.trades_table(folder("trades"), "feed")
    real = sinks.batch_writer

    def dies_after_writing(*args):
        write = real(*args)

        def write_and_die(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost")

        return write_and_die

    monkeypatch.setattr(sinks, "batch_writer", dies_after_writing)
    with pytest.raises(StreamingQueryException, match="lost"):
        jobs.start_raw_batches(
            feed.ticks(spark), table, folder("ck"), trigger=ONCE
        ).awaitTermination()
    before = {(r.id, r.ingestion_time) for r in tables.read_trades(spark, table.path).collect()}
    assert len(before) == 3

    monkeypatch.setattr(sinks, "batch_writer", real)
    jobs.start_raw_batches(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    after = [(r.id, r.ingestion_time) for r in tables.read_trades(spark, table.path).collect()]
    assert len(after) == 5
    assert before <= set(after)


def test_both_jobs_stop_when_one_fails(spark, feed, folder):
    feed.add(A)
    ticks = feed.ticks(spark)
    stats = jobs.start_stats_upsert(
        ticks, sinks.aggregations_table(folder("stats"), "feed"), folder("ck1"),
        trigger={"processingTime": "1 second"},
    )
    stats.processAllAvailable()

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    raw = ticks.writeStream.foreachBatch(fail).option("checkpointLocation", folder("ck2")).start()
    with pytest.raises(StreamingQueryException, match="sink is down"):
        jobs.run_until_any_ends(stats, raw)
    assert not stats.isActive and not raw.isActive


def test_connector_formats_get_plain_rows(spark, feed, folder):
    """Anything that is not a file format is written as is; noop stands for a connector."""
    feed.add(A)
    store = sinks.trades_table(None, "feed", format="noop", options={"table": "trades"})
    query = jobs.start_raw_batches(feed.ticks(spark), store, folder("ck1"), trigger=ONCE)
    query.awaitTermination()
    assert sum(metrics.rows_per_batch(query).values()) == 3
    query = jobs.start_raw_append(feed.ticks(spark), store, folder("ck2"), trigger=ONCE)
    query.awaitTermination()
    assert sum(metrics.rows_per_batch(query).values()) == 3
    store = sinks.aggregations_table(None, "feed", format="noop")
    jobs.start_stats_append(feed.ticks(spark), store, folder("ck3"), trigger=ONCE).awaitTermination()
