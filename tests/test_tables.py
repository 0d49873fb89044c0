"""Table creation, pruned scans and the whole way from messages to dashboard figures."""

import os
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators.ticks import with_event_time
from tidemark.operators.windows import window_stats
from tidemark.plans import dashboard
from tidemark.sources import compaction, files, kafka, tables
from tidemark.streaming import jobs, sinks

ONCE = {"availableNow": True}
B = 1714567890000


def lines(folder, name, texts):
    path = folder(name)
    with open(path, "w") as file:
        file.write("\n".join(texts) + "\n")
    return path


@pytest.fixture
def feed(folder):
    os.makedirs(folder("feed"))
    trade = '{"p":%s,"s":"%s","t":%d,"v":%s}'
    texts = [
        '{"data":[%s],"type":"trade"}'
        % ",".join(trade % (10 + i % 7, "AB"[i % 3 % 2], B + i * 700 + j, 1 + j) for j in range(3))
        for i in range(40)
    ]
    lines(folder, "feed/a.txt", texts[:25] + ['{"type":"ping"}', "garbage"])
    lines(folder, "feed/b.txt", texts[25:])
    return folder("feed")


def test_from_messages_to_dashboard(spark, feed, folder):
    trades = sinks.trades_table(folder("trades"), "feed")
    stats = sinks.aggregations_table(folder("stats"), "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, feed, maxFilesPerTrigger="1"))
    jobs.start_raw_batches(ticks, trades, folder("ck1"), trigger=ONCE).awaitTermination()
    jobs.start_stats_upsert(ticks, stats, folder("ck2"), trigger=ONCE).awaitTermination()

    now = datetime.fromtimestamp(B / 1000 + 60, timezone.utc)
    stored = tables.read_aggregations(spark, stats.path, since=now - timedelta(minutes=5), until=now)
    counts = dashboard.trade_count_by_symbol(stored, now, 5).collect()
    batch = jobs.ticks_of(files.read_messages(spark, feed))
    assert {r.symbol: r.total_trades for r in counts} == {
        r.symbol: r["count"] for r in batch.groupBy("symbol").count().collect()
    }

    clock_now = datetime.now(timezone.utc) + timedelta(minutes=1)
    rows = tables.read_trades(spark, trades.path, since=clock_now - timedelta(minutes=5))
    latest = {r.symbol: r.latest_price for r in dashboard.latest_price(rows, clock_now, 5).collect()}
    want = batch.groupBy("symbol").agg(F.max_by("price", F.struct("timestamp", "price")).alias("p"))
    assert latest == {r.symbol: r.p for r in want.collect()}
    trend = dashboard.trade_count_trend(rows, clock_now, 5).collect()
    assert sum(r.trade_count for r in trend) == 120
    assert len({r.time for r in trend}) == 2
    volumes = dashboard.volume_trend(rows, clock_now, 5).collect()
    assert sum(r.total_volume for r in volumes) == 40 * 6


def test_batch_and_stream_give_the_same_stable_ids(spark, feed, folder):
    trades = sinks.trades_table(folder("trades"), "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, feed))
    jobs.start_raw_batches(ticks, trades, folder("ck"), trigger=ONCE).awaitTermination()
    stored = tables.read_trades(spark, trades.path).select("id")
    batch = jobs.ticks_of(files.read_messages(spark, feed)).select(jobs.tick_id().alias("id"))
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0
    assert stored.distinct().count() == 120


def test_backfill_and_the_stream_after_it(spark, feed, folder):
    trades = sinks.trades_table(folder("trades"), "history")
    stats = sinks.aggregations_table(folder("stats"), "history")
    batch = jobs.ticks_of(files.read_messages(spark, feed))
    for _ in range(2):
        jobs.backfill(batch, trades, stats, stamp=datetime(2024, 5, 2))
    stored = tables.read_trades(spark, trades.path)
    assert stored.count() == 120
    assert stored.where("ingestion_time = timestamp'2024-05-02 00:00:00'").count() == 120
    want = window_stats(with_event_time(batch))
    stored = tables.read_aggregations(spark, stats.path)
    assert stored.exceptAll(want).count() == want.exceptAll(stored).count() == 0
    before = stored.orderBy("window_start", "symbol").first()

    lines(folder, "feed/c.txt", ['{"data":[{"p":1,"s":"A","t":%d,"v":1}]}' % B])
    ticks = jobs.ticks_of(files.stream_messages(spark, folder("feed") + "/c.txt*"))
    live = sinks.aggregations_table(folder("stats"), "live")
    jobs.start_stats_upsert(ticks, live, folder("ck"), trigger=ONCE).awaitTermination()
    first = tables.read_aggregations(spark, stats.path).orderBy("window_start", "symbol").first()
    assert first.trade_count == before.trade_count + 1
    total = before.avg_price * before.trade_count + 1.0
    assert first.avg_price == pytest.approx(total / first.trade_count)
    assert tables.read_aggregations(spark, stats.path).count() == want.count()


def test_two_backfills_of_one_day_both_count(spark, folder):
    for source, price in (("a", 2.0), ("b", 4.0)):
        ticks = spark.createDataFrame(
            [(source, 0, "A", price, 1.0, B)],
            "message_id string, position int, symbol string, price double, volume double, timestamp long",
        )
        trades = sinks.trades_table(folder("trades"), source)
        stats = sinks.aggregations_table(folder("stats"), source)
        jobs.backfill(ticks, trades, stats, stamp=datetime(2024, 5, 2))
    assert tables.read_trades(spark, folder("trades")).count() == 2
    [row] = tables.read_aggregations(spark, folder("stats")).collect()
    assert (row.avg_price, row.trade_count) == (3.0, 2)


def test_two_feeds_in_one_table(spark, feed, folder):
    for source in ("a", "b"):
        table = sinks.trades_table(folder("trades"), source)
        ticks = jobs.ticks_of(files.stream_messages(spark, feed))
        jobs.start_raw_batches(ticks, table, folder(f"ck-{source}"), trigger=ONCE).awaitTermination()
    assert tables.read_trades(spark, folder("trades")).count() == 240


def test_a_new_checkpoint_replaces_what_the_old_one_wrote(spark, feed, folder):
    table = sinks.aggregations_table(folder("stats"), "feed")
    want = window_stats(with_event_time(jobs.ticks_of(files.read_messages(spark, feed))))
    for run in range(2):
        ticks = jobs.ticks_of(files.stream_messages(spark, feed, maxFilesPerTrigger="1"))
        jobs.start_stats_upsert(ticks, table, folder(f"ck{run}"), trigger=ONCE).awaitTermination()
        stored = tables.read_aggregations(spark, table.path)
        assert stored.exceptAll(want).count() == want.exceptAll(stored).count() == 0


def test_compaction(spark, feed, folder):
    table = sinks.aggregations_table(folder("stats"), "feed")
    for run in range(2):
        ticks = jobs.ticks_of(files.stream_messages(spark, feed, maxFilesPerTrigger="1"))
        jobs.start_stats_upsert(ticks, table, folder(f"ck{run}"), trigger=ONCE).awaitTermination()
    want = sorted(map(tuple, tables.read_aggregations(spark, table.path).collect()), key=str)
    files_before = len(tables.read_sums(spark, table.path).inputFiles())
    assert compaction.compact_aggregations(spark, table.path, datetime(2024, 5, 1)) == []
    later = datetime(2030, 1, 1)
    compaction.compact_aggregations(spark, table.path, later)
    assert len(tables.read_sums(spark, table.path).inputFiles()) == 1 < files_before
    assert sorted(map(tuple, tables.read_aggregations(spark, table.path).collect()), key=str) == want
    assert compaction.compact_aggregations(spark, table.path, later) == []


def test_missing_tables_and_periods(spark, feed, folder):
    now = datetime.now(timezone.utc)
    for hours in (10, 2000):
        with pytest.raises(FileNotFoundError):
            tables.read_trades(spark, folder("nowhere"), now - timedelta(hours=hours), now)
    table = sinks.trades_table(folder("trades"), "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, feed))
    jobs.start_raw_append(ticks, table, folder("ck"), trigger=ONCE).awaitTermination()
    later = now + timedelta(hours=1)
    counts = [tables.read_trades(spark, table.path, now - timedelta(hours=h), later).count() for h in (10, 2000)]
    assert counts == [120, 120]


def test_keyed_reads_show_the_table_as_it_was(spark, folder):
    start = datetime(2024, 5, 1, 10, 15, tzinfo=timezone.utc)
    schema = "id string, symbol string, price double, volume double, trade_timestamp long, ingestion_time timestamp"
    for batch, (minutes, price) in enumerate(((0, 1.0), (30, 2.0), (90, 3.0))):
        row = ("x", "A", price, 1.0, B, start + timedelta(minutes=minutes))
        write = sinks.batch_writer(sinks.trades_table(folder("trades"), "feed"), "run")
        write(spark.createDataFrame([row], schema), batch)
    for minutes, price in ((10, 1.0), (45, 2.0), (80, 2.0), (100, 3.0)):
        until = start + timedelta(minutes=minutes)
        [row] = tables.read_trades(spark, folder("trades"), until=until, keyed=True).collect()
        assert row.price == price


def test_creating_tables_twice_and_reading_them_with_sql(spark, feed, folder):
    namespace = f"market_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        tables.create_tables(spark, namespace, folder("db"))
    for name, columns in (
        ("trades", schemas.TRADES), ("trade_aggregations", schemas.TRADE_AGGREGATIONS)
    ):
        empty = spark.table(f"{namespace}.{name}")
        assert not dashboard.has_rows(empty)
        assert [(c.name, c.dataType) for c in empty.schema][:-1] == [
            (c.name, c.dataType) for c in columns
        ]

    lines(folder, "feed/c.txt", ['{"data":[{"p":1,"t":%d,"v":1}]}' % B])  # no symbol
    os.utime(folder("feed/c.txt"), (1, 1))
    ticks = jobs.ticks_of(files.stream_messages(spark, feed, maxFilesPerTrigger="1"))
    trades = sinks.trades_table(folder("db") + "/trades", "feed")
    stats = sinks.aggregations_table(folder("db") + "/trade_aggregations", "feed")
    jobs.start_raw_batches(ticks, trades, folder("ck1"), trigger=ONCE).awaitTermination()
    jobs.start_stats_upsert(ticks, stats, folder("ck2"), trigger=ONCE).awaitTermination()
    tables.refresh_tables(spark, namespace)
    assert spark.sql(f"SELECT count(*) FROM {namespace}.trades").first()[0] == 121
    shown = spark.sql(f"SELECT * FROM {namespace}.trade_aggregations")
    pruned = shown.where("window_day > '2024-01-01'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "window_day" in plan[plan.index("PartitionFilters") :].split("]")[0]
    shown = shown.drop("window_day")
    read = tables.read_aggregations(spark, stats.path)
    assert shown.exceptAll(read).count() == read.exceptAll(shown).count() == 0
    assert shown.agg(F.sum("trade_count")).first()[0] == 120
    assert spark.sql(f"SELECT * FROM {namespace}.trade_aggregations LIMIT 10").count() == 10
    spark.sql(f"DROP SCHEMA {namespace} CASCADE")


@pytest.fixture
def stored_trades(spark, feed, folder):
    trades = sinks.trades_table(folder("trades"), "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, feed))
    jobs.start_raw_batches(ticks, trades, folder("ck"), trigger=ONCE).awaitTermination()
    return trades.path


def test_look_backs_read_only_their_folders(spark, stored_trades):
    now = datetime.now(timezone.utc)
    recent = tables.read_trades(spark, stored_trades, since=now - timedelta(hours=2))
    around = tables.read_trades(spark, stored_trades, now - timedelta(hours=2), now + timedelta(hours=1))
    assert recent.count() == around.count() == 120
    assert tables.read_trades(spark, stored_trades, until=now - timedelta(days=2)).count() == 0
    writer = "source=feed/run_id=old/batch_id=0"
    elsewhere = f"{stored_trades}/rejected=false/ingestion_hour=2000-01-01-00/{writer}"
    recent.limit(1).coalesce(1).write.parquet(elsewhere)
    reads = [tables.read_trades(spark, stored_trades, since=s) for s in (now - timedelta(hours=2), None)]
    assert [any("2000-01-01-00" in file for file in r.inputFiles()) for r in reads] == [False, True]
    before = now - timedelta(days=30), now - timedelta(days=29)
    nothing = tables.read_trades(spark, stored_trades, *before)
    assert nothing.count() == 0
    assert nothing.schema == recent.schema


def test_peek_is_ordered(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 7)
    assert [tuple(r) for r in tables.peek(rows, "k", "id", rows=3).collect()] == [
        (0, 0), (7, 0), (14, 0),
    ]


def test_topic_options():
    assert kafka.source_options("host:9092", "ticks") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ticks",
        "startingOffsets": "earliest",
    }
    tuned = kafka.source_options(
        "h", "t", "latest", group_id="g", min_partitions=64, max_offsets_per_trigger=10**6
    )
    assert tuned["kafka.group.id"] == "g"
    assert tuned["startingOffsets"] == "latest"
    assert tuned["minPartitions"] == "64"
    assert tuned["maxOffsetsPerTrigger"] == "1000000"
    assert kafka.sink_options("h", "t") == {"kafka.bootstrap.servers": "h", "topic": "t"}


def test_topic_records_parse_like_file_lines(spark):
    records = spark.createDataFrame(
        [(None, b'{"data":[{"p":1,"s":"A","t":1,"v":1}]}', "ticks", 3, 42)],
        "key binary, value binary, topic string, partition int, offset bigint",
    )
    [tick] = jobs.ticks_of(kafka.with_message_id(records)).collect()
    assert (tick.message_id, tick.position, tick.symbol) == ("ticks:3:42", 0, "A")
