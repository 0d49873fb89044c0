"""The sink that publishes a batch once: failing tasks, failing batches, replays, keys."""

import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.test_late import stats_of
from tests.test_streams import A, B, C, LATE_AT_ONCE, ONCE, SECOND, Feed, message
from tidemark import schemas
from tidemark.sources import published
from tidemark.streaming import jobs, sinks

ROWS = "id long, at timestamp"


@pytest.fixture
def feed(folder):
    return Feed(folder("feed"))


def numbers(spark, n, parts=4):
    return spark.range(0, n, 1, parts).select("id", F.timestamp_seconds("id").alias("at"))


def save(rows, path, **options):
    rows.write.format(published.register(rows.sparkSession)).options(**options).mode("append").save(path)


def ids(rows):
    return sorted(row.id for row in rows.collect())


def schema_of(text):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def test_batches_and_their_bounds(spark, folder):
    path, schema = folder("table"), schema_of(ROWS)
    assert published.read(spark, path, schema).count() == 0
    save(numbers(spark, 100), path, time="at")
    save(numbers(spark, 100), path, time="at")  # two batches of their own
    save(numbers(spark, 0), path, time="at")
    assert ids(published.read(spark, path, schema)) == sorted([*range(100)] * 2)
    part = published.read(spark, path, schema, since=datetime(1970, 1, 1, 0, 0, 30), until=datetime(1970, 1, 1, 0, 0, 40))
    assert ids(part) == sorted([*range(25, 50)] * 2)  # one file in four
    assert len(os.listdir(f"{path}/staged")) == 0


def test_a_batch_of_one_name_counts_once(spark, folder):
    path = folder("table")
    for _ in range(2):
        save(numbers(spark, 10), path, run="r", batch="3")
    save(numbers(spark, 10), path, run="r", batch="4")
    assert ids(published.read(spark, path, schema_of(ROWS))) == sorted([*range(10)] * 2)
    assert len(os.listdir(f"{path}/data")) == 8 and os.listdir(f"{path}/staged") == []


def test_a_failing_task_leaves_nothing_that_is_seen(spark, folder):
    path = folder("table")
    bad = numbers(spark, 100).withColumn("id", F.expr("if(id = 99, raise_error('down'), id)"))
    with pytest.raises(Exception, match="down"):
        save(bad, path)
    assert published.read(spark, path, schema_of(ROWS)).count() == 0
    published.remove_unseen(spark, path, -10)
    assert os.listdir(f"{path}/staged") == []
    save(numbers(spark, 5), path)
    assert published.remove_unseen(spark, path, -10) == 0
    assert ids(published.read(spark, path, schema_of(ROWS))) == [*range(5)]


def trades(path, spark):
    return sinks.trades_table(path, "feed", format=published.register(spark))


def run_raw(spark, feed, path, checkpoint):
    jobs.start_raw_append(feed.ticks(spark), trades(path, spark), checkpoint, trigger=ONCE).awaitTermination()


@pytest.mark.parametrize("published_before", [False, True])
def test_a_stream_that_dies_is_replayed_once(spark, feed, folder, published_before):
    """The last batch is written again, with its rows published before or not."""
    path = folder("table")
    feed.add(A, SECOND, C)
    run_raw(spark, feed, path, folder("ck"))
    [run] = os.listdir(f"{path}/published")
    os.unlink(f"{folder('ck')}/commits/2")  # Spark has not heard of its end
    if os.path.exists(f"{folder('ck')}/commits/.2.crc"):
        os.unlink(f"{folder('ck')}/commits/.2.crc")
    if not published_before:
        os.unlink(f"{path}/published/{run}/{2:012d}.json")
    run_raw(spark, feed, path, folder("ck"))
    assert published.read(spark, path, schemas.TRADES).count() == 6
    assert published.remove_unseen(spark, path, -10) == (0 if published_before else 1)
    assert published.read(spark, path, schemas.TRADES).count() == 6


def test_a_batch_that_cannot_be_published_is_written_again(spark, feed, folder):
    path = folder("table")
    feed.add(A, SECOND)
    os.makedirs(path)
    with open(f"{path}/published", "w"):
        pass  # no folder can be made here
    with pytest.raises(StreamingQueryException):
        run_raw(spark, feed, path, folder("ck"))
    os.unlink(f"{path}/published")
    assert published.read(spark, path, schemas.TRADES).count() == 0
    run_raw(spark, feed, path, folder("ck"))
    assert published.read(spark, path, schemas.TRADES).count() == 5


@pytest.mark.parametrize("start", [jobs.start_stats_upsert, jobs.start_stats_append])
def test_stats_by_key(spark, feed, folder, start):
    table = sinks.aggregations_table(folder("table"), "feed", format=published.register(spark))
    feed.add(A, SECOND, C)
    for more in ((), (LATE_AT_ONCE, message(("B", 4, B + 100)))):
        feed.add(*more)
        start(feed.ticks(spark), table, folder("ck"), trigger=ONCE).awaitTermination()
    found = published.read(spark, table.path, schemas.TRADE_AGGREGATIONS, keys=schemas.TRADE_AGGREGATIONS_KEY)
    rows = [tuple(row) for row in found.collect()]
    assert len(rows) == len(set(rows)) > 0
    if start is jobs.start_stats_upsert:
        assert set(rows) == stats_of(spark, feed)
    else:
        assert set(rows) < stats_of(spark, feed) | set(rows)


def test_foreach_batches_replace_themselves(spark, feed, folder):
    """A job by micro-batches hands run and batch to the sink."""
    path = folder("table")
    feed.add(A, SECOND)
    for _ in range(2):
        jobs.start_raw_batches(feed.ticks(spark), trades(path, spark), folder("ck"), trigger=ONCE).awaitTermination()
    write = sinks.batch_writer(trades(path, spark), os.listdir(f"{path}/published")[0])
    write(published.read(spark, path, schemas.TRADES), 0)
    assert published.read(spark, path, schemas.TRADES).count() == 5


def test_streams_of_two_checkpoints_stand_side_by_side(spark, feed, folder):
    feed.add(A)
    for run in range(2):
        run_raw(spark, feed, folder("table"), folder(f"ck{run}"))
    assert published.read(spark, folder("table"), schemas.TRADES).count() == 6
    keyed = published.read(spark, folder("table"), schemas.TRADES, keys=schemas.TRADES_KEY)
    assert keyed.count() == 2  # ids by millisecond
