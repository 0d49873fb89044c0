"""A feed of growing files: positions, ranges, restarts and end offsets."""

import json
import os

import pytest

from tests.test_streams import A, B, C, ONCE, SECOND, message
from tidemark.sources import feed, tables
from tidemark.streaming import jobs, sinks


@pytest.fixture
def root(folder):
    os.makedirs(folder("feed"))
    return folder("feed")


def append(root, name, text):
    with open(f"{root}/{name}", "a", newline="") as file:
        file.write(text)


def values(rows):
    return sorted((r.file, r.position, r.value) for r in rows.collect())


LINES = ["first", "", "déjà vu", "x" * 300, "same", "same", "last"]


@pytest.mark.parametrize("range_bytes", ["1", "7", "64", "100000"])
def test_ranges_give_every_line_once(spark, root, range_bytes):
    append(root, "a.txt", "\n".join(LINES) + "\n")
    append(root, "b.txt", "windows\r\nunfinished")
    append(root, "c.txt", "")
    append(root, "_hidden", "no\n")
    rows = feed.read_feed(spark, root, rangeBytes=range_bytes)
    starts = [sum(len(line.encode()) + 1 for line in LINES[:at]) for at in range(len(LINES))]
    want = [("a.txt", start, line) for start, line in zip(starts, LINES, strict=True)]
    assert values(rows) == [*want, ("b.txt", 0, "windows")]
    assert rows.select("message_id").distinct().count() == len(want) + 1  # equal lines are two messages
    if range_bytes == "64":
        assert rows.rdd.getNumPartitions() > 4


def test_batches_between_offsets(spark, root):
    append(root, "a.txt", "one\ntwo\nthree\n")
    bounds = {"startingOffsets": json.dumps({"a.txt": 4}), "endingOffsets": json.dumps({"a.txt": 8})}
    assert values(feed.read_feed(spark, root, **bounds)) == [("a.txt", 4, "two")]
    assert values(feed.read_feed(spark, root, endingOffsets="{}")) == []


def run(spark, root, table, checkpoint, **options):
    ticks = jobs.ticks_of(feed.stream_feed(spark, root, rangeBytes="50", **options))
    query = jobs.start_raw_batches(ticks, table, checkpoint, trigger=ONCE)
    query.awaitTermination()
    return query


def prices(spark, table):
    return sorted(row.price for row in tables.read_trades(spark, table.path).collect())


def test_a_restart_goes_on_where_the_last_batch_ended(spark, root, folder):
    table = sinks.trades_table(folder("trades"), "feed")
    committed = folder("committed.json")
    append(root, "a.txt", f"{A}\n{SECOND}\n{C[:20]}")
    run(spark, root, table, folder("ck"), committed=committed)
    assert prices(spark, table) == [1.0, 10.0, 20.0, 30.0, 30.0]
    append(root, "a.txt", C[20:] + "\n")  # the line that had no end
    append(root, "b.txt", A + "\n")
    run(spark, root, table, folder("ck"), committed=committed)
    assert prices(spark, table) == [1.0, 1.0, 5.0, 10.0, 10.0, 20.0, 20.0, 30.0, 30.0]
    run(spark, root, table, folder("ck"), committed=committed)  # nothing new
    assert len(prices(spark, table)) == 9
    # What Spark has told the source it will not ask for again.
    with open(committed) as file:
        assert json.load(file)["a.txt"] >= len(f"{A}\n{SECOND}\n")


def test_equal_lines_are_trades_of_their_own_and_keep_their_ids(spark, root, folder):
    append(root, "a.txt", f"{A}\n{A}\n")
    table = sinks.trades_table(folder("trades"), "feed")
    for checkpoint in ("first", "second"):  # the feed is replayed
        run(spark, root, table, folder(checkpoint))
    assert tables.read_trades(spark, table.path).count() == 12
    assert tables.read_trades(spark, table.path, keyed=True).count() == 6


def test_a_file_that_was_cut_short_is_an_error(spark, root):
    append(root, "a.txt", "one\n")
    rows = feed.read_feed(spark, root, endingOffsets=json.dumps({"a.txt": 400}))
    with pytest.raises(Exception, match="but had 400 bytes"):
        rows.collect()


def test_ticks_are_those_of_the_text_reader(spark, root):
    append(root, "a.txt", "\n".join([A, "garbage", message(("Z", 3, B)), '{"type":"ping"}']) + "\n")
    columns = ("symbol", "price", "volume", "timestamp")
    ours = jobs.ticks_of(feed.read_feed(spark, root)).select(*columns)
    theirs = jobs.ticks_of(spark.read.text(root).withColumnRenamed("value", "value").selectExpr("value", "'m' AS message_id"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.select(*columns).collect()))
