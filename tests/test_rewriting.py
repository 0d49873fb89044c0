"""Stats kept by copy on write: replays, crashes and readers."""

import pytest
from pyspark.errors import StreamingQueryException

from tests.test_late import stats_of
from tests.test_streams import A, B, C, LATE_AT_ONCE, ONCE, SECOND, Feed, message
from tidemark.sources import folders
from tidemark.streaming import rewriting

DAY = 86_400_000


def run(spark, feed, path, checkpoint):
    query = rewriting.start_stats(feed.ticks(spark), path, checkpoint, trigger=ONCE)
    query.awaitTermination()


def rows(frame):
    found = [tuple(row) for row in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_batches_take_the_place_of_older_rows(spark, folder):
    feed = Feed(folder("feed")).add(A, message(("A", 8, B + DAY)), SECOND, C)
    run(spark, feed, folder("table"), folder("ck"))
    before = rewriting.read(spark, folder("table"))
    feed.add(LATE_AT_ONCE, message(("A", 9, B + DAY)))
    run(spark, feed, folder("table"), folder("ck"))
    table = rewriting.read(spark, folder("table"))
    assert rows(table) == stats_of(spark, feed)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    assert before.count() == 5  # a reader stays at its version
    assert rewriting.read(spark, folder("table"), ["2024-05-02"]).count() == 1
    assert rewriting.remove_old(spark, folder("table")) > 0
    assert rows(rewriting.read(spark, folder("table"))) == stats_of(spark, feed)


def test_a_crash_before_publishing_loses_nothing(spark, folder, monkeypatch):
    feed = Feed(folder("feed")).add(A, SECOND)
    publish = folders.publish_text

    def fail(spark, path, text):
        if path.endswith("/2"):
            raise OSError("before publishing")
        publish(spark, path, text)

    monkeypatch.setattr(folders, "publish_text", fail)
    with pytest.raises(StreamingQueryException):
        run(spark, feed, folder("table"), folder("ck"))
    assert rewriting.read(spark, folder("table")).count() == 2  # the first batch only
    monkeypatch.undo()
    run(spark, feed, folder("table"), folder("ck"))
    assert rows(rewriting.read(spark, folder("table"))) == stats_of(spark, feed)


def test_a_batch_counts_once_and_a_second_writer_fails(spark, folder):
    feed = Feed(folder("feed")).add(A)
    run(spark, feed, folder("table"), folder("ck"))
    stats = rewriting.read(spark, folder("table"))
    [name] = rewriting.current(spark, folder("table"))["batches"]
    rewriting.upsert(stats.limit(1), folder("table"), name, 0)
    assert rewriting.current(spark, folder("table"))["number"] == 1
    with pytest.raises(FileExistsError):
        folders.publish_text(spark, f"{folder('table')}/versions/1", "{}")
    assert rewriting.read(spark, folder("nothing")).count() == 0
