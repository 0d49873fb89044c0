"""Streams cut into any files give what one batch over all rows gives."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import ticks as tick_ops
from tidemark.operators.windows import window_stats
from tidemark.sources import files, tables
from tidemark.streaming import jobs, sinks

RELAXED = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

tick = st.tuples(
    st.sampled_from(["A", "A", "A", "B", "C"]),
    st.one_of(st.none(), st.integers(0, 400).map(lambda n: n / 4)),
    st.one_of(st.none(), st.integers(0, 60_000)),
)
feeds = st.lists(st.lists(st.lists(tick, max_size=4), min_size=1, max_size=6), min_size=1, max_size=4)


def text(message):
    def number(value):
        return "null" if value is None else str(value)

    trades = ",".join(f'{{"p":{number(p)},"s":"{s}","t":{number(t)},"v":1}}' for s, p, t in message)
    return f'{{"data":[{trades}],"type":"trade"}}'


def write_feed(feed):
    folder = tempfile.mkdtemp(prefix="tidemark-feed-")
    for i, messages in enumerate(feed):
        path = f"{folder}/{i}.txt"
        with open(path, "w") as file:
            file.write("\n".join(map(text, messages)) + "\n")
        os.utime(path, (i + 1, i + 1))
    return folder


@RELAXED
@given(feeds)
def test_running_upserts_fold_to_the_batch_result(spark, feed):
    folder, out = write_feed(feed), tempfile.mkdtemp(prefix="tidemark-out-")
    table = sinks.aggregations_table(f"{out}/stats", "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, folder, maxFilesPerTrigger="1"))
    jobs.start_stats_upsert(
        ticks, table, f"{out}/ck", trigger={"availableNow": True}
    ).awaitTermination()

    batch_ticks = tick_ops.with_event_time(jobs.ticks_of(files.read_messages(spark, folder)))
    batch = window_stats(batch_ticks)
    timed = [t for messages in feed for m in messages for (_, _, t) in m if t is not None]
    assert (batch.agg(F.sum("trade_count")).first()[0] or 0) == len(timed)
    if timed:
        stored = tables.read_aggregations(spark, table.path)
        assert stored.exceptAll(batch).count() == 0
        assert batch.exceptAll(stored).count() == 0


@RELAXED
@given(feeds)
def test_every_tick_is_stored_once(spark, feed):
    folder, out = write_feed(feed), tempfile.mkdtemp(prefix="tidemark-out-")
    table = sinks.trades_table(f"{out}/trades", "feed")
    ticks = jobs.ticks_of(files.stream_messages(spark, folder, maxFilesPerTrigger="1"))
    jobs.start_raw_batches(
        ticks, table, f"{out}/ck", trigger={"availableNow": True}
    ).awaitTermination()
    want = sorted(
        (s, repr(p), repr(t)) for messages in feed for m in messages for (s, p, t) in m
    )
    if want:
        rows = tables.read_trades(spark, table.path).collect()
        got = sorted((r.symbol, repr(r.price), repr(r.trade_timestamp)) for r in rows)
        assert got == want
