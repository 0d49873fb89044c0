"""All queries by name, each over one of the test tables in full.

Look-back queries take a fixed query time; their bounds fall on batch stamps, so open and
closed ends differ. Times are returned without a zone, as the tables hold them. Averages are
rounded because the order in which doubles are added up is free.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import envelopes, gaps, rollups, ticks as tick_ops
from tidemark.operators.upserts import latest_version
from tidemark.operators.windows import WINDOW_SIZE
from tidemark.plans import dashboard
from tidemark.session import pin_utc, scratch_dir
from tidemark.sources import buckets, compaction, feed, files, published, samples, tables
from tidemark.streaming import jobs, late, metrics, rewriting, sinks, state

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 1, 30, 12)
LOOKBACK_MINUTES = 28 * 24 * 60
SINCE = NOW - timedelta(minutes=LOOKBACK_MINUTES)
ALLOWED_SYMBOLS = ("purchase", "view")
NO_SYMBOL = "error"
ONCE = {"availableNow": True}
FEED = "feed"

_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(run: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(pin_utc(spark), sf_dir)

    _QUERIES[run.__name__] = in_utc
    return run


# Windows


@_query
def tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(samples.event_stats(spark, sf_dir, WINDOW_SIZE))


@_query
def tumbling_stats_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(samples.event_stats(spark, sf_dir, "1 hour"))


# Messages


@_query
def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.parse_envelopes(_event_messages(spark, sf_dir))


@_query
def envelope_parse_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two ticks: each line item at its list price and at its discounted price."""
    rows = samples.lineitem(spark, sf_dir)
    at = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    pair = [
        envelopes.tick_struct(F.col("l_returnflag"), F.col("l_extendedprice"), F.col("l_quantity"), at),
        envelopes.tick_struct(F.col("l_linestatus"), F.col("l_discount"), F.col("l_quantity"), at),
    ]
    messages = envelopes.encode_envelopes(rows, pair, keep=["l_orderkey"])
    return envelopes.parse_envelopes(messages, keep=["l_orderkey"], with_position=True)


@_query
def envelope_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in which the messages of one event type are heartbeats without trades."""
    messages = _event_messages(spark, sf_dir, keep=["event_id", "symbol"])
    quiet = F.col("symbol") == NO_SYMBOL
    feed = messages.withColumn(
        "value", F.when(quiet, F.lit('{"type":"ping"}')).otherwise(F.col("value"))
    )
    return envelopes.parse_envelopes(feed.drop("symbol"), keep=["event_id"])


@_query
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _event_messages(spark, sf_dir)
    read_back = messages.select(
        "event_id", F.from_json("value", schemas.ENVELOPE).alias("message")
    )
    return read_back.select(
        "event_id",
        F.size("message.data").alias("tick_count"),
        F.col("message.data")[0]["s"].alias("first_symbol"),
        F.col("message.type").alias("message_type"),
    )


@_query
def symbol_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = envelopes.parse_envelopes(_event_messages(spark, sf_dir))
    return envelopes.allow_symbols(ticks, ALLOWED_SYMBOLS)


# Tick rows


@_query
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = samples.event_ticks(samples.events(spark, sf_dir))
    return _zoneless(
        tick_ops.with_event_time(ticks).select(F.col("message_id").alias("event_id"), "event_time")
    )


@_query
def trade_timestamp_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = tick_ops.with_event_time(samples.event_ticks(samples.events(spark, sf_dir)))
    return ticks.select(
        F.col("message_id").alias("event_id"),
        clock.whole_second_millis(F.col("event_time")).alias("trade_timestamp"),
        clock.exact_millis(F.col("event_time")).alias("exact_timestamp"),
    )


@_query
def stable_trade_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = samples.event_ticks(samples.events(spark, sf_dir))
    return ticks.select(F.col("message_id").alias("event_id"), jobs.tick_id().alias("id"))


@_query
def trades_by_event_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_ops.last_per_event_time(samples.lineitem_ticks(samples.lineitem(spark, sf_dir)))


@_query
def quarantine_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades whose symbol is a key, one of the symbols being unknown."""
    ticks = samples.event_ticks(samples.events(spark, sf_dir)).withColumn(
        "symbol", F.nullif("symbol", F.lit(NO_SYMBOL))
    )
    valid = tick_ops.keys_present(["symbol", "timestamp"])
    return ticks.groupBy(valid.alias("valid")).agg(F.count("*").alias("row_count"))


@_query
def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(metrics.stored_rows_per_batch(samples.event_trades(spark, sf_dir)))


# Keyed tables


@_query
def upsert_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily stats that grow with each line number, line numbers standing for micro-batches."""
    rows = samples.lineitem(spark, sf_dir)
    day = F.window(F.col("l_shipdate").cast("timestamp"), "1 day").alias("day")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    per_batch = (
        rows.groupBy(day, F.col("l_returnflag").alias("symbol"), "l_linenumber")
        .agg(F.sum(price).alias("total"), F.count("*").alias("n"))
        .select("day.start", "day.end", "symbol", "l_linenumber", "total", "n")
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
    )
    # Partitioned by the table's key, so that finding the newest version needs no shuffle.
    so_far = (
        Window.partitionBy("window_start", "symbol")
        .orderBy("l_linenumber")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total, n = F.sum("total").over(so_far), F.sum("n").over(so_far)
    log = per_batch.select(
        "window_start",
        "window_end",
        "symbol",
        (total.cast("double") / n).alias("avg_price"),
        n.alias("trade_count"),
        F.col("l_linenumber").cast("bigint").alias(schemas.BATCH_ID),
    )
    return _comparable(latest_version(log, schemas.TRADE_AGGREGATIONS_KEY, schemas.BATCH_ID))


# Streams


@_query
def raw_trades_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    _finish(jobs.start_raw_batches(_tick_stream(spark, sf_dir), table, **_run(spark)))
    return tables.read_trades(spark, table.path).drop("ingestion_time")


@_query
def raw_trades_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    _finish(jobs.start_raw_append(_tick_stream(spark, sf_dir), table, **_run(spark)))
    return tables.read_trades(spark, table.path).drop("ingestion_time")


@_query
def window_stats_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sinks.aggregations_table(scratch_dir(spark, "trade_aggregations"), FEED)
    _finish(jobs.start_stats_append(_tick_stream(spark, sf_dir), table, **_run(spark)))
    return _comparable(tables.read_aggregations(spark, table.path))


@_query
def window_stats_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sinks.aggregations_table(scratch_dir(spark, "trade_aggregations"), FEED)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, **_run(spark)))
    return _comparable(tables.read_aggregations(spark, table.path))


@_query
def window_stats_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats of a feed whose files come out of order, from the sums of each batch."""
    table = sinks.aggregations_table(scratch_dir(spark, "deltas"), FEED)
    _feed_in_parts(
        spark, sf_dir, lambda ticks, run: jobs.start_stats_delta(ticks, table, **run)
    )
    return _comparable(tables.read_deltas(spark, table.path))


@_query
def late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final stats of the same feed, most of whose trades come late, after their correction."""
    root = scratch_dir(spark, "late")
    stats = sinks.aggregations_table(f"{root}/stats", FEED)
    kept = sinks.late_table(f"{root}/late", FEED)
    _feed_in_parts(
        spark, sf_dir, lambda ticks, run: late.start_stats_append(ticks, stats, kept, **run)
    )
    late.correct(spark, kept.path, stats, datetime(2024, 1, 1))
    return _comparable(tables.read_aggregations(spark, stats.path))


@_query
def feed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades of a live feed: files of messages, read in ranges of bytes by a stream."""
    root = scratch_dir(spark, "messages")
    _event_messages(spark, sf_dir, keep=()).write.text(root)
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    messages = feed.stream_feed(spark, root, rangeBytes=str(1 << 20))
    _finish(jobs.start_raw_batches(jobs.ticks_of(messages), table, **_run(spark)))
    return tables.read_trades(spark, table.path).drop("id", "ingestion_time")


@_query
def state_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running stats as they stand in the state of their stream."""
    table, run = sinks.aggregations_table(scratch_dir(spark, "trade_aggregations"), FEED), _run(spark)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, **run))
    windows = state.read_windows(spark, run["checkpoint"]).where("symbol IS NOT NULL")
    average = F.try_divide("price_sum", "price_count")
    return _comparable(windows.select("window_start", "window_end", "symbol", average.alias("avg_price"), "trade_count"))


@_query
def state_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final stats of a feed whose job goes on in another one with other shuffle partitions."""
    root = scratch_dir(spark, "messages")
    stats = scratch_dir(spark, "trade_aggregations")
    offsets, partitions = "{}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    for job in range(2):
        messages = _event_messages(spark, sf_dir).where(F.col("event_id") % 2 == job).select("value")
        messages.write.mode("append").text(root)
        table, run = sinks.aggregations_table(stats, f"{FEED}.{job}"), _run(spark)
        ticks = jobs.ticks_of(feed.stream_feed(spark, root, startingOffsets=offsets))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions + job))
        try:
            _finish(jobs.start_stats_append(ticks, table, **run))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        offsets = state.hand_over(spark, run["checkpoint"], table, datetime(2024, 1, 1))
    return _comparable(tables.read_aggregations(spark, stats))


@_query
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps, repeats and overlaps of stored events, some of which are lost, doubled or replayed.

    An event's number is its place in one of four partitions of a topic.
    """
    events = samples.events(spark, sf_dir).select(
        F.format_string("trades:%d", F.col("event_id") % 4).alias("stream"),
        F.floor(F.col("event_id") / 4).alias("offset"),
    )
    lost = (F.col("offset") % 101 < 3) | F.col("offset").between(1000, 1200)
    rows = F.when(F.col("offset") % 50 < 2, 2).when(F.col("offset") % 211 == 5, 3).otherwise(1)
    first = events.where(~lost).select("stream", "offset", F.explode(F.array_repeat(F.lit("first"), rows)).alias("writer"))
    again = events.where(F.col("offset").between(300, 450)).withColumn("writer", F.lit("second"))
    expected = events.groupBy("stream").agg(F.lit(0).cast("long").alias("first"), F.max("offset").alias("last"))
    return gaps.audit(first.unionByName(again), expected)


@_query
def rewritten_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running stats in a table whose days are rewritten with each batch that touches them."""
    path = scratch_dir(spark, "rewritten")
    _feed_in_parts(
        spark, sf_dir, lambda ticks, run: rewriting.start_stats(ticks, path, size="1 hour", **run)
    )
    return _comparable(rewriting.read(spark, path))


@_query
def published_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades in a table whose sink publishes each batch of a stream once."""
    table = sinks.trades_table(scratch_dir(spark, "published"), FEED, format=published.register(spark))
    _finish(jobs.start_raw_append(_tick_stream(spark, sf_dir), table, **_run(spark)))
    return published.read(spark, table.path, schemas.TRADES).drop("ingestion_time")


@_query
def published_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running stats of a feed that comes in parts, the row published last counting for its key."""
    table = sinks.aggregations_table(scratch_dir(spark, "published"), FEED, format=published.register(spark))
    _feed_in_parts(
        spark, sf_dir, lambda ticks, run: jobs.start_stats_upsert(ticks, table, size="1 hour", **run)
    )
    stats = published.read(spark, table.path, schemas.TRADE_AGGREGATIONS, keys=schemas.TRADE_AGGREGATIONS_KEY)
    return _comparable(stats)


@_query
def raw_trades_v2_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under their event time, of which a keyed read leaves one per millisecond.

    All are one batch here, so the greatest row stays.
    """
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    source = files.stream_parquet(spark, f"{sf_dir}/lineitem.parquet", spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema)
    ticks = samples.lineitem_ticks(source)
    _finish(jobs.start_raw_append(ticks, table, **_run(spark)))
    trades = tables.read_trades(spark, table.path, keyed=True)
    return trades.select("id", "symbol", "price", "volume")


@_query
def trades_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade counts from a stored table, read with bounds around the time of writing."""
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    start = datetime.now(timezone.utc)
    _finish(jobs.start_raw_append(_tick_stream(spark, sf_dir), table, **_run(spark)))
    hour = timedelta(hours=1)
    trades = tables.read_trades(spark, table.path, start - hour, datetime.now(timezone.utc) + hour)
    return trades.groupBy("symbol").agg(F.count("*").alias("total_trades"))


@_query
def aggregations_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the look-back, from hourly stats that a stream has stored."""
    return dashboard.trade_count_by_symbol(
        tables.read_aggregations(spark, _stored_stats(spark, sf_dir).path, SINCE, NOW), NOW, LOOKBACK_MINUTES
    )


@_query
def upsert_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats of a feed that is replayed from a new checkpoint into the table it has written."""
    table = _stored_stats(spark, sf_dir)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, size="1 hour", **_run(spark)))
    return _comparable(tables.read_aggregations(spark, table.path))


@_query
def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half of the events as history, the other as a stream: the stats add up."""
    root = scratch_dir(spark, "halves")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.where("event_id % 2 = 1").write.parquet(f"{root}/live")
    history = samples.event_ticks(events.where("event_id % 2 = 0"))
    stats = sinks.aggregations_table(f"{root}/stats", "history")
    jobs.backfill(history, sinks.trades_table(f"{root}/trades", "history"), stats, datetime(2024, 1, 1))
    live = samples.event_ticks(files.stream_parquet(spark, f"{root}/live", events.schema))
    _finish(jobs.start_stats_upsert(live, sinks.aggregations_table(stats.path, "live"), **_run(spark)))
    return _comparable(tables.read_aggregations(spark, stats.path))


@_query
def compacted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats that were written twice, folded, and read again."""
    table = _stored_stats(spark, sf_dir)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, size="1 hour", **_run(spark)))
    compaction.compact_aggregations(spark, table.path, NOW + timedelta(days=10_000))
    return _comparable(tables.read_aggregations(spark, table.path))


@_query
def compacted_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades of three batches, folded beside the batches that they replace."""
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED)
    _feed_in_parts(spark, sf_dir, lambda ticks, run: jobs.start_raw_batches(ticks, table, **run))
    compaction.compact_trades(spark, table.path, NOW + timedelta(days=10_000))
    return tables.read_trades(spark, table.path).drop("ingestion_time")


@_query
def trades_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten trades, looked up by their ids in a table with Bloom filters."""
    trades = samples.event_trades(spark, sf_dir)
    options = tables.bloom_options(1 << 16)
    table = sinks.trades_table(scratch_dir(spark, "trades"), FEED, options=options)
    sinks.batch_writer(table, "history")(trades, 0)
    first = [row.id for row in tables.peek(trades, "trade_timestamp", "id").collect()]
    return _zoneless(tables.read_trades_by_id(spark, table.path, first))


@_query
def bucketed_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades that were stored with other prices before, from a table bucketed by id."""
    name, path = f"trades_{uuid.uuid4().hex}", scratch_dir(spark, "bucketed")
    trades = samples.event_trades(spark, sf_dir)
    first = trades.withColumns({"price": F.col("price") + 1, "ingestion_time": F.expr("ingestion_time - INTERVAL 1 DAY")})
    for rows in (first, trades):
        buckets.store(rows, name, schemas.TRADES_KEY, ["ingestion_time"], path, buckets=16)
    return _zoneless(buckets.newest(spark, name, schemas.TRADES_KEY, ["ingestion_time"]))


@_query
def bucketed_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last trade of each symbol, from a table bucketed by symbol and part."""
    name, path = f"trades_{uuid.uuid4().hex}", scratch_dir(spark, "bucketed")
    buckets.store_by_symbol(samples.event_trades(spark, sf_dir), name, path, buckets=16)
    return _zoneless(buckets.newest_by_symbol(spark, name, ["trade_timestamp", "ingestion_time", "id"]))


@_query
def view_trade_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades per symbol and day through the SQL view of a stored table."""
    root, namespace = scratch_dir(spark, "db"), f"market_{uuid.uuid4().hex[:12]}"
    tables.create_tables(spark, namespace, root)
    table = sinks.aggregations_table(f"{root}/trade_aggregations", FEED)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, size="1 hour", **_run(spark)))
    tables.refresh_tables(spark, namespace)
    return spark.sql(
        f"SELECT window_day, symbol, sum(trade_count) AS total_trades "
        f"FROM {namespace}.trade_aggregations WHERE window_day >= '2024-01-05' GROUP BY ALL"
    )


@_query
def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a feed that are not JSON, some of each event type being cut off."""
    messages = _event_messages(spark, sf_dir, keep=["event_id", "symbol"])
    cut = F.when(F.col("event_id") % 10 == 3, F.substring("value", 1, 20)).otherwise(F.col("value"))
    feed = messages.withColumn("value", cut)
    return envelopes.bad_messages(feed).select("event_id", "symbol")


# Dashboard


@_query
def trade_count_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.trade_count_by_symbol(_recent_stats(spark, sf_dir), NOW, LOOKBACK_MINUTES)


@_query
def trade_count_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.trade_count_share(_recent_stats(spark, sf_dir), NOW, LOOKBACK_MINUTES)


@_query
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = samples.event_trades(spark, sf_dir, since=SINCE)
    return dashboard.latest_price(trades, NOW, LOOKBACK_MINUTES)


@_query
def latest_trade_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = samples.event_trades(spark, sf_dir, since=SINCE)
    return _zoneless(dashboard.latest_trade_row(trades, NOW, LOOKBACK_MINUTES))


@_query
def latest_price_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest_price_label(latest_price(spark, sf_dir))


@_query
def clock_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.events(spark, sf_dir).select(
        "event_id", clock.clock_text(F.col("ts").cast("timestamp")).alias("clock")
    )


@_query
def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = dashboard.trends(_recent_trades(spark, sf_dir), NOW, LOOKBACK_MINUTES)
    return _zoneless(every.withColumn("price", _steady(F.col("price"))))


@_query
def trade_count_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(
        dashboard.trade_count_trend(_recent_trades(spark, sf_dir), NOW, LOOKBACK_MINUTES)
    )


@_query
def volume_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(dashboard.volume_trend(_recent_trades(spark, sf_dir), NOW, LOOKBACK_MINUTES))


@_query
def volume_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(dashboard.volume_stacked(_recent_trades(spark, sf_dir), NOW, LOOKBACK_MINUTES))


@_query
def price_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = dashboard.price_trend(_recent_trades(spark, sf_dir), NOW, LOOKBACK_MINUTES)
    return _zoneless(trend.withColumn("price", _steady(F.col("price"))))


@_query
def rollup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the look-back from stored sums per hour and day, and raw trades at its ends."""
    path = scratch_dir(spark, "rollups")
    rollups.sums(samples.event_trades(spark, sf_dir)).write.partitionBy("level").parquet(path)
    found = rollups.totals(_recent_trades(spark, sf_dir), spark.read.parquet(path), SINCE, NOW)
    return found.withColumn("price", _steady(F.col("price")))


@_query
def trades_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = samples.event_trades(spark, sf_dir)
    return _zoneless(tables.peek(trades, "trade_timestamp", "id"))


@_query
def aggregations_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = samples.event_stats(spark, sf_dir, "1 hour")
    return _comparable(tables.peek(stats, "window_start", "symbol"))


def _event_messages(
    spark: SparkSession, sf_dir: str, keep: Sequence[str] = ("event_id",)
) -> DataFrame:
    ticks = samples.event_ticks(samples.events(spark, sf_dir))
    tick = envelopes.tick_struct(*[F.col(c) for c in schemas.TICKS.names])
    return envelopes.encode_envelopes(
        ticks.withColumnRenamed("message_id", "event_id"), [tick], keep
    )


def _tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_ticks(samples.event_stream(spark, sf_dir))


def _feed_in_parts(spark: SparkSession, sf_dir: str, start: Callable, parts: int = 3) -> None:
    """Run a stream job over a folder that gets a third of all events at a time.

    Every part has events of all days, so what it has is late to the parts before.
    """
    root, run = scratch_dir(spark, "feed"), _run(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for part in range(parts):
        events.where(F.col("event_id") % parts == part).write.mode("append").parquet(root)
        ticks = samples.event_ticks(files.stream_parquet(spark, root, events.schema))
        _finish(start(ticks, run))


def _recent_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_trades(spark, sf_dir, since=SINCE, until=NOW)


def _recent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_stats(spark, sf_dir, "1 hour", SINCE, NOW + timedelta(hours=1))


def _stored_stats(spark: SparkSession, sf_dir: str) -> sinks.Table:
    table = sinks.aggregations_table(scratch_dir(spark, "trade_aggregations"), FEED)
    _finish(jobs.start_stats_upsert(_tick_stream(spark, sf_dir), table, size="1 hour", **_run(spark)))
    return table


def _run(spark: SparkSession) -> dict:
    return {"checkpoint": scratch_dir(spark, "checkpoint"), "trigger": ONCE}


def _finish(query) -> None:
    query.awaitTermination()


def _steady(average: Column) -> Column:
    return F.round(average, 8)


def _comparable(stats: DataFrame) -> DataFrame:
    return _zoneless(stats.withColumn("avg_price", _steady(F.col("avg_price"))))


def _zoneless(result: DataFrame) -> DataFrame:
    zoned = [c for c, kind in result.dtypes if kind == "timestamp"]
    return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
