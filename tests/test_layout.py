"""Bucketed tables and Bloom filters: what plans and scans do with them."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import buckets, tables
from tidemark.streaming import sinks


def trades(spark, n, symbol="'A'", parts=8):
    return spark.range(0, n, 1, parts).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.expr(symbol).alias("symbol"),
        F.col("id").cast("double").alias("price"),
        F.lit(1.0).alias("volume"),
        F.col("id").alias("trade_timestamp"),
        F.timestamp_seconds(F.lit(0)).alias("ingestion_time"),
    )


@pytest.fixture
def name(spark):
    made = f"bucketed_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_by_key_need_no_exchange(spark, folder, name):
    for shift in range(2):
        rows = trades(spark, 1000).withColumn("ingestion_time", F.timestamp_seconds(F.lit(shift)))
        rows = rows.withColumn("price", F.col("price") + shift)
        buckets.store(rows, name, schemas.TRADES_KEY, ["ingestion_time"], folder("t"), buckets=8)
    newest = buckets.newest(spark, name, schemas.TRADES_KEY, ["ingestion_time"])
    assert "Exchange" not in plan_of(newest) and "Bucketed: true" in plan_of(newest)
    assert sorted(row.price for row in newest.collect()) == [i + 1 for i in range(1000)]
    assert len(spark.table(name).inputFiles()) == 16  # one per bucket and write


def test_a_join_of_two_bucketed_tables_needs_no_exchange(spark, folder, name):
    buckets.store(trades(spark, 100), name, ["id"], [], folder("t"), buckets=8)
    table = spark.table(name)
    other = table.select("id", F.col("price").alias("other")).hint("merge")
    both = table.join(other, "id")
    assert "Exchange" not in plan_of(both) and both.count() == 100


def test_hot_symbols_are_cut_in_parts(spark, folder, name):
    symbol = "if(id % 3 = 0, 'hot', if(id % 500 = 1, null, concat('s', id % 200)))"
    rows = trades(spark, 6000, symbol)
    buckets.store_by_symbol(rows, name, folder("t"), buckets=16)
    table = spark.table(name)
    parts = {r.symbol: r.n for r in table.groupBy("symbol").agg(F.count_distinct(buckets.PART).alias("n")).collect()}
    assert parts["hot"] == 6 and {n for s, n in parts.items() if s != "hot"} == {1}
    largest = table.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 4 * 6000 / 16
    newest = buckets.newest_by_symbol(spark, name, ["trade_timestamp"])
    assert plan_of(newest).count("Exchange") == 1  # of one row per symbol and part
    want = rows.where("symbol IS NOT NULL").groupBy("symbol").agg(F.max("price")).collect()
    assert sorted((r.symbol, r.price) for r in newest.collect()) == sorted(map(tuple, want))


def test_an_empty_table(spark, folder, name):
    buckets.store_by_symbol(trades(spark, 0), name, folder("t"), buckets=4)
    assert buckets.newest_by_symbol(spark, name, ["trade_timestamp"]).count() == 0


def rows_read(frame):
    """Rows of the row groups that the scan has not left out, by its own count."""
    found = frame.collect()
    scans = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return found, sum(scans.apply(i).metrics().get("numOutputRows").get().value() for i in range(scans.size()))


@pytest.mark.parametrize("bloom", [False, True])
def test_bloom_filters_leave_out_row_groups(spark, folder, bloom):
    n, parts = 40_000, 16
    options = tables.bloom_options(n // parts) if bloom else {}
    # Ids that are spread over all bounds and differ, so neither bounds nor dictionaries help.
    options = {**options, "parquet.enable.dictionary": "false"}
    table = sinks.trades_table(folder("trades"), "feed", options=options)
    sinks.batch_writer(table, "run")(trades(spark, n, parts=parts), 0)
    ids = [row.id for row in trades(spark, n).where("price IN (3, 39999)").collect()]
    found, read = rows_read(tables.read_trades_by_id(spark, table.path, [*ids, "none"]))
    assert sorted(row.price for row in found) == [3, 39999]
    if bloom:
        assert read <= 4 * n // parts  # two of sixteen groups, and few by chance
    many = [row.id for row in trades(spark, n).where("price < 35").collect()]
    found, _ = rows_read(tables.read_trades_by_id(spark, table.path, many))
    assert len(found) == 35
    assert tables.read_trades_by_id(spark, table.path, []).count() == 0
