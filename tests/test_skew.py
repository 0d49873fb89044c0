"""Tables of many files in which a third of all rows are copies of one row."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.test_oracles import canonical

SMALL = "/root/testdata/sf0.001"
NAMES = [
    "tumbling_stats", "envelope_parse", "stable_trade_id", "batch_row_counts",
    "trades_by_event_ms", "upsert_latest_version", "raw_trades_v1", "raw_trades_v2",
    "window_stats_append", "window_stats_upsert", "trade_count_share", "latest_price",
    "latest_trade_row", "trends", "volume_stacked", "trades_peek",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name, key in (("events", "event_id"), ("lineitem", "l_orderkey")):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        hot = table.orderBy(*table.columns).limit(1)
        copies = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(table.count() // 2))))
        both = table.unionByName(copies.drop("copy")).repartition(6)
        both.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql_on_skewed_files(spark, skewed, name):
    duck = duckdb.connect()
    for table in ("events", "lineitem"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    ours = canonical(contract.queries()[name](spark, skewed).toPandas())
    theirs = canonical(duck.sql(contract.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-12)
