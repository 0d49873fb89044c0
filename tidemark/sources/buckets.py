"""Tables laid out by key, so that the newest rows of keys are found without a shuffle.

Rows are hashed to a fixed number of buckets as Spark hashes them for an aggregate or a join on
the same columns, one file per bucket and write, sorted inside. Choose the number so that a bucket
fits a task: it cannot change later. Symbols that hold a large share of all rows are cut in parts by
a second bucket column, or the one bucket they are in would be one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upserts import latest_row

PART = "part"
BUCKETS = 64


def store(
    rows: DataFrame, name: str, keys: Sequence[str], sort: Sequence[str], path: str, buckets: int = BUCKETS
) -> None:
    """Append rows to the bucketed table ``name`` in the folder ``path``; both are made if missing.

    The shuffle before the write is by the buckets themselves: each task has one of them.
    """
    (
        rows.repartition(buckets, *keys)
        .write.format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys, *sort)
        .mode("append")
        .saveAsTable(name)
    )


def store_by_symbol(trades: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Trades by symbol and part, in the order of time."""
    store(with_parts(trades, buckets), name, ["symbol", PART], ["trade_timestamp"], path, buckets)


def with_parts(trades: DataFrame, buckets: int) -> DataFrame:
    """``trades`` with the part of each: 0, but where the symbol has more rows than a bucket
    should hold, as many parts as that many buckets would take, dealt by id.

    At most ``buckets`` symbols are that large, so their sizes may pass through the driver.
    """
    counts = trades.groupBy("symbol").count()
    total = trades.count()
    fair = max(1, math.ceil(total / buckets))
    large = {row.symbol: math.ceil(row["count"] / fair) for row in counts.where(F.col("count") > fair).collect()}
    parts = F.lit(1)
    for symbol, n in sorted(large.items(), key=str):
        parts = F.when(F.col("symbol").eqNullSafe(F.lit(symbol)), F.lit(n)).otherwise(parts)
    return trades.withColumn(PART, F.pmod(F.xxhash64("id"), parts).cast("int"))


def newest(spark: SparkSession, name: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key of a table that is bucketed by these keys: no shuffle."""
    return latest_row(spark.table(name), keys, order)


def newest_by_symbol(spark: SparkSession, name: str, order: Sequence[str]) -> DataFrame:
    """The newest trade of each symbol: what moves is one row per symbol and part."""
    trades = spark.table(name).where(F.col("symbol").isNotNull())
    of_parts = latest_row(trades, ["symbol", PART], order)
    return latest_row(of_parts.drop(PART), ["symbol"], order)
