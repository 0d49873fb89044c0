"""Running stats kept by copy on write: readers find one row per key and search no newest one.

A table is a row of versions. A version is a small file that names the folder of each day and the
last batch of each run that is in it. A batch reads the days it touches, writes them anew with its
own rows in place of the old ones, and then publishes the next version in one step. If it breaks
off before that, the old version stands and what it wrote is found by nobody; if it is run again
after that, the version says so and nothing is done. One job writes a table at a time: a second
one finds its version taken and fails. Readers hold on to the version they have read; folders of
older ones stay until ``remove_old``.
"""

from __future__ import annotations

import json
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators import ticks as tick_ops
from tidemark.operators.windows import WINDOW_SIZE, window_stats
from tidemark.session import keep_state_off_heap
from tidemark.sources import folders
from tidemark.streaming import sinks

_KEYS = list(schemas.TRADE_AGGREGATIONS_KEY)
_DAY = schemas.AGGREGATIONS_PERIOD
_EMPTY = {"number": 0, "days": {}, "batches": {}}


def current(spark: SparkSession, path: str) -> dict:
    """The newest version: its number, the folder of each day, the last batch of each run."""
    numbers = [int(name) for name in folders.files(spark, f"{path}/versions") if name.isdigit()]
    if not numbers:
        return _EMPTY
    return json.loads(folders.read_text(spark, f"{path}/versions/{max(numbers)}"))


def read(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The stats as of the newest version, or those of some days."""
    return _read(spark, path, current(spark, path), days)


def _read(spark: SparkSession, path: str, version: dict, days: list[str] | None) -> DataFrame:
    wanted = [
        f"{path}/data/{folder}/{_DAY}={day}"
        for day, folder in sorted(version["days"].items())
        if days is None or day in days
    ]
    if not wanted:
        return spark.createDataFrame([], schemas.TRADE_AGGREGATIONS)
    return spark.read.schema(schemas.TRADE_AGGREGATIONS).parquet(*wanted)


def upsert(rows: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Put rows, one per key, in the place of those of the same key. Rows without a full key
    belong to no table of keys and are left out."""
    spark = rows.sparkSession
    version = current(spark, path)
    if version["batches"].get(run, -1) >= batch_id:
        return
    valid = rows.where(tick_ops.keys_present(_KEYS)).select(*schemas.TRADE_AGGREGATIONS.names).persist()
    try:
        day = clock.partition_key(F.col("window_start"), clock.DAILY)
        touched = [row[0] for row in valid.select(day).distinct().collect()]
        kept = _read(spark, path, version, touched).join(valid.select(*_KEYS), _KEYS, "left_anti")
        folder = f"{version['number'] + 1}-{uuid.uuid4().hex}"
        if touched:
            # One file per day, or more where a day is large: as adaptive execution sees fit.
            whole = kept.unionByName(valid).withColumn(_DAY, day)
            whole.hint("rebalance", _DAY).write.partitionBy(_DAY).parquet(f"{path}/data/{folder}")
    finally:
        valid.unpersist()
    number = version["number"] + 1
    days = version["days"] | dict.fromkeys(touched, folder)
    after = {"number": number, "days": days, "batches": version["batches"] | {run: batch_id}}
    folders.publish_text(spark, f"{path}/versions/{number}", json.dumps(after))


def start_stats(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    watermark: str | None = None,
    **settings,
) -> StreamingQuery:
    """Running stats of the windows each batch changed, rewritten into their days."""
    spark = ticks.sparkSession
    keep_state_off_heap(spark)
    stats = window_stats(tick_ops.with_event_time(ticks), size, watermark)
    run = cache(lambda: sinks.run_of(spark, checkpoint))
    return sinks.start_each(
        stats, lambda batch, number: upsert(batch, path, run(), number), checkpoint, "update", **settings
    )


def remove_old(spark: SparkSession, path: str) -> int:
    """Remove folders that the newest version does not name; gives their number.

    Only while no batch runs and no reader is at an older version.
    """
    named = set(current(spark, path)["days"].values())
    old = [name for name in folders.names(spark, f"{path}/data") if name not in named]
    for name in old:
        folders.remove(spark, f"{path}/data/{name}")
    return len(old)
