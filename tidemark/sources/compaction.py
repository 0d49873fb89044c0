"""Folding the closed periods of a stored table into few files, beside its readers.

Folded rows go to a tree of their own inside the table, which listings of the table do not see.
Then a version is published in one step: a small file that names, for each period, the folders
that count now and those that they replace. Readers follow the newest version they have seen, so
one that began before still finds what it has listed, until ``remove_replaced`` is called. If a job
breaks off, the version before it stands. One job folds a table at a time: a second one finds its
version taken and fails. What is written to a period after it was folded is read beside it, and
goes in when it is folded again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import clock
from tidemark.sources import folders, tables

def compact_aggregations(spark: SparkSession, path: str, before: datetime) -> list[str]:
    """Fold every day before that of ``before`` to the newest row of each window, symbol and
    source, with the time at which it was first written; gives the days that were folded.

    A day that is in one piece already is left alone.
    """
    return _compact(
        spark,
        path,
        schemas.STORED_AGGREGATIONS,
        schemas.AGGREGATIONS_PERIOD,
        clock.partition_key_of(before, clock.DAILY),
        [schemas.SOURCE, *schemas.TRADE_AGGREGATIONS_KEY],
        lambda log: tables.newest_sums(log).withColumn(
            schemas.AGGREGATIONS_PERIOD, clock.partition_key(F.col("window_start"), clock.DAILY)
        ),
    )


def compact_trades(spark: SparkSession, path: str, before: datetime) -> list[str]:
    """Fold every hour of ingestion before that of ``before``, each trade as it is.

    Files are sorted by id, so that a search for one skips most row groups and pages. Trades that
    a replay stored again stay: which one counts is for a keyed read to say.
    """
    return _compact(
        spark,
        path,
        schemas.STORED_TRADES,
        schemas.TRADES_PERIOD,
        clock.partition_key_of(before, clock.HOURLY),
        list(schemas.TRADES_KEY),
        lambda log: log,
    )


def _compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    period: str,
    last: str,
    order: Sequence[str],
    fold: Callable[[DataFrame], DataFrame],
) -> list[str]:
    path = path.rstrip("/")
    accepted = f"{path}/{schemas.REJECTED}=false"
    keys = [key for key in folders.partition_values(spark, path, accepted, period) if key < last]
    if not keys:
        return []
    version = folders.folded(spark, path)
    batches: dict[str, list[str]] = {}
    for batch in folders.leaves(spark, path, schema, [f"{accepted}/{period}={key}" for key in keys]):
        key = batch.split("/")[1].partition("=")[2]
        known = version["periods"].get(key, {"replaced": []})
        if batch not in known["replaced"]:
            batches.setdefault(key, []).append(batch)
    todo = {
        key: new
        for key, new in batches.items()
        if key in version["periods"] or len(new) > len({batch.split("/")[2] for batch in new})
    }
    if not todo:
        return []

    rows = tables.read_periods(spark, path, schema, period, sorted(todo), version)
    number = version["number"] + 1
    place = f"{path}/{folders.FOLDED}/data"
    folded = fold(rows).withColumns(
        {
            schemas.REJECTED: F.lit(False),
            schemas.RUN_ID: F.lit(folders.FOLDED_RUN),
            schemas.BATCH_ID: F.lit(number).cast("bigint"),
        }
    )
    (
        folded.hint("rebalance", period, schemas.SOURCE)
        .sortWithinPartitions(period, schemas.SOURCE, *order)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(schemas.REJECTED, period, *schemas.WRITER)
        .parquet(place)
    )
    now = time.time()
    periods = dict(version["periods"])
    for key, new in todo.items():
        old = periods.get(key, {"replaced": []})["replaced"]
        periods[key] = {"at": now, "folded": [], "replaced": sorted({*old, *new})}
    roots = [f"{place}/{schemas.REJECTED}=false/{period}={key}" for key in todo]
    for leaf in folders.leaves(spark, place, schema, roots):
        if leaf.endswith(f"/{schemas.BATCH_ID}={number}"):
            periods[leaf.split("/")[1].partition("=")[2]]["folded"].append(leaf)
    folders.publish_folded(spark, path, {"number": number, "periods": periods})
    return sorted(todo)


def remove_replaced(spark: SparkSession, path: str, older_than: timedelta) -> int:
    """Remove folders that were replaced at least ``older_than`` ago, which should be longer than
    any reader takes, and folded ones that no version names; gives their number. Only while
    nothing is folded."""
    path, removed, limit = path.rstrip("/"), 0, time.time() - older_than.total_seconds()
    place = f"{path}/{folders.FOLDED}/data"
    version = folders.folded(spark, path)
    for key, one in version["periods"].items():
        if one["at"] > limit:
            continue
        for batch in one["replaced"]:
            removed += folders.remove(spark, f"{path}/{batch}")
        [first] = {leaf.rsplit("/", 3)[0] for leaf in one["folded"]} or {None}
        if first is not None:
            for leaf in folders.leaves(spark, place, T.StructType(), [f"{place}/{first}"]):
                if leaf not in one["folded"]:
                    removed += folders.remove(spark, f"{place}/{leaf}")
    return removed
