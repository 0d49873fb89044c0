"""The two stored tables: creation, pruned scans and SQL views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import clock
from tidemark.operators.upserts import latest_row
from tidemark.sources import folders

# Newest first by the time of writing, then by batch: one number, so that finding the newest
# row needs no sort. Times are microseconds, of which three digits give way to the batch.
VERSION = f"unix_micros(written_at) * 1000 + pmod({schemas.BATCH_ID}, 1000)"

_PUSHED = 10


def create_tables(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the namespace, the stored tables and views of them where they do not exist yet.

    ``trades_log`` and ``trade_aggregations_log`` are the folders jobs write to, ``trades`` and
    ``trade_aggregations`` show their accepted rows, stats in their newest version added up over
    sources. Each view ends with its period column: a filter on that prunes folders.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    for name, columns, period in (
        ("trades", schemas.STORED_TRADES, schemas.TRADES_PERIOD),
        ("trade_aggregations", schemas.STORED_AGGREGATIONS, schemas.AGGREGATIONS_PERIOD),
    ):
        listed = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in columns)
        partitions = ", ".join([schemas.REJECTED, period, *schemas.WRITER])
        place = ""
        if location:
            path = f"{location.rstrip('/')}/{name}"
            folders.make(spark, path)
            place = f"LOCATION '{path}'"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {namespace}.{name}_log ({listed}) "
            f"USING parquet PARTITIONED BY ({partitions}) {place}"
        )
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {namespace}.trades AS "
        f"SELECT {', '.join(schemas.TRADES.names)}, {schemas.TRADES_PERIOD} "
        f"FROM {namespace}.trades_log WHERE NOT {schemas.REJECTED}"
    )
    # The day follows from the window's start, so grouping by it changes nothing, and lets a
    # filter on it through to the scan.
    keys = ", ".join([*schemas.TRADE_AGGREGATIONS_KEY, schemas.AGGREGATIONS_PERIOD])
    newest = ", ".join(
        f"max_by({name}, {VERSION}) AS {name}"
        for name in ("window_end", "price_sum", "price_count", "trade_count")
    )
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {namespace}.trade_aggregations AS "
        f"SELECT window_start, max(window_end) AS window_end, symbol, "
        f"try_divide(sum(price_sum), sum(price_count)) AS avg_price, "
        f"sum(trade_count) AS trade_count, {schemas.AGGREGATIONS_PERIOD} FROM ("
        f"SELECT {keys}, {newest} FROM {namespace}.trade_aggregations_log "
        f"WHERE NOT {schemas.REJECTED} GROUP BY {keys}, {schemas.SOURCE}) GROUP BY {keys}"
    )


def refresh_tables(spark: SparkSession, namespace: str) -> None:
    """Make files written by path visible to SQL; needed after a job has written or folded.

    Folded folders take the place of those they replace. In a table without a location of its
    own the replaced files are removed by that.
    """
    for log in ("trades_log", "trade_aggregations_log"):
        table = f"{namespace}.{log}"
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        path = about.first().data_type.rstrip("/")
        place = f"{path}/{folders.FOLDED}/data"
        current = {leaf: f"{place}/{leaf}" for one in folders.folded(spark, path)["periods"].values() for leaf in one["folded"]}
        gone = {batch for one in folders.folded(spark, path)["periods"].values() for batch in one["replaced"]}
        shown = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        stale = {name for name in shown if f"{schemas.RUN_ID}={folders.FOLDED_RUN}/" in name and name not in current}
        for name in sorted((gone & shown) | (stale if current else set())):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_partition(name)})")
        for name in sorted(set(current) - shown):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_partition(name)}) LOCATION '{current[name]}'")
        spark.catalog.refreshTable(table)


def _partition(folder: str) -> str:
    """rejected=false/… as SQL; Spark escapes some characters of values in folders."""
    pairs = (unquote(part).partition("=") for part in folder.split("/"))
    return ", ".join(f"{name} = '" + value.replace("'", "\\'") + "'" for name, _, value in pairs)


def read_trades(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Trades of the hours that touch [since, until]; exact bounds are the query's business.

    ``keyed`` keeps the newest row of each id, as a store with the id as its key would: the
    table as it was at ``until``, of what was ingested from ``since`` on, both bounds exact. Of
    trades stored under their event time that is one per millisecond. Stable ids repeat where a
    checkpoint was reset and the feed replayed, and for a line that a file holds twice.
    """
    rows = _accepted(
        spark, path, schemas.STORED_TRADES, schemas.TRADES_PERIOD, clock.HOURLY, since, until
    ).select(*schemas.TRADES.names)
    if not keyed:
        return rows
    if since is not None:
        rows = rows.where(F.col("ingestion_time") >= clock.instant(since))
    if until is not None:
        rows = rows.where(F.col("ingestion_time") <= clock.instant(until))
    return latest_row(rows, schemas.TRADES_KEY, ["ingestion_time"])


def bloom_options(ids_per_file: int) -> dict[str, str]:
    """Settings of a writer of trades that keep Bloom filters of ids, of 1 % false positives.

    For ``sinks.trades_table(..., options=...)``; a filter takes about 1.2 bytes per id.
    """
    return {
        "parquet.bloom.filter.enabled#id": "true",
        "parquet.bloom.filter.expected.ndv#id": str(ids_per_file),
        "parquet.bloom.filter.max.bytes": str(max(1 << 20, 2 * ids_per_file)),
    }


def read_trades_by_id(
    spark: SparkSession,
    path: str,
    ids: Sequence[str],
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """The trades of a few ids. Row groups that cannot hold any of them are not read: the ids are
    compared with their bounds, their dictionaries and, where written, their Bloom filters.

    Spark hands lists of up to ten values to the files as they are, longer ones as one range.
    """
    wanted = F.lit(False)
    for at in range(0, len(ids), _PUSHED):
        wanted = wanted | F.col("id").isin(list(ids[at : at + _PUSHED]))
    return read_trades(spark, path, since, until).where(wanted)


def read_aggregations(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """The stats of each window and symbol that starts in the days of [since, until].

    Of each source the newest row counts, whichever run wrote it; sources add up.
    """
    return added_up(newest_sums(read_sums(spark, path, since, until)))


def read_deltas(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    runs: Sequence[str] | None = None,
) -> DataFrame:
    """The stats of a table of deltas: what all batches of all sources have of each window.

    A feed that is replayed from a new checkpoint is a new run and would count twice: name the
    ``runs`` that count then.
    """
    log = read_sums(spark, path, since, until)
    return added_up(log if runs is None else log.where(F.col(schemas.RUN_ID).isin(list(runs))))


def added_up(sums: DataFrame) -> DataFrame:
    """One row per window and symbol from rows of sums."""
    total, n = F.sum("price_sum"), F.sum("price_count")
    added = sums.groupBy(*schemas.TRADE_AGGREGATIONS_KEY).agg(
        F.max("window_end").alias("window_end"),
        F.try_divide(total, n).alias("avg_price"),
        F.sum("trade_count").alias("trade_count"),
    )
    return added.select(*schemas.TRADE_AGGREGATIONS.names)


def read_sums(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """The log of stats as written: every version of every source."""
    return _accepted(
        spark, path, schemas.STORED_AGGREGATIONS, schemas.AGGREGATIONS_PERIOD, clock.DAILY,
        since, until,
    )


def newest_sums(log: DataFrame) -> DataFrame:
    """The newest row of each window, symbol and source."""
    keys = [*schemas.TRADE_AGGREGATIONS_KEY, schemas.SOURCE]
    values = [name for name in schemas.AGGREGATION_SUMS.names if name not in keys]
    log = log.withColumn("version", F.expr(VERSION))
    return log.groupBy(*keys).agg(*[F.max_by(name, "version").alias(name) for name in values])


def read_late(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """The ticks of a table of late ones, of windows that start in the days of [since, until]."""
    return _accepted(
        spark, path, schemas.STORED_LATE_TICKS, schemas.AGGREGATIONS_PERIOD, clock.DAILY, since, until
    )


def read_rejected(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Rows that came without a full key; ``columns`` is one of the STORED schemas."""
    return spark.read.schema(columns).parquet(path).where(F.col(schemas.REJECTED))


def _accepted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    period: str,
    pattern: str,
    since: datetime | None,
    until: datetime | None,
) -> DataFrame:
    """Rows with a full key, of the periods that touch [since, until]; open ends are allowed.

    The period folders are listed, one level deep, and only those inside the bounds are read. A
    table that does not exist is an error, a period without a folder is empty.
    """
    first = None if since is None else clock.partition_key_of(since, pattern)
    last = None if until is None else clock.partition_key_of(until, pattern)
    path = path.rstrip("/")
    accepted = f"{path}/{schemas.REJECTED}=false"
    keys = [
        key
        for key in folders.partition_values(spark, path, accepted, period)
        if (first is None or key >= first) and (last is None or key <= last)
    ]
    version = folders.folded(spark, path)
    # A period all of whose folders were replaced and removed has only folded ones.
    keys += [
        key
        for key in version["periods"]
        if key not in keys and (first is None or key >= first) and (last is None or key <= last)
    ]
    return read_periods(spark, path, schema, period, sorted(keys), version)


def read_periods(
    spark: SparkSession, path: str, schema: T.StructType, period: str, keys: Sequence[str], version: dict
) -> DataFrame:
    """Accepted rows of some periods as a version of the folded ones has them.

    A period that was never folded is read as the one folder it is.
    """
    accepted = f"{path}/{schemas.REJECTED}=false"
    there = set(folders.partition_values(spark, path, accepted, period))
    plain = [f"{accepted}/{period}={key}" for key in keys if key not in version["periods"]]
    ours = {key: version["periods"][key] for key in keys if key in version["periods"]}
    if both := [f"{accepted}/{period}={key}" for key in ours if key in there]:
        replaced = {batch for one in ours.values() for batch in one["replaced"]}
        batches = folders.leaves(spark, path, schema, both)
        plain += [f"{path}/{batch}" for batch in batches if batch not in replaced]
    place = f"{path}/{folders.FOLDED}/data"
    folded = [f"{place}/{leaf}" for one in ours.values() for leaf in one["folded"]]
    found = [
        spark.read.schema(schema).option("basePath", root).parquet(*wanted)
        for root, wanted in ((path, plain), (place, folded))
        if wanted
    ]
    if not found:
        return spark.createDataFrame([], schema)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def peek(table: DataFrame, *order: str, rows: int = 10) -> DataFrame:
    """The first rows under a full order, which keeps only that many per task."""
    return table.orderBy(*order).limit(rows)
