"""Rows per micro-batch, counted while the batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRIC = "batch_rows"


def count_rows(rows: DataFrame) -> DataFrame:
    """Adds a row counter to the plan; it costs no job of its own."""
    return rows.observe(METRIC, F.count(F.lit(1)).alias("rows"))


def rows_per_batch(query: StreamingQuery) -> dict[int, int]:
    """Row counts of the batches Spark still remembers, by batch number."""
    return {
        progress["batchId"]: progress["observedMetrics"][METRIC]["rows"]
        for progress in query.recentProgress
        if METRIC in progress["observedMetrics"]
    }


def rows_dropped_as_late(query: StreamingQuery) -> dict[int, int]:
    """Rows that came after the watermark had passed them, by batch number."""
    return {
        progress["batchId"]: sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        for progress in query.recentProgress
    }


class BatchLog(StreamingQueryListener):
    """Keeps the row counts of every batch in a table, while Spark remembers the last 100.

    Counts are written in groups of ``every`` batches, and when a query ends. Add it with
    ``spark.streams.addListener`` before the queries start.
    """

    COLUMNS = "run_id string, batch_id long, row_count long, late_rows long"

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(METRIC)
        rows = observed["rows"] if observed is not None else progress.numInputRows
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        self.held.append((str(progress.id), progress.batchId, rows, late))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        held, self.held = self.held, []
        if held:
            rows = self.spark.createDataFrame(held, self.COLUMNS).coalesce(1)
            rows.write.mode("append").parquet(self.path)


def logged_batches(spark: SparkSession, path: str) -> DataFrame:
    """The table of a ``BatchLog``; a batch that was replayed counts once, as it ran last."""
    log = spark.read.schema(BatchLog.COLUMNS).parquet(path)
    return log.groupBy("run_id", "batch_id").agg(
        F.max("row_count").alias("row_count"), F.max("late_rows").alias("late_rows")
    )


def stored_rows_per_batch(trades: DataFrame) -> DataFrame:
    """The same counts afterwards, from the stored table: one stamp per ingested batch."""
    return trades.groupBy("ingestion_time").agg(F.count("*").alias("row_count"))
