"""Contiguous shards of nearly equal bytes.

Rows are put in ascending order of (id, CRC-32 of the text, size) by a range partitioning; the
bytes of each partition are added up, prefix sums of these totals give the first byte of every
partition, and running sums inside it the first byte of every row. A row belongs to the shard in
which its middle byte falls when all bytes are cut at equal targets. Only ids, sizes and
checksums are shuffled, and equal rows are counted before, so repeated rows cost one.

Nulls: a null text has no bytes, its size is the row overhead alone; a null id comes first. An
empty table gives an empty result; other columns are not looked at. Shards are contiguous, so
with fewer rows than shards some stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import durable, text_of

_ROW = ("id", "text_crc32", "size")


def byte_shards(
    docs: DataFrame,
    shards: int,
    *,
    overhead: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) per row of ``docs``, slots counting from 0."""
    text = text_of(text_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(overhead).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    counted = rows.groupBy(*_ROW).agg(F.count("*").alias("copies"))
    order = [F.col("id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    # Written once: the boundaries of a range partitioning are sampled anew for each run.
    ranged = durable(
        counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )

    parts = ranged.groupBy("part").agg(
        F.sum(F.col("size") * F.col("copies")).alias("part_bytes"), F.sum("copies").alias("part_rows")
    )
    # One row per partition: the only place where all of them meet.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("base_rows"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(bases), "part").select(
        *_ROW,
        "copies",
        "total",
        (
            F.col("base_bytes")
            + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0))
        ).alias("first_byte"),
        (F.col("base_rows") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("first_row"),
    )
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    middle = "2 * (first_byte + copy * size) + size"
    sharded = each.select(
        *_ROW,
        F.expr(f"cast(least({shards - 1}, ({middle}) * {shards} div (2 * total)) as int)").alias("shard"),
        (F.col("first_row") + F.col("copy")).alias("rank"),
    )
    # At most one row per shard.
    firsts = sharded.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first_rank")).alias("slot")
    )
