"""What a store holds of numbered messages: missing, repeated and overlapping ranges.

Gaps and islands without putting all numbers of a stream into one task: numbers are cut into
blocks of ``WIDTH``, gaps and islands are found inside each block by windows, and only what touches
the border of a block goes on to blocks that are as many times larger. After three levels what is
left of a stream is one row per 2^48 numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 16
LEVELS = 3
MISSING, REPEATED, OVERLAP = "missing", "repeated", "overlap"


def audit(stored: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Ranges (stream, kind, first, last, messages, rows) of stored identities.

    ``stored`` has ``stream`` (topic and partition, or file), ``offset`` and ``writer`` (a run or
    source). *missing*: numbers between others of which there is no row, and before the first or
    behind the last that ``expected`` (stream, first, last) names. *repeated*: numbers that one
    writer has stored more than once. *overlap*: numbers that several writers have. ``rows`` are
    the rows that hold the range. Rows without a stream or number are not looked at.
    """
    known = stored.where(F.col("stream").isNotNull() & F.col("offset").isNotNull())
    # One row per number, however often it is there.
    numbers = known.groupBy("stream", F.col("offset").cast("long").alias("offset")).agg(
        F.count("*").alias("rows"), F.min("writer").alias("one"), F.max("writer").alias("other")
    )
    kind = F.when(~F.col("one").eqNullSafe(F.col("other")), OVERLAP).when(F.col("rows") > 1, REPEATED)
    points = numbers.select("stream", kind.alias("kind"), F.col("offset").alias("first"), F.col("offset").alias("last"), "rows")
    return missing_ranges(points, expected).unionByName(islands(points.where(F.col("kind").isNotNull())))


def missing_ranges(points: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Gaps between the ranges (stream, first, last), which do not meet each other."""
    ranges = points.select("stream", "first", "last")
    if expected is not None:
        # Numbers right outside what is expected stand for the edges, where no row lies beyond.
        edges = ranges.groupBy("stream").agg(F.min("first").alias("low"), F.max("last").alias("high"))
        below, above = F.col("first") - 1, F.col("last") + 1
        marks = F.array(
            F.when(F.col("low").isNull() | (below < F.col("low")), below),
            F.when(F.col("high").isNull() | (above > F.col("high")), above),
        )
        bounds = expected.join(edges, "stream", "left").select("stream", F.explode(marks).alias("first"))
        ranges = ranges.unionByName(bounds.where("first IS NOT NULL").withColumn("last", F.col("first")))
    found = None
    for level in range(1, LEVELS + 2):
        block = F.shiftright("first", BITS * level) if level <= LEVELS else F.lit(0)
        in_order = Window.partitionBy("stream", "block").orderBy("first")
        next_ = ranges.withColumn("block", block.cast("long")).withColumn("next", F.lead("first").over(in_order))
        gaps = next_.where(F.col("next") > F.col("last") + 1).select(
            "stream", (F.col("last") + 1).alias("first"), (F.col("next") - 1).alias("last")
        )
        found = gaps if found is None else found.unionByName(gaps)
        if level <= LEVELS:
            ranges = next_.groupBy("stream", "block").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return found.select(
        "stream",
        F.lit(MISSING).alias("kind"),
        "first",
        "last",
        (F.col("last") - F.col("first") + 1).alias("messages"),
        F.lit(0).cast("long").alias("rows"),
    )


def islands(points: DataFrame) -> DataFrame:
    """Ranges (stream, kind, first, last, rows) joined with those of their kind next to them."""
    whole, ranges = None, points.select("stream", "kind", "first", "last", "rows")
    for level in range(1, LEVELS + 2):
        top = level > LEVELS
        block = F.lit(0).cast("long") if top else F.shiftright("first", BITS * level)
        in_order = Window.partitionBy("stream", "kind", "block").orderBy("first")
        starts = F.coalesce(F.col("first") > F.lag("last").over(in_order) + 1, F.lit(True)).cast("int")
        running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        numbered = (
            ranges.withColumn("block", block)
            .withColumn("starts", starts)
            .withColumn("island", F.sum("starts").over(running))
        )
        joined = numbered.groupBy("stream", "kind", "block", "island").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows")
        )
        if top:
            inside = joined
        else:
            size = F.lit(1 << (BITS * level)).cast("long")
            at_border = (F.pmod("first", size) == 0) | (F.pmod(F.col("last") + 1, size) == 0)
            inside, ranges = joined.where(~at_border), joined.where(at_border)
            ranges = ranges.select("stream", "kind", "first", "last", "rows")
        inside = inside.select(
            "stream", "kind", "first", "last", (F.col("last") - F.col("first") + 1).alias("messages"), "rows"
        )
        whole = inside if whole is None else whole.unionByName(inside)
    return whole
