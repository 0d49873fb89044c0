"""Lines that occur in several documents stay in the first of them only.

A line's key is the line without white space at its ends and with A-Z in lower case. The 128-bit
hashes of all keys of at least ``least_chars`` code points are range-partitioned together with a
bucket of ids, and sorted by id and position inside a partition. A running window then streams
each run of one hash and bucket: lines after the first document of the run are dropped. Runs of
one hash in several buckets, as a very common line has them, meet as one row per run. Buckets
split the runs of a hot line over partitions, so no task holds all its occurrences.

What comes back is a keep bitmap per document, not text: 64 lines to a number, a set bit for a
kept line, and only those numbers that drop a line. Everything is built-in expressions.

Nulls: a null or empty text is one empty line, whose key is too short to be dropped. Rows
without an id count as one document that comes before all others. Rows with equal ids count as
one document. An empty table gives an empty result; other columns stay, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, durable, id_of, lower_ascii, numbered, place, text_of

_BUCKET_BITS = 12
_ROW = ("__row_id", "__row_hash")
_KEY = ("hash_1", "hash_2")
ADDED = ("kept_text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(ASCII_SPACE)))


def _with_row(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs``, its columns numbered, with what tells rows apart, and the text without nulls."""
    text = text_of(place(docs, text_column))
    return numbered(docs).withColumns(
        {"__row_id": id_of(place(docs, id_column)), "__row_hash": F.xxhash64(text), "__text": text}
    )


def _lines(rows: DataFrame, least_chars: int) -> DataFrame:
    lines = rows.select(*_ROW, F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select(*_ROW, "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= least_chars).select(
        *_ROW,
        "pos",
        F.xxhash64("key").alias("hash_1"),
        F.xxhash64(F.lit("second"), F.col("key")).alias("hash_2"),
        F.shiftright("__row_id", _BUCKET_BITS).alias("bucket"),
    )


def keep_bitmaps(
    docs: DataFrame, *, least_chars: int = 10, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(__row_id, __row_hash, kept, n_dropped) of each row that loses lines.

    ``kept`` maps the number of a group of 64 lines to the bits of its kept lines.
    """
    # Written once, in a few bytes per line: the range partitioning reads its input twice, and
    # what it makes is used twice.
    lines = durable(_lines(_with_row(docs, id_column, text_column), least_chars))
    run = [*_KEY, "bucket"]
    streamed = Window.partitionBy(*run).orderBy("__row_id", "pos")
    so_far = streamed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = lines.repartitionByRange(*run).withColumn("first_id", F.first("__row_id").over(so_far))

    spread = (
        ranged.groupBy(*_KEY)
        .agg(F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))
        .where("first_bucket < last_bucket")
        .drop("last_bucket")
    )
    heads = ranged.where("__row_id = first_id").join(spread, list(_KEY))
    dropped = (
        ranged.where("__row_id > first_id")
        .select(*_ROW, "pos")
        .unionByName(heads.where("bucket > first_bucket").select(*_ROW, "pos"))
    )

    bit = F.expr("shiftleft(1L, pos % 64)")
    groups = dropped.groupBy(*_ROW, F.expr("pos div 64").alias("of")).agg(
        F.bit_or(bit).alias("gone")
    )
    return groups.groupBy(*_ROW).agg(
        F.map_from_entries(F.collect_list(F.struct("of", F.bitwise_not("gone").alias("kept")))).alias("kept"),
        F.sum(F.bit_count("gone")).alias("n_dropped"),
    )


def drop_repeated_lines(
    docs: DataFrame,
    *,
    least_chars: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``; no row goes.

    ``prefix`` comes before these three names, for tables that have columns called like them. The
    kept text of a row that loses no line is its text, empty if that is null.
    """
    bitmaps = keep_bitmaps(docs, least_chars=least_chars, id_column=id_column, text_column=text_column)
    # All groups of 64 up to the last that drops a line, for lookup by position.
    groups = bitmaps.withColumn(
        "__kept",
        F.expr("transform(sequence(0, array_max(map_keys(kept))), g -> coalesce(kept[g], -1L))"),
    ).select(*_ROW, "__kept", F.col("n_dropped").alias("__n_dropped"))
    joined = _with_row(docs, id_column, text_column).join(groups, list(_ROW), "left")
    stays = (
        "(line, i) -> i div 64 >= size(__kept) or "
        "(shiftright(__kept[cast(i div 64 as int)], i % 64) & 1L) = 1L"
    )
    kept = F.expr(f"array_join(filter(split(__text, '\\n', -1), {stays}), '\\n')")
    every = joined.select(
        *numbered(docs).columns,
        F.when(F.col("__kept").isNull(), F.col("__text")).otherwise(kept),
        F.size(F.split("__text", "\n", -1)).cast("long"),
        F.coalesce("__n_dropped", F.lit(0)).cast("long"),
    )
    return every.toDF(*docs.columns, *[f"{prefix}{name}" for name in ADDED])
