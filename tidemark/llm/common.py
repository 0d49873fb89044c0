"""Helpers that several operators share: tables, the shared folder, checkpoints, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# White space between words and at the ends of lines: space, and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
# Stands for a missing id where ids are numbers, so that they never become inexact floats.
NULL_ID = -(2**63)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a missing one being empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_of(column: str) -> Column:
    """The id as a 64-bit integer, the smallest of which stands for a missing one."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def id_or_null(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def durable(frame: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder, so that a lost executor costs nothing.

    The folder is the one that ``spark.checkpoint.dir`` names; where nothing is set, as in
    tests, one of this session is made.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        root = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(root or scratch_dir(spark, "checkpoints"))
    return frame.checkpoint(eager=True)


def partitions_for(total: int, per_partition: int, least: int = 1) -> int:
    """How many partitions hold ``total`` units of about ``per_partition`` each."""
    return max(least, -(-int(total) // int(per_partition)))


def id_remainder(id_column: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; -1 for a null id."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus, F.lit(-1))


def some_ids(ids: DataFrame, rows: int) -> DataFrame:
    """Up to ``rows`` rows of ``ids`` (id, ...), which are distinct, chosen by a hash of the id."""
    return one_in(ids, ids.count() // (2 * rows), "id").orderBy(F.xxhash64("id"), "id").limit(rows)


def one_in(frame: DataFrame, share: int, *columns: str) -> DataFrame:
    """One of ``share`` values of some columns, chosen by a hash; all if the share is 1 or less."""
    return frame if share <= 1 else frame.where(F.pmod(F.xxhash64(*columns), F.lit(share)) == 0)


# Tables with any column names


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows with columns _0, _1, ..., which clash with no name of an operator."""
    return docs.toDF(*[f"_{at}" for at in range(len(docs.columns))])


def place(docs: DataFrame, name: str) -> str:
    """The numbered name of a column: the one that is called so exactly, else but for case."""
    if name in docs.columns:
        return f"_{docs.columns.index(name)}"
    [at] = [at for at, column in enumerate(docs.columns) if column.lower() == name.lower()]
    return f"_{at}"


def columns_of(docs: DataFrame, **names: str) -> DataFrame:
    """Only the named columns of a table, under the given names."""
    return numbered(docs).select(*[F.col(place(docs, name)).alias(alias) for alias, name in names.items()])


def free_name(taken: list[str], name: str) -> str:
    """``name`` with as many underscores before it as no column of a table has."""
    while any(column.lower() == name.lower() for column in taken):
        name = f"_{name}"
    return name
