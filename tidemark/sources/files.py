"""Feed messages and ticks from files, as batch or as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rate limits of a file stream; unset, the first batch reads everything there is.
MAX_FILES = "maxFilesPerTrigger"
MAX_BYTES = "maxBytesPerTrigger"


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """One envelope per line, as ``value`` plus a ``message_id``."""
    return _with_message_id(spark.read.text(path))


def stream_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return _with_message_id(spark.readStream.options(**options).text(path))


def _with_message_id(lines: DataFrame) -> DataFrame:
    # File and text identify a message across replays. The same line twice in one file is
    # one message sent twice, and keeps one id; ``feed`` tells such lines apart by position.
    message_id = F.concat_ws(":", F.col("_metadata.file_path"), F.sha2("value", 256))
    return lines.select("value", message_id.alias("message_id"))


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """A Parquet file, or the Parquet files of a folder, as a stream.

    A stream's path must be a folder, so a single file is picked out of its folder by name.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).options(**options)
    if spark.read.format("binaryFile").load(path).select("path").where(F.col("path").endswith(f"/{name}")).isEmpty():
        return reader.parquet(path)
    literal = "".join(f"[{letter}]" if letter in "*?[]{}" else letter for letter in name)
    return reader.option("pathGlobFilter", literal).parquet(folder or "/")
