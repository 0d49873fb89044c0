"""Token ids of all documents as flat integer files with 64-bit document offsets.

A folder holds, for each part:

- ``kind=tokens/part=N``: the ids of the part's documents, little-endian unsigned integers of
  2 or 4 bytes and nothing else, each document closed by the end id;
- ``kind=offsets/part=N``: a 64-bit integer per document, the number of ids in all documents
  before it, over all parts;
- ``kind=docs/part=N``: two 64-bit integers per document, its id and its number of ids.

and ``parts``, a table with the first token and the first document of each part. Parts, and the
documents in them, are in ascending order of (id, hash of the text). All files are written by Spark's own
writer, so failed and repeated tasks leave nothing behind; a reader maps them into memory.

Nulls: a null text is empty, so its ids are the end id alone; a null id comes first and is kept
as the smallest 64-bit integer, and read back as null. Repeated rows are kept. An empty table
gives no parts. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_of, id_or_null, partitions_for, text_of
from tidemark.llm.encoding import PieceEncoder, crc32_of_u32

_CHUNK_BYTES = 4 << 20
_FILES = "kind string, part int, seq int, value binary"
_PARTS = "part int, n_docs long, n_tokens long, first_doc long, first_token long"
_DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    *,
    width: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    text_bytes_per_part: int = 16 << 20,
) -> None:
    """Encode every whole text, append ``end_id`` and write the files to ``path``."""
    if end_id.to_bytes(width, "little")[-1]:
        raise ValueError("the end id must leave the highest byte of an id zero")
    spark = docs.sparkSession
    # Keys of a range partitioning are sampled to the driver: a hash of the text, not the text.
    texts = docs.select(
        id_of(id_column).alias("id"), text_of(text_column).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    total = texts.agg(F.sum(F.octet_length("text") + 64)).first()[0]
    if total is None:
        spark.createDataFrame([], _PARTS).write.parquet(f"{path}/parts")
        return
    ordered = texts.repartitionByRange(
        partitions_for(total, text_bytes_per_part), "id", "text_hash"
    ).sortWithinPartitions("id", "text_hash")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PieceEncoder.shared(tokenizer, width)
        end = end_id.to_bytes(width, "little")
        part, seq = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        index: list[tuple[int, int]] = []
        size = 0

        def chunk() -> pd.DataFrame:
            values = [b"".join(held)[:-1], np.array(index, dtype="<i8").tobytes()[:-1]]
            return pd.DataFrame(
                {"kind": ["tokens", "docs"], "part": part, "seq": seq, "value": values}
            )

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                value = encoder.encode([text])[0] + end
                held.append(value)
                index.append((int(doc_id), len(value) // width))
                size += len(value)
                if size >= _CHUNK_BYTES:
                    yield chunk()
                    held, index, size, seq = [], [], 0, seq + 1
        if held:
            yield chunk()

    files = ordered.select("id", "text").mapInPandas(encode, _FILES).sortWithinPartitions("kind", "part", "seq")
    _write(files, path, "kind", "part")
    _write_offsets(spark, path)


def _write(files: DataFrame, path: str, *folders: str) -> None:
    """Bytes as they are. Each value lacks its last byte, a zero that the writer adds."""
    values = files.select(*folders, F.col("value").cast("string"))
    values.write.partitionBy(*folders).option("lineSep", "\0").text(path)


def _write_offsets(spark: SparkSession, path: str) -> None:
    docs = _files(spark, path, "docs")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, content in zip(batch["part"], batch["content"], strict=True):
                lengths = np.frombuffer(content, dtype="<i8")[1::2]
                yield pd.DataFrame(
                    {"part": [part], "n_docs": [len(lengths)], "n_tokens": [int(lengths.sum())]}
                )

    counts = docs.mapInPandas(count, "part int, n_docs long, n_tokens long")
    # One row per part: the only place where all parts meet.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts.select(
        "*",
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first_doc"),
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"),
    ).write.parquet(f"{path}/parts")

    def offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["part"], batch["content"], batch["first_token"], strict=True)
            for part, content, first in rows:
                lengths = np.frombuffer(content, dtype="<i8")[1::2]
                starts = first + np.cumsum(lengths) - lengths
                value = starts.astype("<i8").tobytes()[:-1]
                yield pd.DataFrame({"part": [part], "value": [value]})

    bases = spark.read.parquet(f"{path}/parts").select("part", "first_token")
    placed = docs.join(bases, "part").mapInPandas(offsets, "part int, value binary")
    _write(placed, f"{path}/kind=offsets", "part")


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The files of one kind, one row each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    return files.load(f"{path}/kind={kind}")


def read_token_files(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """Per document what the files hold: its id, offset, number of ids and their CRC-32.

    A task maps the files of its parts; pages are read as they are touched. In a store that
    cannot be mapped the files of a part are read whole, one part at a time.
    """
    kinds = ("tokens", "offsets", "docs")
    n = spark.read.schema(_PARTS).parquet(f"{path}/parts").count()
    if n == 0:
        return spark.createDataFrame([], _DOCUMENTS)
    paths = None
    for kind in kinds:
        each = _files(spark, path, kind).select("part", F.col("path").alias(kind))
        paths = each if paths is None else paths.join(each, "part")
    dtype = f"<u{width}"

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tokens, offsets, docs in zip(*(batch[kind] for kind in kinds), strict=True):
                ids, starts = memory_map(tokens, dtype), memory_map(offsets, "<i8")
                keys, lengths = memory_map(docs, "<i8").reshape(-1, 2).T
                first = int(starts[0])
                crcs = [
                    crc32_of_u32(ids[start - first : start - first + length].tobytes(), dtype)
                    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True)
                ]
                yield pd.DataFrame(
                    {"doc_id": keys, "start": starts, "n_tokens": lengths, "ids_crc32": crcs}
                )

    read = paths.repartition(n, "part").mapInPandas(documents, _DOCUMENTS)
    return read.withColumn("doc_id", id_or_null("doc_id"))


def memory_map(path: str, dtype: str) -> np.ndarray:
    """A file of the folder as an array, mapped where its file system allows it."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return np.memmap(unquote(url.path), dtype=dtype, mode="r")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as file:
        return np.frombuffer(file.read_buffer(), dtype=dtype)
