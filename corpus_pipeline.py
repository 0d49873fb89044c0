"""From raw documents to packed token sequences, in five stages.

1. quality classifier: documents scored below 0.3 go;
2. line dedup: lines that an earlier document holds go from the later ones;
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents that hold a benchmark passage go;
5. packing: token sequences of at most 2048 ids.

Each stage but the last returns the columns of ``documents``; its result is written as Parquet
and read again as the next one's input. Rows with null texts or ids and empty texts pass through
every stage as its operator defines it. Columns may be called anything, and ``n_chars`` may be
missing.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, packing, quality, simhash
from tidemark.llm.common import free_name, numbered, place, table
from tidemark.llm.queries import quality_model
from tidemark.session import scratch_dir

LEAST_SCORE = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs.columns, "score")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), score_column=name)
    return scored.where(F.col(f"`{name}`") >= LEAST_SCORE).drop(name)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses lines has the length of what is left."""
    left = line_dedup.drop_repeated_lines(docs)
    rows = numbered(left)
    kept, _, n_dropped = rows.columns[-3:]
    lost = F.col(n_dropped) > 0
    changed = {place(docs, "text"): F.col(kept)}
    if "n_chars" in docs.columns:
        changed[place(docs, "n_chars")] = F.char_length(kept).cast("long")
    columns = [
        F.when(lost, changed[name]).otherwise(F.col(name)) if name in changed else F.col(name)
        for name in numbered(docs).columns
    ]
    return rows.select(*columns).toDF(*docs.columns)


def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs, width=4, max_distance=4)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, tokenizer, end_id=1).withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_simhash),
    ("benchmark decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]

# Scores, XXH64 fingerprints and tokenizers have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
