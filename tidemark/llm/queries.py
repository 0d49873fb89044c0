"""The queries of these operators by name, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations,
    decontaminate,
    html_extract,
    line_dedup,
    packing,
    quality,
    shards,
    simhash,
    token_files,
    toxicity,
    url_filter,
    vector_search,
    whitening,
)
from tidemark.llm.common import id_of, id_or_null, id_remainder, table
from tidemark.session import pin_utc, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(run: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(pin_utc(spark), sf_dir)

    _QUERIES[run.__name__] = in_utc
    return in_utc


@_query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return token_files.read_token_files(spark, path)


@_query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learnt from labels of rows outside fold 0 of 5, and from unlabelled texts."""
    good = table(spark, sf_dir, "labels").where("quality = 1").where(id_remainder("doc_id", 5) > 0)
    model, _ = quality.train(docs, good.select(F.col("doc_id").alias("id")))
    return model


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), keep=["doc_id"])
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query
def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shards.byte_shards(table(spark, sf_dir, "documents"), 40, overhead=16)
    return sharded.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The CRC-32 is that of the reflected polynomial EDB88320, its table being made by rule.
ORACLES["op4_byte_shards"] = """
WITH crc_table AS (
  SELECT list(entry ORDER BY i) AS entries
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
                              lambda c, k: xor(c // 2, (c % 2) * 3988292384)) AS entry
        FROM (SELECT unnest(range(256)) AS i))
),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
codes AS (
  SELECT doc_id, strlen(text) + 16 AS size,
         list_transform(range(strlen(text)),
                        lambda i: ('0x' || substr(hex(text), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM texts
),
rows_ AS (
  SELECT doc_id, size,
         xor(list_reduce(list_prepend(4294967295, bytes),
                         lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM codes, crc_table
),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS first_byte,
         sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id, text_crc32, size) AS rank
  FROM rows_
),
sharded AS (
  SELECT *, least(39, (2 * first_byte + size) * 40 // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (rank - min(rank) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM sharded
"""


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer, end_id=1)
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@_query
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of a benchmark item, one row per document and item."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row_id").alias("doc_id"), "item_id", "doc_start", "item_start", "n_words", "n_matched"
    )


_AHEAD = ", ".join(
    f"lead(word, {at}) OVER (PARTITION BY kind, id ORDER BY pos) AS w{at}"
    for at in range(1, decontaminate.SPAN)
)
_SEEDS = ", ".join(
    "concat_ws(' ', "
    + ", ".join([str(number), *(f"w{at}" for at, chosen in enumerate(mask) if chosen == "1")])
    + ")"
    for number, mask in enumerate(decontaminate.MASKS)
)
ORACLES["op6_benchmark_leaks"] = f"""
WITH split_texts AS (
  SELECT 'd' AS kind, doc_id AS id, lower(coalesce(text, '')) AS text FROM documents
  UNION ALL SELECT 'i', item_id, lower(coalesce(text, '')) FROM benchmark
),
texts AS (
  SELECT kind, id, list_filter(regexp_split_to_array(text, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words
  FROM split_texts
),
words AS (SELECT kind, id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM texts),
ahead AS (SELECT kind, id, pos, word AS w0, {_AHEAD} FROM words),
windows AS (
  SELECT kind, id, pos, unnest([{_SEEDS}]) AS seed
  FROM ahead WHERE w{decontaminate.SPAN - 1} IS NOT NULL
),
hits AS (
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.pos - i.pos AS shift, i.pos AS pos, {decontaminate.SPAN} AS span
  FROM windows d JOIN windows i ON d.kind = 'd' AND i.kind = 'i' AND d.seed = i.seed
  UNION ALL
  SELECT DISTINCT w.id, i.id, w.pos, 0, len(i.words)
  FROM texts i JOIN words w ON w.kind = 'd' AND w.word = i.words[1]
  JOIN texts d ON d.kind = 'd' AND d.id = w.id
  WHERE i.kind = 'i' AND len(i.words) < {decontaminate.SPAN}
    AND list_slice(d.words, w.pos + 1, w.pos + len(i.words)) = i.words
),
pairs AS (
  SELECT doc_id, item_id, shift, min(pos) AS first, max(pos + span) AS last FROM hits GROUP BY ALL
),
agreeing AS (
  SELECT doc_id, item_id, shift, first, last, i.pos, coalesce(d.word = i.word, false)::INTEGER AS same,
         sum(same) OVER (PARTITION BY doc_id, item_id, shift ORDER BY i.pos) AS upto
  FROM pairs JOIN words i ON i.kind = 'i' AND i.id = item_id
  LEFT JOIN words d ON d.kind = 'd' AND d.id = doc_id AND d.pos = i.pos + shift
),
counted AS (
  SELECT doc_id, item_id, shift, first, last, count(*) AS size, sum(same) AS n_matched,
         sum(same) FILTER (WHERE pos >= first AND pos < last) AS near
  FROM agreeing GROUP BY ALL
),
enough AS (SELECT * FROM counted WHERE n_matched >= least(13, ceil(size * 0.8))),
parts AS (
  SELECT e.doc_id, e.item_id, e.shift, e.n_matched, a.pos AS first, b.pos + b.span AS last
  FROM enough e
  JOIN hits a ON a.doc_id = e.doc_id AND a.item_id = e.item_id AND a.shift = e.shift
  JOIN hits b ON b.doc_id = e.doc_id AND b.item_id = e.item_id AND b.shift = e.shift AND b.pos >= a.pos
  JOIN agreeing x ON x.doc_id = e.doc_id AND x.item_id = e.item_id AND x.shift = e.shift AND x.pos = a.pos
  JOIN agreeing y ON y.doc_id = e.doc_id AND y.item_id = e.item_id AND y.shift = e.shift AND y.pos = b.pos + b.span - 1
  WHERE e.near < (e.last - e.first) * 0.8 AND y.upto - x.upto + x.same >= (b.pos + b.span - a.pos) * 0.8
),
stretches AS (
  SELECT doc_id, item_id, shift, n_matched, first, last FROM enough WHERE near >= (last - first) * 0.8
  UNION ALL SELECT * FROM parts
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
                               ORDER BY n_matched DESC, last - first DESC, first + shift, first) AS place
  FROM stretches
)
SELECT doc_id, item_id, (first + shift)::INTEGER AS doc_start, first::INTEGER AS item_start,
       (last - first)::INTEGER AS n_words, n_matched::INTEGER AS n_matched
FROM ranked WHERE place = 1
"""


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLES["op7_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
firsts AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
marked AS (
  SELECT doc_id, line, pos, first_id IS NOT NULL AND doc_id > first_id AS gone
  FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, F.col("id") % 100 == 0, k=10)


@_query
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_distance=4)
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~id_remainder("doc_id", 4).isin(-1, 2))
    scorer = toxicity.train(docs, labels.select(F.col("doc_id").alias("id"), "toxic"))
    return toxicity.score(docs, scorer).select(
        F.col("id").alias("doc_id"),
        (id_remainder("id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(whole))
    every = whole.select(id_of("conv_id").alias("conv")).distinct()
    found = every.join(repaired.summary, "conv", "left").join(
        conversations.text_digests(repaired.rows), "conv", "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.withColumnRenamed("conv", "conv_id").select(
        id_or_null("conv_id"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


# The rules of op12, as host, path and verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@_query
def op12_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    judged = url_filter.judge(table(spark, sf_dir, "pages"), rules)
    return judged.withColumnRenamed("id", "page_id")


ORACLES["op12_url_verdicts"] = f"""
WITH rests AS (
  SELECT row_number() OVER () AS row, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT row, page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM rests
),
rules (rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM ranked WHERE place = 1
"""


@_query
def op13_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64)
    return whitened.withColumnRenamed("id", "vec_id")
