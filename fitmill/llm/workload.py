"""The registered queries of these operators over the given tables, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmill.llm import (alignment, conversations, decontaminate, mixing, neardup, quality, sharding, substring_dedup, suffix_dedup,
                         tokens, topk, toxicity, warc)
from fitmill.llm.shared import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_class")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = warc.write_streams(warc.with_revisits(table(spark, sf_dir, "pages")))
    return warc.read_records(warc.normalise(streams)).drop("payload")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokens.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read(files)


def op10_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment(alignment.links(table(spark, sf_dir, "documents"), *paths))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.digests(given, conversations.repaired(conversations.damaged(given)))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.sharded(table(spark, sf_dir, "documents"), 16)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = sharding.numbered(shards.withColumn("text_crc32", crc).drop("text"))  # texts needn't pass the numbering's exchange
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_near_duplicates, op3_suffix_dedup, op4_substring_dedup, op5_source_mix, op6_decontamination, op7_quality, op8_warc_normaliser, op9_token_files, op10_top_vectors,
                                  op11_token_alignment, op12_conversation_repair, op13_sharding)}
SQL: dict[str, str] = {
    "op8_warc_normaliser": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
                   FROM pages),
        f AS (SELECT *, CASE WHEN payload_bytes >= 1000
                             THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
        FROM f
    """,
    "op10_top_vectors": """
        WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
                  FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
                   FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
