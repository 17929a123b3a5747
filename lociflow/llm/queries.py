"""The thin ``opN_<name>`` queries with production parameters, and SQL where it can say the same.

Each query applies its operator to a whole table of the given folder and derives the
digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import decontam, html_text, interval_join, jaccard, langid, mixing, prefix_trie, quality, sharding, suffix, tokens, topk, toxicity
from lociflow.llm.common import id_bucket


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 3) == 1
    dictionaries = langid.fit_dictionaries(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), dictionaries).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.context_table(tokens.length_histogram(tokens.encoded_lengths(_read(spark, sf_dir, "documents"))))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_selection(docs)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_digest(_read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(_read(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "class_size", "n_links")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.fit_weights(pages)).select("page_id", "url", "text", "n_chars")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_digest(decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_digest(prefix_trie.conversation_trie(_read(spark, sf_dir, "conversations")))


def op12_feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval_join.feature_digest(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.embedding_top_k(_read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_toxicity, op2_sharding, op3_language_id, op4_token_counts, op5_mixing, op6_quality_rules, op7_suffix_dedup, op8_jaccard_join, op9_html_text, op10_decontamination, op11_prefix_trie, op12_feature_join, op13_top_k)
    }


def _sharding_sql(n_shards: int = 24) -> str:
    return f"""
WITH k AS (SELECT doc_id, text, CAST(coalesce(strlen(text), 0) + {sharding.ROW_BYTES} AS BIGINT) AS size,
                  ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS h, coalesce(doc_id, -1) AS d FROM documents),
b AS (SELECT *, coalesce(sum(size) OVER (ORDER BY h, d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS below,
             sum(size) OVER () AS total FROM k),
s AS (SELECT *, CAST(below * {n_shards} // total AS INTEGER) AS shard FROM b)
SELECT doc_id, size, {{crc}} AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, d) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that DuckDB can express (crc32 has no SQL function, so sharding has none)."""
    return {
        "op5_mixing": mixing.mixing_sql(),
        "op6_quality_rules": quality.quality_sql(),
        "op11_prefix_trie": prefix_trie.trie_sql(),
        "op12_feature_join": interval_join.feature_sql(),
        "op13_top_k": topk.top_k_sql(),
    }
