"""One query per operator over the whole given tables, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chuvisco.llm.archives import archived_pages
from chuvisco.llm.fingerprints import fingerprint_documents
from chuvisco.llm.jaccard import near_duplicates
from chuvisco.llm.language import identify
from chuvisco.llm.manifest import audit
from chuvisco.llm.oracles import OP11, OP12, OP13
from chuvisco.llm.packing import pack_documents
from chuvisco.llm.pieces import segment_documents
from chuvisco.llm.ranking import rank_documents
from chuvisco.llm.scoring import score_documents
from chuvisco.llm.search import top_products
from chuvisco.llm.secrets import scan_secrets
from chuvisco.llm.suffixes import remove_repeats
from chuvisco.llm.token_counts import token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_secret_scans": op3_secret_scans,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_sentencepiece_dropout": op7_sentencepiece_dropout,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc": op12_warc,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op5_exact_top_k": """
        WITH proper AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, max(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))) AS s
            FROM proper AS q JOIN proper AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank, vec_id, s FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(s AS BIGINT) AS score FROM ranked WHERE rank <= 10
    """,
    "op11_merkle_manifest": OP11,
    "op12_warc": OP12,
    "op13_ranked_search": OP13,
}
