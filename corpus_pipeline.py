"""A cleaning pipeline over ``documents``: each stage takes what the one before it kept.

``STAGES`` names the stages in order. Each function takes ``(spark, docs, sf_dir)`` and returns a frame with the columns
of ``documents``; the last returns the places of all pieces in sequences. ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chuvisco.llm.jaccard import without_near_duplicates
from chuvisco.llm.language import keep_identified, learned
from chuvisco.llm.packing import pack_documents
from chuvisco.llm.secrets import redact
from chuvisco.llm.shared import stored
from chuvisco.llm.suffixes import without_repeats

#: Bytes of a passage that may not stand twice: fewer than fifty words have.
PASSAGE = 200


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text, without a letter or in none of the learned languages go."""
    return keep_identified(docs, learned(docs.select("doc_id", "text", "lang")))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, a similarity of 0.8), the one of the smallest key; a null key comes
    last. Of repeated rows one stays. Null and empty texts have no copies but rows equal in key and text."""
    return without_near_duplicates(docs, words=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand anywhere else, in other documents or the same one. All rows stay; null texts stay
    null, empty ones empty, and a text that is nothing but repeats becomes empty."""
    return _counted(without_repeats(docs, PASSAGE))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked, also those in inner layers. All rows stay; null texts stay null, empty ones empty."""
    return _counted(redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_array_dedup", suffix_array_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: No stage can be put in SQL; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
