"""The corpus pipeline: five stages over documents, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.llm import decontaminate, langid, packing, secrets, simhash
from rimeframe.llm.shared import fold
from rimeframe.storage import fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart; others go."""
    contents = langid.learn(docs.filter(langid.learnable(fold("doc_id", 4) == 2)))
    scored = langid.identify(docs, contents)
    return scored.filter("not rejected").select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest doc_id, of each group of near copies."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced, and n_chars to match."""
    cleaned = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    size = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
    return cleaned.withColumn("n_chars", size)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("simhash_dedup", distinct_documents),
    ("decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Compression, latent retrieval and tokenizing cannot be said in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
