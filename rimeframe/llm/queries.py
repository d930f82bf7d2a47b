"""One query per operator, over its whole table."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimeframe.llm import (
    decontaminate, huffman, langid, packing, sampling, secrets, simhash, spelling, substrings,
    token_counts, toxicity, vector_codes, warc,
)
from rimeframe.llm.registry import ORACLES, QUERIES, query, table
from rimeframe.llm.shared import fold

__all__ = ["ORACLES", "QUERIES"]


@query("op2_warc", """
    with rows as (
      select page_id, coalesce(html, '') as body from pages
    ), keyed as (
      select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest from rows
    ), firsts as (
      select *, min(page_id) over (partition by payload_digest) as first_page from keyed
    )
    select page_id, payload_bytes, payload_digest,
      case when payload_bytes >= 100 and page_id > first_page then 'revisit' else 'response' end
        as record_type,
      case when payload_bytes >= 100 and page_id > first_page then first_page end as refers_to
    from firsts
""")
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op4_langid")
def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold("doc_id", 4) == 2
    contents = langid.learn(docs.filter(langid.learnable(held_out)))
    scored = langid.identify(docs.select("doc_id", "text"), contents)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        "lang_pred",
        "score",
        "margin",
        "rejected",
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op7_secrets", secrets.sql())
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    base = secrets.base_spans(F.col("spans"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


@query("op5_huffman")
def op5_huffman(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = huffman.write_files(table(spark, folder, "documents"), path)
    return huffman.read_files(files, with_ids=False).drop("ids")


@query("op10_weighted_sampling")
def op10_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.edit_study(table(spark, folder, "documents"))


@query("op8_substrings")
def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digests(table(spark, folder, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    model = toxicity.learn(docs, labels.filter(~held_out))
    span = F.transform("spans", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string")))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(span, ",").alias("spans"),
    )


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), path)


@query("op1_latent_leaks")
def op1_latent_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(table(spark, folder, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op12_spelling", spelling.sql())
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query("op11_vector_codes", vector_codes.sql())
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = vector_codes.encode(table(spark, folder, "embeddings"))
    digest = hashlib.sha256(vector_codes.codebooks_text(books).encode()).hexdigest()
    return vector_codes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
