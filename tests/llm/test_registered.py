"""Registered queries of this subpackage against their SQL, and the pipeline's decisions."""

import os
import sys

import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from rimeframe.llm import decontaminate, langid, packing, secrets, simhash  # noqa: E402
from rimeframe.llm.queries import ORACLES, QUERIES  # noqa: E402
from tools.check_queries import compare  # noqa: E402


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), ORACLES[name], sf) == ""


@pytest.mark.parametrize("name, columns", [
    ("op3_toxicity", ["doc_id", "held_out", "score", "predicted"]),
    ("op4_langid", ["doc_id", "held_out", "lang_pred", "score"]),
    ("op5_huffman", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    ("op8_substrings", ["doc_id", "n_words", "n_removed", "kept_sha256"]),
    ("op9_simhash", ["doc_id", "fingerprint", "component_id"]),
    ("op10_weighted_sampling", ["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                "edited_fingerprint", "near_edited", "near_next"]),
])
def test_one_row_per_document(spark, sf, name, columns):
    out = QUERIES[name](spark, sf)
    assert out.columns[: len(columns)] == columns
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(ids) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark, sf):
    """Each stage does what its operator says of its own input, and leaves other rows as they are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "decontamination", "secret_scan", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        if name == "packing":
            lengths = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(
                {"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
            whole = packing.token_ids(before, public_tokenizers.path("byte_bpe_50k.json"))
            assert lengths == {r["doc_id"]: r["n_tokens"] for r in whole.collect()}
            continue
        assert after.columns == docs.columns
        rows = {r["doc_id"]: r for r in before.collect()}
        left = {r["doc_id"]: r for r in after.collect()}
        if name == "language_id":
            contents = langid.learn(before.filter(langid.learnable(
                corpus_pipeline.fold("doc_id", 4) == 2)))
            gone = {r["doc_id"] for r in langid.identify(before, contents).collect()
                    if r["rejected"]}
        elif name == "simhash_dedup":
            groups = simhash.groups(before).collect()
            gone = {r["doc_id"] for r in groups if r["doc_id"] != r["component_id"]}
        elif name == "decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            gone = {r["doc_id"] for r in decontaminate.find_leaks(before, bench).collect()}
        else:
            gone = set()
            for r in secrets.scan(after).collect():
                assert not [s for s in r["spans"] if s["kind"] in (1, 2)]
        assert set(left) == set(rows) - gone
        if name != "secret_scan":
            assert all(left[i] == rows[i] for i in left)
        before = after
