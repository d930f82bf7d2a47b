"""op13 against the tokenizers library."""

import os
import sys

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import by_id, documents  # noqa: E402

from rimeframe.llm import token_counts as tc  # noqa: E402
from rimeframe.llm.queries import QUERIES  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(BYTE)
OWN = tc.Lengths(BYTE, {" the": 1, ".": 1})
TEXTS = [None, "", " ", "one", "Two words, it's", "a  b   c\n\nd ", "é ́ İ ß 日本 😀<|endoftext|>",
         "long " * 9000, "x" * 5000, "same text", "same text", "²x Ⅷ_a \x1c\x1d ٣", "they'll 'S <|endoftext|> x"]


def expected(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBé .,'stre\n\t\x85 ́İ1²日-_Ⅷ\x1c ᠎"), st.characters(
    exclude_categories=["Cs"])), max_size=40))
def test_pieces_equal_whole_texts(text):
    assert OWN.count(text) == expected(text)


def test_texts_cut_piecewise(monkeypatch):
    monkeypatch.setattr(tc, "LONG_TEXT", 10)
    monkeypatch.setattr(tc, "PIECES_AT_ONCE", 3)
    text = "Some words, it's 12 of  them;\n\n and more "
    assert OWN.count(text) == expected(text)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "CACHE_BYTES", 10 * tc.ENTRY_BYTES)
    own = tc.Lengths(BYTE)
    text = " ".join(f"w{i}ord" for i in range(200))
    assert own.count(text) == expected(text)
    assert len(own.cache) <= 10


def test_table_round_trip():
    table = {" the": 1, "é日": 4, ".": 1, " " * 32: 300}
    assert tc.unpack(tc.pack(table)) == table
    assert tc.unpack(tc.pack({})) == {}


@pytest.mark.parametrize("table", [None, {}])
def test_counts_and_defined_cases(spark, table):
    docs = documents(spark, TEXTS, ids=[None, *range(len(TEXTS) - 1)]).selectExpr(
        "*", "1 as n_tokens", "2 as piece")
    out = tc.count_tokens(docs, BYTE, table)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens"]
    found = by_id(out, "n_bytes", "n_tokens")
    assert found == {
        i: (len((t or "").encode()), expected(t))
        for i, t in zip([None, *range(len(TEXTS) - 1)], TEXTS, strict=True)
    }
    assert tc.count_tokens(docs.limit(0), BYTE, table).count() == 0


def test_frequent_table_counts_all_texts(spark):
    docs = documents(spark, ["rare"] * 3 + ["common words here"] * 50 + [None])
    table = tc.frequent_lengths(docs, BYTE, size=3)
    assert set(table) == {" common", " words", " here"}
    assert all(n == expected(x) for x, n in table.items())


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = by_id(QUERIES["op13_token_counts"](spark, sf), "n_bytes", "n_tokens", "over_limit")
    want = {r["doc_id"]: (len((r["text"] or "").encode()), expected(r["text"])) for r in docs}
    assert found == {i: (a, n, n > 1024) for i, (a, n) in want.items()}
