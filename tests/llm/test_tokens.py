"""Tokenizing, op5, op6 against the tokenizers library and exact round trips."""

import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import documents  # noqa: E402

from rimeframe.llm import huffman, packing, tokens  # noqa: E402
from rimeframe.llm.tokens import encoder  # noqa: E402

WORD, BYTE = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [None, "", " ", "one", "Two words, it's", "a  b   c\n\nd ", "é ́ İ ß 日本 😀<|endoftext|>",
         "long " * 9000, "x" * 5000, "same text", "same text"]


FRESH = {path: Tokenizer.from_file(path) for path in (WORD, BYTE)}


def ids_of(path, text):
    """By the library alone, with a tokenizer that the encoder has not touched."""
    found = FRESH[path].encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 1], dtype="<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBé .,'\n\t\x85 ́İ1²日-"), max_size=30),
                max_size=5))
def test_pieces_equal_whole_texts(path, texts):
    encode = encoder(path)
    got = [np.frombuffer(x, "<u2").tolist() for x in encode.stream(texts)]
    assert got == [ids_of(path, t).tolist() for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=3000))
def test_blocks_round_trip(values):
    ids = np.array(values)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=400))
    assert lengths.max() <= huffman.LONGEST
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1.0
    block = huffman.encode_block(ids, lengths, huffman.canonical_codes(lengths))
    assert huffman.decode_block(block, huffman.decode_table(lengths)).tolist() == values


def test_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 4, 8, 16, 32, 64])
    assert (huffman.code_lengths(counts) * counts).sum() == 254
    steep = np.array([1 << min(i, 40) for i in range(30)])
    limited = huffman.code_lengths(steep, 8)
    assert limited.max() <= 8 and sum(2.0 ** -int(x) for x in limited) == 1.0


def test_files(spark):
    ids = [10, 3, 7, None, 1, 22, 5, 8, 2, 30, 30]
    docs = documents(spark, TEXTS, ids=ids).repartition(3)
    rows = huffman.read_files(huffman.write_files(docs, WORD)).collect()
    order = sorted(zip(ids, TEXTS, strict=True), key=lambda x: -1 if x[0] is None else x[0])
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [i for i, _ in order]
    start = 0
    for row, (_, text) in zip(rows, order, strict=True):
        want = ids_of(WORD, text)
        assert (row["start"], row["n_tokens"]) == (start, len(want))
        assert row["ids_crc32"] == zlib.crc32(want.tobytes())
        assert bytes(row["ids"]) == want.tobytes()
        start += len(want)
    assert huffman.read_files(huffman.write_files(documents(spark, []), WORD)).count() == 0


def test_packing(spark):
    random.seed(1)
    texts = TEXTS[:9] + [" ".join(random.choice("the of in cat dog sun".split())
                              for _ in range(random.randint(1, 900))) for _ in range(40)]
    docs = documents(spark, texts).repartition(3)
    rows = packing.pack(docs, BYTE).collect()
    pieces = {}
    sequences = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(range(len(texts)))
    for i, text in enumerate(texts):
        want, at = ids_of(BYTE, text), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want)
            assert r["ids_crc32"] == zlib.crc32(want[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(want)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(documents(spark, []), BYTE).count() == 0


def test_neighbours_come_first():
    tails = [np.array([1, 2, 3] * 5), np.array([7, 8, 9] * 5), np.array([1, 2, 4] * 5)]
    index = packing.Index(tails, np.ones(10), 15.0)
    scores = index.scores(0)
    assert scores[2] > scores[1] == 0
    sequences = packing.fill([15, 15, 15], index, window=32)
    assert sequences[0] == [(0, 0, 15), (2, 0, 15), (1, 0, 2)]
    assert [sum(x[2] for x in s) for s in sequences[1:]] == [8, 4, 1]


def test_scores_equal_brute_force():
    random.seed(2)
    tails = [np.array([random.randint(0, 30) for _ in range(random.randint(1, 60))])
             for _ in range(20)]
    idf = np.array([random.random() for _ in range(31)])
    index = packing.Index(tails, idf, 25.0)
    for i, query in enumerate(tails):
        for j, scored in enumerate(index.scores(i)):
            want = 0.0
            for t in set(query.tolist()):
                tf = (tails[j] == t).sum()
                norm = packing.K1 * (1 - packing.B + packing.B * len(tails[j]) / 25.0)
                want += idf[t] * tf * (packing.K1 + 1) / (tf + norm)
            assert abs(scored - want) < 1e-9


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_are_those_of_the_file(path):
    fresh = Tokenizer.from_file(path)
    texts = ["see <|endoftext|> here", "a<|startoftext|>b\n<|endoftext|>", "<|ENDOFTEXT|> no", "see here"]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder(path).stream(texts)]
    assert got == [[*fresh.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert fresh.token_to_id("<|endoftext|>") in got[0]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_usual_texts_are_joined_from_arrow_arrays(path, monkeypatch):
    """Texts of single spaces and lone line ends never take the way text by text, and known pieces are not encoded."""
    encode = tokens.Encoder(path)

    def refuse(*_):
        raise AssertionError("text by text")

    texts = ["one two  three.\nfour é日", "", None, " lead and trail ", "x", "one two\nfour"]
    with monkeypatch.context() as m:
        m.setattr(tokens.Encoder, "__call__", refuse)
        m.setattr(tokens, "BYTES_AT_ONCE", 20)
        got = [np.frombuffer(x, "<u2").tolist() for x in encode.stream(texts)]
        m.setattr(tokens.Encoder, "_marked", refuse)
        assert [np.frombuffer(x, "<u2").tolist() for x in encode.stream(texts[::-1])] == got[::-1]
    assert got == [ids_of(path, x).tolist() for x in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_usual_and_unusual_texts_keep_their_order(path, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_TEXT", 40)
    monkeypatch.setattr(tokens, "KNOWN_BYTES", 64)
    texts = ["a b", "a\n\nb", "c <|endoftext|>", "b " * 30, "d\te", None, "a   b", "\na", "a b", "a  b"] * 2
    parts = list(tokens.Encoder(path).packed(pa.array(texts).slice(1)))
    got = [np.frombuffer(x.as_py(), "<u2").tolist() for part in parts for x in part]
    assert got == [ids_of(path, x).tolist() for x in texts[1:]]


def test_sketches_and_document_counts_equal_those_of_each_document(spark):
    docs = [[1], [7, 7, 9, 1], [5, 1], [1], [9, 9, 9, 9, 1]]
    bounds = np.cumsum([0, *map(len, docs)])
    found = tokens.sketches(np.concatenate(docs).astype("<u2"), bounds)
    assert found.tolist() == [tokens.sketches(np.array(x, "<u2"), np.array([0, len(x)]))[0] for x in docs]
    rows = spark.createDataFrame([(np.array(x, "<u2").tobytes(),) for x in docs], "ids binary")
    counted = tokens.id_counts(rows, "<u2", of_documents=True).collect()
    assert {r["id"]: r["n"] for r in counted} == {1: 5, 5: 1, 7: 1, 9: 2}
