"""Cases where hashes or ranks meet: they decide nothing, or always the same way."""

import os
import sys
import time

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import by_id, documents  # noqa: E402

from rimeframe.llm import decontaminate, langid, sampling, secrets, substrings, toxicity  # noqa: E402


def test_equal_ranks_go_by_hash():
    """Whichever of two tied words a task met first, their text has one fingerprint."""
    words = [f"w{i}" for i in range(30_000)]
    known = sampling.Sampler()
    known([" ".join(words)])
    ties = []
    for sample in range(known.samples):
        ranks = known.once[: len(words), sample]
        order = np.argsort(ranks, kind="stable")
        same = np.flatnonzero(np.diff(ranks[order]) == 0)
        names = [w.decode() for w in known.rows]
        ties += [(names[order[i]], names[order[i + 1]]) for i in same.tolist()]
    assert ties
    for one, two in ties[:40]:
        signatures = []
        for first in (one, two):
            fresh = sampling.Sampler()
            fresh([first])
            signatures.append(fresh([f"{one} {two}"])[0].tolist())
        assert signatures[0] == signatures[1]


def test_quarters_that_agree_in_forty_bits(spark):
    """Windows whose last 15 words are equal and whose first five have nearly equal hashes differ."""
    rng = np.random.default_rng(1)
    words = [f"q{i}" for i in range(3000)]
    hashes = np.array([substrings._Hashes()[w.encode()] for w in words], dtype=np.uint64)
    picks = rng.integers(0, len(words), (1_500_000, 5))
    total = (hashes[picks] * substrings.ODD[:5]).sum(axis=1, dtype=np.uint64)
    key = substrings._mixed(total)
    short = ((key >> np.uint64(40)) % np.uint64(16) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))
    order = np.argsort(short, kind="stable")
    meet = np.flatnonzero(np.diff(short[order]) == 0)
    pairs = [(order[i], order[i + 1]) for i in meet if (picks[order[i]] != picks[order[i + 1]]).any()]
    assert pairs
    texts = []
    for k, (a, b) in enumerate(pairs[:10]):
        tail = " ".join(f"t{k}x{i}" for i in range(15))
        texts += [" ".join(words[i] for i in picks[x]) + " " + tail for x in (a, b, b)]
    found = by_id(substrings.digests(documents(spark, texts)), "n_words", "n_removed")
    assert [found[i] for i in range(len(texts))] == [(20, 0), (20, 0), (20, 20)] * (len(texts) // 3)


LEAK = "the quick brown fox jumps over the lazy dog while seven wizards brew potions? they sing all night long"


def test_rows_without_id_are_told_apart(spark):
    clean = "rain fell on the old harbour town and nobody noticed that the boats had already gone to sea again"
    docs = documents(spark, [LEAK, clean, clean + " twice", LEAK, None], ids=[None, None, 7, 7, None])
    benchmark = spark.createDataFrame([(None, LEAK), (3, LEAK), (None, None), (4, "")], "item_id long, text string")
    hits = decontaminate.find_leaks(docs, benchmark)
    assert "text_hash" not in hits.columns
    assert sorted(map(str, {(r["doc_id"], r["item_id"]) for r in hits.collect()})) == sorted(
        map(str, {(None, None), (None, 3), (7, None), (7, 3)}))
    left = decontaminate.remove_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r["text"] or "") for r in left.collect()) == ["", clean, clean + " twice"]


def test_a_marker_far_inside_a_text_is_learnt(spark):
    """The fit reads whole texts: the only toxic word stands behind 6,000 characters."""
    filler = [" ".join(f"word{(i * 7919 + k * 31) % 50_000}" for k in range(1000)) for i in range(60)]
    texts = [f"{x} {'vileword' if i % 2 else 'calmword'} end" for i, x in enumerate(filler)]
    assert min(map(len, texts)) > 6000
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    scores = by_id(toxicity.score(documents(spark, ["a vileword here", "a calmword here"]), model), "score")
    assert scores[0][0] > scores[1][0]


def test_language_samples_are_whole_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "CONTENT_CHARS", 50)
    monkeypatch.setattr(langid, "LONG", 40)
    texts = ["same text"] * 30 + [f"text number {i} of many" for i in range(20)] + ["long " * 20, None, "solo " * 30]
    langs = ["a"] * 51 + ["a", "b"]
    docs = documents(spark, texts, langs=langs)
    rows = langid.training_texts(docs).collect()
    own = [r["text"] for r in rows if r["lang"] == "a"]
    assert len(set(own)) == len(own) and set(own) <= set(texts) and "long " * 20 not in own
    assert 50 <= sum(map(len, own)) < 50 + 40
    assert [r["text"] for r in rows if r["lang"] == "b"] == ["solo " * 30]


def test_redaction_of_many_spans(spark):
    """Time grows with the text and its spans, not with their product; other characters stay in place."""
    text = "é日 " + " ".join(f"token=abcdef{i} 😀" for i in range(20_000)) + " tail"
    docs = documents(spark, [text, "none é", None, "token=abcdefg token=abcdefg"])
    secrets.redact(docs.limit(1)).collect()
    began = time.time()
    out = by_id(secrets.redact(docs), "text")
    assert time.time() - began < 20
    assert out[0][0] == "é日 " + " ".join(["[SECRET] 😀"] * 20_000) + " tail"
    assert (out[1][0], out[2][0], out[3][0]) == ("none é", None, "[SECRET] [SECRET]")
