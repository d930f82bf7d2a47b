"""op1, op2, op3, op4, op9, op10 on small tables, against brute force or planted cases."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import by_id, documents  # noqa: E402

from rimeframe.llm import decontaminate, langid, sampling, simhash, toxicity, warc  # noqa: E402
from rimeframe.llm.shared import components  # noqa: E402

ODD = [None, "", "   \n", "a", "word " * 4000, "12 34 %%", "same text here", "same text here"]


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# --- op2 ---------------------------------------------------------------------------------------

def test_archives(spark):
    big, other = "<p>" + "x" * 200 + "</p>", "é" * 300
    pages = spark.createDataFrame(
        [(3, "http://a/1", big, "f"), (1, "http://a/2", big, "f"), (9, "http://a/3", big, "f"),
         (4, None, None, "f"), (5, "http://b/ x\r\nEvil: 1", "", "f"), (6, "u", "short", "f"),
         (7, "u", "short", "f"), (8, "u", other, "f"), (1, "http://a/2", big, "f"),
         (None, "n", big, "f"), (11, "long", "y" * 3_000_000, "f")],
        "page_id bigint, url string, html string, file string").repartition(3)
    index = warc.write_archives(pages)
    rows = warc.read_records(index).collect()
    assert len(rows) == 11
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in rows)
    assert kinds == [
        (-1, "revisit", 1), (1, "response", None), (1, "response", None), (3, "revisit", 1),
        (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None),
        (8, "response", None), (9, "revisit", 1), (11, "response", None)]
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in rows:
        body = html[r["page_id"]].encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (
            len(body), hashlib.sha256(body).hexdigest())
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == body
    one = warc.read_records(index.filter("page_id = 8")).collect()
    assert [bytes(r["payload"]).decode() for r in one] == [other]
    assert warc.read_records(warc.write_archives(pages.filter("1 = 0"))).count() == 0


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 110, 10)]
    assert [len(x) for x in warc._ranges(iter(rows), gap=5, most=1000)] == [3, 1, 1]
    assert [len(x) for x in warc._ranges(iter(rows), gap=5, most=20)] == [2, 1, 1, 1]


# --- op4 ---------------------------------------------------------------------------------------

def test_languages(spark):
    rng = random.Random(4)
    words = {"aa": ["mela", "volo", "riga", "tena"], "bb": ["krash", "zumt", "plogh", "grist"]}
    texts = [prose(rng, words[lang], 30) for lang in ("aa", "bb") for _ in range(40)] + ODD
    langs = ["aa"] * 40 + ["bb"] * 40 + [None] * len(ODD)
    docs = documents(spark, texts, langs=langs)
    contents = langid.learn(docs.filter("doc_id % 4 <> 2"))
    assert sorted(contents) == ["aa", "bb"]
    out = langid.identify(docs, contents)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = by_id(out, "lang_pred", "score", "rejected")
    assert all(got[i][0] == langs[i] and not got[i][2] for i in range(80))
    assert all(0 <= x[1] <= 1 for x in got.values())
    assert [got[80 + i][0] for i in (0, 1, 2, 5)] == ["und"] * 4
    assert got[80][2] and got[83][0] in ("aa", "bb")
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(documents(spark, []), contents).count() == 0
    assert langid.learn(documents(spark, [])) == {}


# --- op9 ---------------------------------------------------------------------------------------

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_groups(ids, values, distance):
    root = dict(zip(ids, ids, strict=True))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                a_, b_ = find(ids[i]), find(ids[j])
                root[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = list(ODD)
    for _ in range(12):
        base = prose(rng, words, 200).split()
        for _ in range(5):
            own = list(base)
            own[rng.randrange(200)] = "EDIT"
            texts.append(" ".join(own))
    docs = documents(spark, texts).repartition(3)
    got = by_id(simhash.groups(docs), "fp", "component_id")
    values = [brute_fingerprint(t) for t in texts]
    assert [got[i][0] % (1 << 64) for i in range(len(texts))] == values
    want = brute_groups(list(range(len(texts))), values, 4)
    assert {i: got[i][1] for i in want} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("block", [4, 2048])
def test_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)  # the number of blocks is chosen in the driver
    rng = random.Random(block)
    values = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(25):
            v = seed
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    want = brute_groups(list(range(len(values))), values, 4)
    classes = {}
    for i, v in enumerate(signed):
        classes.setdefault(want[i], set()).add(roots.get(v, v))
    assert all(len(x) == 1 for x in classes.values())
    assert len(set().union(*classes.values())) == len(classes)


def test_keep_one_with_null_and_repeated_ids(spark):
    texts = ["one two three four five", "one two three four five", "alone here with words",
             "other words in this one", "other words in this one", "other words in this one"]
    docs = documents(spark, texts, ids=[None, 4, None, 6, 6, 7])
    kept = simhash.keep_one(docs).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [
        (-1, texts[2]), (4, texts[0]), (6, texts[3])]
    assert simhash.groups(documents(spark, [])).count() == 0


# --- op10 --------------------------------------------------------------------------------------

def jaccard(a, b):
    one, two = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((one & two).values()) / sum((one | two).values())


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(10)
    words = [f"w{i}" for i in range(60)]
    sample = sampling.Sampler(2048)
    for n in (5, 60, 300):
        a, b = prose(rng, words, n), prose(rng, words, n)
        mixed = " ".join(a.split()[: n // 2] + b.split()[n // 2 :])
        one, two, three = sample([a, b, mixed])
        for x, y, s, t in ((one, two, a, b), (one, three, a, mixed)):
            assert abs(sampling.likeness(x, y) - jaccard(s, t)) < 0.05


def test_edit_study(spark):
    texts = [*ODD, "é😀abc def", "é😀abc def", "last of all words"]
    ids = [5, 9, 1, 30, 22, 4, 17, 16, 40, 2, None]
    docs = documents(spark, texts, ids=ids).repartition(3)
    got = {r["doc_id"]: r for r in sampling.edit_study(docs).collect()}
    order = sorted(zip(ids, texts, strict=True), key=lambda x: -1 if x[0] is None else x[0],
                   reverse=True)
    assert set(got) == set(ids)
    prints = {}
    for at, (i, text) in enumerate(order):
        text, behind = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + behind[:half]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        parts = [x[k : k + 4] for x in (row["fingerprint"], row["edited_fingerprint"])
                 for k in range(0, len(x), 4)]
        same = np.mean([a == b for a, b in zip(parts[:64], parts[64:], strict=True)])
        assert row["near_edited"] == same
    assert got[17]["near_next"] == 1.0 and got[17]["fingerprint"] == got[16]["fingerprint"]
    assert sampling.edit_study(documents(spark, [])).count() == 0
    single = sampling.edit_study(documents(spark, ["abcd"])).first()
    assert single["near_next"] == 1.0
    assert single["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


# --- op3 ---------------------------------------------------------------------------------------

def plain_marginals(emit, moves):
    """Forward-backward over one text, state by state."""
    n = len(emit)
    alpha, beta = np.zeros((n, 2)), np.ones((n, 2))
    state = np.array([1.0, 0.0])
    for t in range(n):
        state = (state @ moves) * np.array([1.0, emit[t]])
        state = state / state.sum()
        alpha[t] = state
    for t in range(n - 2, -1, -1):
        beta[t] = moves @ (np.array([1.0, emit[t + 1]]) * beta[t + 1])
        beta[t] /= beta[t].sum()
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1)


def test_blocks_equal_one_chain():
    rng = np.random.RandomState(3)
    sizes = np.array([0, 1, 5, 511, 512, 513, 1700, 0, 3])
    emit, moves = np.exp(rng.randn(sizes.sum())), np.exp(rng.randn(2, 2))
    got = np.split(toxicity.marginals(emit, sizes, moves), np.cumsum(sizes)[:-1])
    for own, p in zip(np.split(emit, np.cumsum(sizes)[:-1]), got, strict=True):
        if len(own):
            assert np.allclose(p, plain_marginals(own, moves))


def test_toxic_spans(spark):
    rng = random.Random(3)
    good, bad = [f"word{i}" for i in range(80)], ["vile", "rotten", "nasty"]
    texts, labels = [], []
    for i in range(160):
        words = prose(rng, good, 60).split()
        if i % 4 == 0:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(60), w.upper() + "!")
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0)))
    docs = documents(spark, texts + ODD)
    known = spark.createDataFrame(labels[:120] + [(999, 1), (None, 0)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs, known)
    got = by_id(toxicity.score(docs, model), "score", "spans")
    for i in range(120, 160):
        assert (got[i][0] >= 0.5) == (i % 4 == 0)
        found = sorted(texts[i][s["start"] : s["end"]].lower().strip("!") for s in got[i][1])
        assert all(w in " ".join(found) for w in bad if w in texts[i].lower())
    assert all(got[160 + k][0] < 0.5 and got[160 + k][1] == [] for k in range(len(ODD)))
    none = toxicity.learn(docs, known.filter("toxic = 0"))
    assert none is None
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), model).count() == 0


# --- op1 ---------------------------------------------------------------------------------------

def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(50):
        a = [rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 30))]
        b = [rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 30))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = (
                    table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j]))
        assert decontaminate.common_length(decontaminate.masks(a), len(a), b) == table[-1, -1]


def test_leaks(spark):
    rng = random.Random(11)
    words = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "x", "lt")]
    items = [prose(rng, words, rng.randint(15, 50)) for _ in range(25)]
    texts, want = [], set()
    for i in range(120):
        own = prose(rng, words, rng.randint(40, 400)).split()
        if i % 5 == 0:
            item = items[i % 25].split()
            if i % 10 == 0:  # a paraphrase: one word in ten is another one
                item = [w if k % 10 else "other" for k, w in enumerate(item)]
            own[20:20] = item if i % 3 else [w.upper() for w in item]
            want.add((i, i % 25))
        texts.append(" ".join(own))
    docs = documents(spark, texts + ODD)
    bench = spark.createDataFrame(
        [(k, t, "x") for k, t in enumerate(items)] + [(90, None, "x"), (91, "", "x"),
                                                      (92, "a", "x"), (0, items[0], "y")],
        "item_id bigint, text string, doc_id string")
    found = decontaminate.find_leaks(docs, bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    left = decontaminate.remove_leaks(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == docs.count() - len({i for i, _ in want})
    assert decontaminate.find_leaks(docs, bench.filter("1 = 0")).count() == 0
    assert decontaminate.find_leaks(documents(spark, []), bench).count() == 0


@pytest.mark.parametrize("size", [4, 5, 6, 8, 10, 12, 14, 16, 20])
@pytest.mark.parametrize("replaced, least", [(0, 0.99), (0.3, 0.88)])
def test_short_items_are_found(spark, size, replaced, least):
    """Items inside longer texts, against the longest common subsequence by brute force."""
    rng = random.Random(size)
    words = [a + b + c + d for a in "bdfgklm" for b in "aeiou" for c in "nrstx" for d in ("", "a", "el")]
    items, texts = [], []
    while len(items) < 120:
        item = prose(rng, words, size).split()
        copy = list(item)
        for k in rng.sample(range(size), int(size * replaced)):
            copy[k] = "other"
        known = decontaminate.Item(0, " ".join(item))
        found = [x.encode() for x in copy]
        shares = (decontaminate.common_length(known.all, size, found) / size,
                  decontaminate.common_length(known.answer, known.n_answer, found) / known.n_answer)
        if shares[0] >= decontaminate.LEAST_SHARE and shares[1] >= decontaminate.LEAST_ANSWER:
            own = prose(rng, words, rng.randint(60, 300)).split()
            at = rng.randrange(len(own))
            own[at:at] = copy
            items.append((len(items), " ".join(item)))
            texts.append(" ".join(own))
    docs = documents(spark, texts)
    space = decontaminate.latent_space(docs)
    searcher = decontaminate.Searcher(items, space)
    hits = {(d, i) for d, i, *_ in searcher.leaks([decontaminate.folded(t) for t in texts])}
    assert sum((i, i) in hits for i in range(len(items))) >= least * len(items)
