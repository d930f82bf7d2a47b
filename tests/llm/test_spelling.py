"""op12 against brute force over all pairs of words, and against its SQL."""

import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import documents  # noqa: E402

from rimeframe.llm import spelling as sp  # noqa: E402


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted_words(docs, least=sp.LEAST_LENGTH, drop=sp.DROP_ONE_IN):
    lower = str.maketrans(sp.UPPER, sp.LOWER)
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall(f"[{sp.LETTERS}]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= least
    return {w: n for w, n in out.items() if n >= 2}


def brute(counts):
    found = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        found[w] = (n, len(others), form, counts.get(form))
    out = {}
    for w, row in found.items():
        root = w
        while found[root][2] is not None:
            root = found[root][2]
        out[w] = (*row, root)
    return out


def result(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("crowded, block", [(2048, 256), (6, 3), (1, 2)])
def test_pairs_equal_brute_force(spark, monkeypatch, crowded, block):
    """Small alphabets make crowded prefixes and suffixes, repeated letters and ties."""
    monkeypatch.setattr(sp, "BLOCK", block)
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    words |= {"aaaa" + "".join(rng.choice("ab") for _ in range(5)) + "bbbb" for _ in range(30)}
    words |= {"日" * k for k in range(1, 6)} | {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 150}
    counted = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n bigint")
    got = [tuple(sorted((r["a"], r["b"]))) for r in sp.near_pairs(counted, crowded).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def texts():
    rng = random.Random(11)
    base = ["Mountain", "fountain", "wonderful", "Élèvement", "yesterday", "mountains", "short"]
    out = []
    for _ in range(400):
        words = []
        for word in rng.choices(base, weights=[300, 30, 90, 80, 50, 3, 20], k=6):
            if rng.random() < 0.1:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "x", word[at] * 2]) + word[at + 1 :]
            words.append(word)
        out.append(rng.choice([" ", ", ", "9"]).join(words))
    return [*out, None, "", "..", "z" * 40000 + " " + "z" * 40000, "mountaim mountain", "mountaim mountain"]


@pytest.mark.parametrize("crowded", [2048, 3])
def test_variants_equal_brute_force(spark, crowded):
    rows = texts()
    ids = [None, *range(len(rows) - 2), 7]
    docs = documents(spark, rows, ids=ids).selectExpr("*", "1 as word", "2 as n", "3 as h", "4 as c")
    want = brute(counted_words(zip(ids, rows, strict=True)))
    got = result(sp.variants(docs, crowded=crowded))
    assert got == want
    assert any(x[2] for x in want.values()) and any(x[1] > 1 for x in want.values())


def test_chains_and_empty_tables(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in sp.roots(forms).collect()} == {"w9"}
    assert sp.variants(documents(spark, ["a", None]).limit(0)).collect() == []
    assert sp.variants(documents(spark, [None, "", "tiny words"])).collect() == []
    with pytest.raises(ValueError):
        sp.variants(documents(spark, ["a"]), times=1)
