"""Credentials put together from their parts, against brute force."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import documents  # noqa: E402

from rimeframe.llm import secrets  # noqa: E402


def parts(text_spans, breaks):
    """Nearest identifier and endpoint of every secret in its scope; the one before wins a tie."""
    out = []
    scope = lambda s: sum(b < s for b in breaks)
    for secret in text_spans:
        if secret[1] not in (0, 2, 4):
            continue
        row = [secret]
        for kinds in ((1, 3), (5,)):
            others = [x for x in text_spans if x[1] in kinds and scope(x[0]) == scope(secret[0])]
            left = [x for x in others if (x[0], x[1]) < secret[:2]]
            right = [x for x in others if (x[0], x[1]) > secret[:2]]
            sides = []
            if left:
                x = max(left, key=lambda x: (x[2], x[0], x[1]))
                sides.append((max(0, secret[0] - x[2]), 0, x))
            if right:
                x = min(right, key=lambda x: (x[0], x[1], x[2]))
                sides.append((max(0, x[0] - secret[2]), 1, x))
            near = min(sides, key=lambda x: x[:2], default=None)
            row.append(near[2] if near and near[0] <= secrets.REACH else None)
        if row[1] or row[2]:
            out.append(tuple(row))
    return sorted(out)


def test_parts_equal_brute_force(spark):
    rng = random.Random(6)
    pieces = ["account=alice", "AKIA" + "Q" * 18, "https://db.example.org:5432", "token=abcdefgh", "0f" * 15,
              "aB" * 10 + "7", "host: db1.local", "login = bob", "plain words", "x" * 90, "\n\n", "é日"]
    texts = [" ".join(rng.choices(pieces, k=rng.randrange(1, 25))) for _ in range(60)] + [None, ""]
    docs = documents(spark, texts)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(docs).collect()}
    found = {}
    for r in secrets.linked_parts(docs).collect():
        row = tuple(None if x is None else tuple(x) for x in (r["secret"], r["identifier"], r["endpoint"]))
        found.setdefault(r["doc_id"], []).append(row)
    wanted = {}
    for i, text in enumerate(texts):
        breaks = [k for k in range(len(text or "")) if (text or "")[k : k + 2] == "\n\n"]
        if own := parts(spans[i], breaks):
            wanted[i] = own
    key = lambda x: str(x)
    assert {i: sorted(x, key=key) for i, x in found.items()} == {i: sorted(x, key=key) for i, x in wanted.items()}
    assert any(x[1] and x[2] for rows in wanted.values() for x in rows)
    assert secrets.linked_parts(docs.limit(0)).collect() == []
