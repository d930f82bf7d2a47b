"""op1 against brute force: every document and item, at every fourth word."""

from math import ceil

from rimeframe.llm import decontaminate as dc


def leaks_of(text, items):
    words = [dc.normal(w) for w in dc.folded(text).split()]
    found = set()
    for item in items:
        reach, least, known = len(item.words), ceil(dc.LEAST_SHARE * len(item.words)), set(item.words)
        inside = [w in known for w in words]
        for place in range(0, len(words), 4):
            begin, end = max(0, place - reach), min(len(words), place + dc.PASSAGE + reach)
            if sum(inside[begin:end]) < least:
                continue
            part = words[begin:end]
            if dc.common_length(item.all, reach, part) >= least and dc.common_length(
                item.answer, item.n_answer, part
            ) >= ceil(dc.LEAST_ANSWER * item.n_answer):
                found.add(item.item_id)
                break
    return found


def test_leaks_equal_all_pairs(spark, sf):
    """Recall of what the sequence and answer checks accept anywhere, and nothing beyond that."""
    docs, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [dc.Item(r["item_id"], r["text"]) for r in benchmark.collect() if r["text"]]
    items = [x for x in items if len(x.words) >= dc.LEAST_ITEM_WORDS]
    wanted = {(r["doc_id"], i) for r in docs.collect() for i in leaks_of(r["text"], items)}
    found = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(docs, benchmark).collect()}
    assert wanted and found <= wanted
    assert len(found) >= 0.9 * len(wanted)


def test_rows_are_added_whatever_their_number():
    import numpy as np

    rng = np.random.default_rng(2)
    row = np.sort(np.concatenate([rng.integers(0, 50, 900), np.full(400, 7)]))
    product, place = rng.normal(size=(60, 5)).astype(np.float32), rng.integers(0, 60, len(row))
    total, wanted = np.zeros((50, 5)), np.zeros((50, 5))
    dc._add_rows(total, row, product, place)
    np.add.at(wanted, row, product[place])
    assert np.allclose(total, wanted, atol=1e-3)
    dc._add_rows(total, row[:0], product, place[:0])
