"""Toxic spans by a linear-chain conditional random field, document scores from its marginals.

Tokens (white-space words, case folded, outer punctuation off) are labelled from document labels: in
a toxic document a token is toxic if its word occurs in many more toxic than other documents.  The
field has the states plain and toxic, a weight for each hashed word and token shape, and transition
weights; it is fitted by gradient ascent on the exact likelihood.  Forward-backward gives each token
of a whole text its marginal; their squares' sum and maximum give the document's score by logistic
regression, and tokens of one half or more are the offending spans.

Fitting uses a bounded sample: per class the ``PER_CLASS`` labelled documents of smallest hash, and
of these whole texts, as long as those before have less than ``FIT_CHARS`` characters; texts of more than
``LONG`` characters are taken only where others leave room.  Scoring reads whole texts.

Long texts are cut into blocks of ``BLOCK`` tokens; the blocks' transfer matrices are multiplied
along a text first, so blocks run side by side and the result is that of one long chain.

Defined cases: null and empty texts have no token and get the score of no evidence; a doc_id with
several labels is toxic if any says so; without any usable label all scores are 0; repeated rows are
scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PER_CLASS = 1500
FIT_CHARS = 6_000_000
LONG = 150_000
BUCKETS = 1 << 20
ROUNDS = 40
STEP = 0.3
RIDGE = 1e-3
BLOCK = 512
SALTS = 64
#: A word labels tokens if the odds of documents with it are this many times as high...
LEAST_ODDS = 8.0
#: ...and it occurs in this part of the toxic documents, and in this many, copies counted once.
LEAST_SHARE = 0.01
LEAST_DOCUMENTS = 5
MINIMA = 16

OUTER = b".,;:!?\"'()[]{}<>*#$%&|-_~`"
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
MEMO_WORDS = 1 << 18
SHAPES = 4


def normal(word: bytes) -> bytes:
    return word.lower().strip(OUTER)


def shape(word: bytes) -> int:
    """0 plain, 1 all capitals, 2 with a digit, 3 nothing but punctuation."""
    core = word.strip(OUTER)
    if not core:
        return 3
    if any(48 <= c <= 57 for c in core):
        return 2
    return int(core.isupper() and len(core) > 1)


def bucket(word: bytes) -> int:
    return xxhash.xxh64_intdigest(normal(word)) % BUCKETS


@dataclass
class Model:
    """Weights of the toxic state (words, shapes, any token), exp of moves, document weights."""

    weights: np.ndarray
    moves: np.ndarray
    document: np.ndarray

    def emission(self, word: bytes) -> float:
        value = self.weights[[bucket(word), BUCKETS + shape(word), -1]].sum()
        return float(np.exp(np.clip(value, -30.0, 30.0)))

    def score(self, marginals: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-(evidence(marginals) @ self.document))))


def evidence(marginals: np.ndarray) -> np.ndarray:
    """One, how much is toxic and the most toxic token; squares keep length alone from adding up."""
    top = marginals.max() if len(marginals) else 0.0
    return np.array([1.0, np.log1p((marginals**2).sum()), top])


def messages(emit: np.ndarray, sizes: np.ndarray, moves: np.ndarray):
    """Forward and backward ratios toxic : plain for texts laid end to end; all begin as plain."""
    texts = np.flatnonzero(sizes)
    begins = (np.cumsum(sizes) - sizes)[texts]
    counts = -(-sizes[texts] // BLOCK)
    text = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = begins[text] + nth * BLOCK
    length = np.minimum(BLOCK, sizes[texts][text] - nth * BLOCK)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    oo, ot, to, tt = moves.reshape(-1)
    longest = int(length.max()) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # length > step

    into, onto = np.zeros(len(order)), np.ones(len(order))
    if (counts > 1).any():
        p = np.stack([np.ones(len(order)), np.zeros(len(order)),
                      np.zeros(len(order)), np.ones(len(order))])
        for step in range(longest):
            n = active[step]
            e = emit[start[:n] + step]
            a, b, c, d = p[:, :n]
            p[:, :n] = a * oo + b * to, (a * ot + b * tt) * e, c * oo + d * to, (c * ot + d * tt) * e
            p[:, :n] /= p[:, :n].max(axis=0)
        firsts = np.cumsum(counts) - counts
        for k in range(1, int(counts.max())):
            here = firsts[counts > k] + k
            a, b, c, d = p[:, place[here - 1]]
            r = into[place[here - 1]]
            into[place[here]] = (b + r * d) / (a + r * c)
        for k in range(1, int(counts.max())):
            here = (firsts + counts)[counts > k] - k - 1
            a, b, c, d = p[:, place[here + 1]]
            r = onto[place[here + 1]]
            onto[place[here]] = (c + d * r) / (a + b * r)
    forward, backward = np.empty(len(emit)), np.empty(len(emit))
    state = into
    for step in range(longest):
        n = active[step]
        at = start[:n] + step
        state[:n] = emit[at] * (ot + tt * state[:n]) / (oo + to * state[:n])
        forward[at] = state[:n]
    for step in range(longest):
        n = active[step]
        at = start[:n] + length[:n] - 1 - step
        backward[at] = onto[:n]
        flow = emit[at] * onto[:n]
        onto[:n] = (to + tt * flow) / (oo + ot * flow)
    return forward, backward


def marginals(emit: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    forward, backward = messages(emit, sizes, moves)
    odds = forward * backward
    return odds / (1.0 + odds)


def minima(words: set[bytes]) -> np.ndarray:
    """The smallest of the words' hashes under each of ``MINIMA`` multipliers."""
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    if len(hashes) == 0:
        return np.zeros(MINIMA, dtype=np.uint64)
    odd = np.random.RandomState(3).randint(1 << 62, size=MINIMA).astype(np.uint64) | np.uint64(1)
    return (hashes[:, None] * odd[None, :]).min(axis=0)


def labelled_words(texts: list[str], toxic: np.ndarray) -> set[bytes]:
    """Words that mark tokens of toxic documents.

    Of documents of a class that agree in half of their word minima only the first counts, so a
    group of copies is no evidence.
    """
    counts, sizes = (Counter(), Counter()), [0, 0]
    kept: tuple[list, list] = ([], [])
    for text, label in zip(texts, toxic.tolist(), strict=True):
        words = {normal(w) for w in text.encode().split()} - {b""}
        own = minima(words)
        if kept[label] and (np.array(kept[label]) == own).mean(axis=1).max() >= 0.5:
            continue
        kept[label].append(own)
        sizes[label] += 1
        counts[label].update(words)
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * sizes[1])
    plain, bad = counts
    return {
        w for w, n in bad.items()
        if n >= least
        and (n + 0.5) / (sizes[1] + 1) >= LEAST_ODDS * (plain[w] + 0.5) / (sizes[0] + 1)
    }


def fit(texts: list[str], toxic: np.ndarray) -> Model | None:
    """A model from whole documents and their labels; None without both classes."""
    if len(set(toxic.tolist())) < 2:
        return None
    marked = labelled_words(texts, toxic)
    words = [x.encode().split() for x in texts]
    sizes = np.array([len(x) for x in words], dtype=np.int64)
    flat = [w for x in words for w in x]
    known: dict[bytes, tuple[int, int, bool]] = {}
    for w in flat:
        if w not in known:
            known[w] = (bucket(w), BUCKETS + shape(w), normal(w) in marked)
    table = np.array([known[w] for w in flat], dtype=np.int64).reshape(-1, 3)
    label = (table[:, 2] > 0) & (np.repeat(toxic, sizes) > 0)
    begins = np.zeros(len(flat), dtype=bool)
    begins[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    before = np.concatenate(([False], label[:-1])) & ~begins
    weights, log_moves = np.zeros(BUCKETS + SHAPES + 1), np.zeros((2, 2))
    weights[-1] = -2.0
    n = max(1, len(flat))

    def unary(values: np.ndarray) -> np.ndarray:
        own = sum(np.bincount(table[:, i], weights=values, minlength=len(weights)) for i in (0, 1))
        own[-1] = values.sum()
        return own

    def emissions() -> np.ndarray:
        value = weights[table[:, 0]] + weights[table[:, 1]] + weights[-1]
        return np.exp(np.clip(value, -30.0, 30.0))

    seen_unary = unary(label)
    seen_moves = np.array([[(~before & ~label).sum(), (~before & label).sum()],
                           [(before & ~label).sum(), (before & label).sum()]], dtype=float)
    state = [np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)]
    for turn in range(1, ROUNDS + 1):
        emit = emissions()
        moves = np.exp(log_moves)
        forward, backward = messages(emit, sizes, moves)
        odds = forward * backward
        p = odds / (1.0 + odds)
        r = np.where(begins, 0.0, np.concatenate(([0.0], forward[:-1])))
        flow = emit * backward
        joint = np.stack([np.full(n if len(flat) else 0, moves[0, 0]), moves[0, 1] * flow,
                          r * moves[1, 0], r * moves[1, 1] * flow])
        expected_moves = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        slope = np.concatenate((
            (seen_unary - unary(p)) / n - RIDGE * weights / n,
            (seen_moves - expected_moves).reshape(-1) / n - RIDGE * log_moves.reshape(-1) / n,
        ))
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope**2
        step = STEP * (state[0] / (1 - 0.9**turn)) / (np.sqrt(state[1] / (1 - 0.99**turn)) + 1e-9)
        weights += step[:-4]
        log_moves += step[-4:].reshape(2, 2)
    emit = emissions()
    moves = np.exp(log_moves)
    p = marginals(emit, sizes, moves)
    rows = np.array([evidence(x) for x in np.split(p, np.cumsum(sizes)[:-1])])
    return Model(weights, moves, _logistic(rows, toxic))


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    beta = np.zeros(rows.shape[1])
    penalty = ridge * np.eye(rows.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-rows @ beta))
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + penalty
        beta = beta + np.linalg.solve(curve, rows.T @ (labels - p) - penalty @ beta)
        beta = np.clip(beta, -30, 30)
    return beta


def training_ids(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the sample, by hash of doc_id within each class, salted for ranking."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    salted = Window.partitionBy("toxic", F.pmod("h", F.lit(SALTS))).orderBy("h", "doc_id")
    final = Window.partitionBy("toxic").orderBy("h", "doc_id")
    few = known.withColumn("n", F.row_number().over(salted)).filter(F.col("n") <= PER_CLASS)
    chosen = few.withColumn("n", F.row_number().over(final)).filter(F.col("n") <= PER_CLASS)
    return chosen.select("doc_id", "toxic")


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the bounded sample of ``labels`` that ``docs`` has texts for."""
    chosen = F.broadcast(training_ids(labels))  # at most 2 * PER_CLASS rows
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
    )
    found = rows.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sized = found.withColumn("size", F.coalesce(F.char_length("text"), F.lit(0)))
    order = Window.partitionBy("toxic").orderBy(F.col("size") > LONG, F.xxhash64("doc_id"), "doc_id")
    earlier = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    taken = sized.withColumn("before", F.coalesce(earlier, F.lit(0))).filter(F.col("before") < FIT_CHARS)
    sample = taken.orderBy("doc_id").select("text", "toxic").collect()
    return fit([r["text"] or "" for r in sample], np.array([r["toxic"] for r in sample], dtype=int))


class _Emissions(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        self[word] = found = self.model.emission(word)
        return found


SCHEMA = "doc_id bigint, score double, spans array<struct<start:int,end:int>>"


def spans_of(text: str, hot: np.ndarray) -> list[dict]:
    """Code-point spans of the tokens flagged in ``hot``; neighbours are one span."""
    out: list[dict] = []
    last = -2
    for i, token in enumerate(TOKEN.finditer(text)):
        if hot[i]:
            if last == i - 1:
                out[-1]["end"] = token.end()
            else:
                out.append({"start": token.start(), "end": token.end()})
            last = i
    return out


def score(docs: DataFrame, model: Model | None, tokens_at_once: int = 1 << 19) -> DataFrame:
    """doc_id, score and offending spans of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        fitted = shared.value
        memo = _Emissions(fitted) if fitted is not None else None

        def finish(ids, texts, emits):
            sizes = np.array([len(x) for x in emits], dtype=np.int64)
            p = marginals(np.concatenate(emits), sizes, fitted.moves)
            scores, spans = [], []
            for text, own in zip(texts, np.split(p, np.cumsum(sizes)[:-1]), strict=True):
                scores.append(fitted.score(own))
                hot = own >= 0.5
                spans.append(spans_of(text, hot) if hot.any() else [])
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(scores, pa.float64()), pa.array(spans, kinds)],
                ["doc_id", "score", "spans"],
            )

        for batch in batches:
            ids, texts, emits, held = [], [], [], 0
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                ids.append(doc_id)
                if fitted is None:
                    continue
                words = (text or "").encode().split()
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                texts.append(text or "")
                emits.append(np.fromiter(map(memo.__getitem__, words), np.float64, len(words)))
                held += len(words)
                if held >= tokens_at_once:
                    yield finish(ids, texts, emits)
                    ids, texts, emits, held = [], [], [], 0
            if fitted is None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([0.0] * len(ids), pa.float64()),
                     pa.array([[]] * len(ids), kinds)], ["doc_id", "score", "spans"])
            elif ids:
                yield finish(ids, texts, emits)

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    return rows.mapInArrow(run, SCHEMA)
