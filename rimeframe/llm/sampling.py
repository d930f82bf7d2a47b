"""Document fingerprints by consistent weighted sampling.

A text is a bag of words (ASCII case folded) weighted by their counts.  For each of ``SAMPLES``
draws a word gets r and c from Gamma(2, 1) and b from [0, 1), all by hashing the word; with weight w
its rank is ln c - r (t - b + 1) where t = floor(ln w / r + b).  The word of least rank and its t are
the sample, kept as 16 bits; of words with equal ranks that of smaller hash counts.  Two texts agree
in a sample with the probability of their generalised Jaccard similarity, sum of minima over sum of
maxima of the weights (and 1 in 65,536 by chance).

Defined cases: a text without words (null, empty, blank) has the fingerprint of no sample, equal to
other such texts only; repeated doc_ids follow each other in order of their text; a null doc_id
comes last; a single document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES = 64
#: Words whose draws a task remembers (1 KB each), and draws made at once.
REMEMBERED = 1 << 16
MADE_AT_ONCE = 1 << 12
CHARS_AT_ONCE = 1 << 19

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LOW_BITS = np.uint64((1 << 23) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers of 23 bits to the middles of as many parts of (0, 1), which single precision holds exactly."""
    return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-23)


class Sampler:
    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.empty = np.zeros(samples, dtype=np.uint16)
        self._forget(0)

    def _forget(self, room: int) -> None:
        room = max(room, REMEMBERED)
        self.rows: dict[bytes, int] = {}
        shape = (room, self.samples)
        self.r, self.ln_c, self.b, self.once = (np.empty(shape, np.float32) for _ in range(4))
        self.hashes = np.empty(room, np.uint64)

    def _learn(self, words: list[bytes]) -> None:
        for begin in range(0, len(words), MADE_AT_ONCE):
            some = words[begin : begin + MADE_AT_ONCE]
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in some], dtype=np.uint64)
            at = len(self.rows)
            to = slice(at, at + len(some))
            steps = np.arange(1, 2 * self.samples + 1, dtype=np.uint64) * GOLDEN
            draws = _mixed(hashes[:, None] + steps[None, :]).reshape(len(some), 2, self.samples)
            (one, two), (three, four) = (
                (_uniform(x >> np.uint64(41)), _uniform((x >> np.uint64(18)) & LOW_BITS))
                for x in (draws[:, 0], draws[:, 1])
            )
            self.r[to] = -np.log(one * two)
            self.ln_c[to] = np.log(-np.log(three * four))
            self.b[to] = (draws[:, 0] & np.uint64((1 << 18) - 1)).astype(np.float32) * np.float32(2.0**-18)
            self.once[to] = self.ln_c[to] - self.r[to] * (1 - self.b[to])
            self.hashes[to] = hashes
            self.rows.update(zip(some, range(at, at + len(some)), strict=True))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """A signature of 16-bit samples for each text."""
        bags = [Counter(x.encode().lower().split()) for x in texts]
        new = set().union(*bags) - self.rows.keys()
        if len(self.rows) + len(new) > len(self.hashes):
            new = set().union(*bags)
            self._forget(len(new))
        self._learn(list(new))
        return [self._sample(bag) for bag in bags]

    def _sample(self, bag: Counter) -> np.ndarray:
        if not bag:
            return self.empty
        rows = np.fromiter(map(self.rows.__getitem__, bag), np.int64, len(bag))
        weights = np.fromiter(bag.values(), np.int64, len(bag))
        order = np.argsort(rows)  # rows near each other are read together
        rows, weights = rows[order], weights[order]
        best = np.full(self.samples, np.inf, dtype=np.float32)
        word = np.full(self.samples, np.iinfo(np.uint64).max, dtype=np.uint64)
        chosen = np.zeros(self.samples, dtype=np.uint64)

        def settle(some: np.ndarray, ranks: np.ndarray, t: np.ndarray | None) -> None:
            """Take over the words of least rank, of those with equal ranks the one of smallest hash."""
            least = ranks.min(axis=0)
            at, sample = np.nonzero(ranks == least)
            hashes = self.hashes[some[at]]
            if len(at) > self.samples:
                first = np.lexsort((hashes, sample))
                first = first[np.concatenate(([True], np.diff(sample[first]) > 0))]
            else:
                first = np.argsort(sample)
            at, hashes = at[first], hashes[first]
            better = (least < best) | ((least == best) & (hashes < word))
            best[better], word[better] = least[better], hashes[better]
            if t is not None:
                hashes = hashes + t[at, np.arange(self.samples)].astype(np.int64).astype(np.uint64) * GOLDEN
            chosen[better] = hashes[better]

        single, several = rows[weights == 1], weights > 1
        for begin in range(0, len(single), MADE_AT_ONCE):
            some = single[begin : begin + MADE_AT_ONCE]
            settle(some, self.once[some], None)
        counted, ln_w = rows[several], np.log(weights[several]).astype(np.float32)
        for begin in range(0, len(counted), MADE_AT_ONCE):
            some = counted[begin : begin + MADE_AT_ONCE]
            r, b = self.r[some], self.b[some]
            t = np.floor(ln_w[begin : begin + MADE_AT_ONCE, None] / r + b)
            settle(some, self.ln_c[some] - r * (t - b + 1), t)
        return (_mixed(chosen + GOLDEN) >> np.uint64(48)).astype(np.uint16)


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    return float((one == two).mean())


def text_form(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint (four hex digits a sample) of every row."""

    def run(batches):
        sample = Sampler(samples)
        for batch in batches:
            texts, out = [x or "" for x in batch.column(1).to_pylist()], []
            for some in _portions(texts):
                out += [text_form(x) for x in sample(some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"]
            )

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, fingerprint string")


def _portions(texts: list[str]):
    some, chars = [], 0
    for text in texts:
        some.append(text)
        chars += len(text)
        if chars >= CHARS_AT_ONCE:
            yield some
            some, chars = [], 0
    if some:
        yield some


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows in descending doc_id, in buckets that also hold a copy of the document behind them.

    Bucket bounds are ids of the table (a bounded sketch finds them), so the copies are the rows
    whose id is a bound, and for the last document the first one.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(
        F.percentile_approx("doc_id", shares, 100 * parts).alias("bounds"),
        F.max("doc_id").alias("largest"),
    ).first()
    bounds = np.unique(np.array(found["bounds"] or [], dtype=np.int64))
    largest = found["largest"]

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        """The bucket, then the buckets that get a copy."""
        values = ids.to_numpy(dtype=object)
        out = []
        for value in values:
            if value is None or value != value:
                out.append([0] if largest is not None else [0, 0])
                continue
            at = int(np.searchsorted(bounds, int(value)))
            more = [at + 1] if at < len(bounds) and bounds[at] == int(value) else []
            out.append([at, *more, *([0] if int(value) == largest else [])])
        return pd.Series(out)

    placed = rows.withColumn("places", places("doc_id")).select(
        "doc_id", "text", F.posexplode("places").alias("copy", "bucket")
    )
    return (
        placed.withColumn("copy", F.col("copy") > 0)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), "text")
    )


EDITED_SCHEMA = """doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,
    edited_fingerprint string, near_edited double, near_next double"""


def edited(text: str, behind: str) -> str:
    """The last half (rounded down) replaced by as many first characters of the text behind."""
    half = len(text) // 2
    return text[: len(text) - half] + behind[:half]


def edit_study(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how near the edit and the next are."""
    names = [x.split()[0] for x in EDITED_SCHEMA.split(",")]

    def run(batches):
        sample = Sampler(samples)
        held, waiting, chars = None, [], 0

        def pairs():
            nonlocal held
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    doc_id, text, copy, bucket = row
                    if held is not None and held[3] == bucket and not held[2]:
                        yield held[0], held[1] or "", text or ""
                    held = row

        def finish():
            own = sample([x[1] for x in waiting] + [waiting[-1][2]])
            changed = [edited(text, behind) for _, text, behind in waiting]
            after = sample(changed)
            # the text behind is mostly the next row's; where a bucket ends it is not
            behind = [
                own[i + 1] if i + 1 == len(waiting) or waiting[i + 1][1] == x[2]
                else sample([x[2]])[0]
                for i, x in enumerate(waiting)
            ]
            columns = [
                [x[0] for x in waiting],
                [len(x[1]) for x in waiting],
                [hashlib.sha256(x.encode()).hexdigest() for x in changed],
                [text_form(x) for x in own[:-1]],
                [text_form(x) for x in after],
                [likeness(x, y) for x, y in zip(own[:-1], after, strict=True)],
                [likeness(x, y) for x, y in zip(own[:-1], behind, strict=True)],
            ]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        for pair in pairs():
            waiting.append(pair)
            chars += len(pair[1])
            if chars >= CHARS_AT_ONCE:
                yield finish()
                waiting, chars = [], 0
        if waiting:
            yield finish()

    return _in_order(docs).select("doc_id", "text", "copy", "bucket").mapInArrow(run, EDITED_SCHEMA)
