"""Training sequences packed with lexical neighbours from a sharded BM25 index.

Whole windows are cut from a document first; what is left of it (its tail) goes to a shard.  A shard
is an inverted index of BM25 weights over token ids, with document frequencies and the mean length
of all documents.  The first unused tail seeds a window, its unused neighbours follow in order of
score, and the one that does not fit is cut: its rest seeds the next window.  So every window of a
shard is full; the last, partial one is cut into sequences whose lengths are powers of two, which
need no padding.

Documents reach shards in order of a sketch, so near copies and their like are often neighbours and
a group of copies is split like any other run of documents.  A shard holds ``SHARD_TOKENS`` tokens
(or one tail); shards grow in number with the input, never in size.

Defined cases: a null or empty text is the end id alone; repeated rows are separate documents; ties
in score go by place in the shard; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimeframe.llm.shared import packed_stage
from rimeframe.llm.tokens import id_counts, id_type, token_ids

WINDOW = 2048
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75

SCHEMA = """doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,
    sequence_id bigint, offset bigint"""


class Index:
    """BM25 weights of a shard's tails by id; a query is a tail of the shard."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_length: float):
        sizes = np.array([len(x) for x in tails], dtype=np.int64)
        flat = np.concatenate(tails).astype(np.int64)
        keys, counts = np.unique(
            np.repeat(np.arange(len(tails)), sizes) * len(idf) + flat, return_counts=True)
        doc, term = keys // len(idf), keys % len(idf)
        norm = K1 * (1 - B + B * sizes / mean_length)
        weight = idf[term] * counts * (K1 + 1) / (counts + norm[doc])
        self.size = len(tails)
        self.bounds = np.searchsorted(doc, np.arange(self.size + 1))
        terms, self.term = np.unique(term, return_inverse=True)
        order = np.argsort(self.term, kind="stable")
        self.posted, self.weights = doc[order], weight[order]
        self.lists = np.searchsorted(self.term[order], np.arange(len(terms) + 1))

    def scores(self, tail: int) -> np.ndarray:
        terms = self.term[self.bounds[tail] : self.bounds[tail + 1]]
        begin, size = self.lists[terms], self.lists[terms + 1] - self.lists[terms]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.bincount(self.posted[at], weights=self.weights[at], minlength=self.size)


def fill(lengths: list[int], index: Index, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, begin, size); all have ``window`` ids or a power of two."""
    unused = np.ones(len(lengths), dtype=bool)
    out, seed, begin, first = [], -1, 0, 0
    while True:
        if seed < 0:
            while first < len(lengths) and not unused[first]:
                first += 1
            if first == len(lengths):
                return out
            seed, begin = first, 0
            unused[seed] = False
        pieces, room = [(seed, begin, lengths[seed] - begin)], window - (lengths[seed] - begin)
        here, seed = seed, -1
        if room > 0 and unused.any():
            scores = index.scores(here)
            left = np.flatnonzero(unused)
            for tail in left[np.argsort(-scores[left], kind="stable")].tolist():
                unused[tail] = False
                size = min(lengths[tail], room)
                pieces.append((tail, 0, size))
                room -= size
                if size < lengths[tail]:
                    seed, begin = tail, size
                if room == 0:
                    break
        out += [pieces] if room == 0 else powers(pieces)


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces cut into sequences of falling powers of two."""
    total, out = sum(x[2] for x in pieces), []
    waiting = list(pieces)
    for bit in reversed(range(total.bit_length())):
        room, sequence = (1 << bit) if total >> bit & 1 else 0, []
        while room:
            tail, begin, size = waiting.pop(0)
            take = min(size, room)
            sequence.append((tail, begin, take))
            room -= take
            if take < size:
                waiting.insert(0, (tail, begin + take, size - take))
        if sequence:
            out.append(sequence)
    return out


def _packer(idf: np.ndarray, mean_length: float, dtype: str):
    names = [x.split()[0] for x in SCHEMA.split(",")]

    def run(batches):
        part, number = TaskContext.get().partitionId() << 32, 0
        shard, held = [], 0

        def finish():
            nonlocal number
            rows = []

            def put(doc, begin, size, offset):
                doc_id, ids = shard[doc]
                piece = ids[begin : begin + size].astype("<u4").tobytes()
                rows.append((doc_id, begin, size, zlib.crc32(piece), len(ids), part + number, offset))

            tails, owners, begins = [], [], []
            for doc, (_, ids) in enumerate(shard):
                cut = len(ids) // WINDOW * WINDOW
                for begin in range(0, cut, WINDOW):
                    put(doc, begin, WINDOW, 0)
                    number += 1
                if cut < len(ids):
                    tails.append(ids[cut:])
                    owners.append(doc)
                    begins.append(cut)
            if tails:
                index = Index(tails, idf, mean_length)
                for sequence in fill([len(x) for x in tails], index):
                    offset = 0
                    for tail, begin, size in sequence:
                        put(owners[tail], begins[tail] + begin, size, offset)
                        offset += size
                    number += 1
            columns = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
            return pa.RecordBatch.from_pydict(
                columns, pa.schema([(n, pa.int64()) for n in names]))

        for batch in batches:
            for doc_id, ids in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                shard.append((doc_id, np.frombuffer(ids, dtype)))
                held += len(shard[-1][1])
                if held >= SHARD_TOKENS:
                    yield finish()
                    shard, held = [], 0
        if shard:
            yield finish()

    return run


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: its document, place in it, checksum, sequence and offset there."""
    spark, dtype = docs.sparkSession, id_type(path)
    tokens = packed_stage(token_ids(docs, path, with_sketch=True), "token-ids")
    totals = tokens.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("n_tokens") % WINDOW).alias("mean")).first()
    counted = id_counts(tokens, dtype, of_documents=True).collect()  # a row per id at most
    frequency = np.zeros(max([row["id"] for row in counted], default=0) + 1, dtype=np.float64)
    for row in counted:
        frequency[row["id"]] = row["n"]
    idf = np.log1p((totals["n"] - frequency + 0.5) / (frequency + 0.5))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        tokens.select("doc_id", "ids", "sketch")
        .repartitionByRange(parts, "sketch", "doc_id")
        .sortWithinPartitions("sketch", "doc_id", "ids")
        .select("doc_id", "ids")
    )
    return ordered.mapInArrow(_packer(idf, totals["mean"] or 1.0, dtype), SCHEMA)
