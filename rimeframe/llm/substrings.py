"""Repeated word windows, found by doubling: only windows repeated at one length are extended.

Windows of a quarter of the wanted length are looked at first; those that occur once drop out.  A
window of twice the length can only be repeated if both its halves are, so each further level pairs
survivors and touches no text.  At the last level every window that also starts earlier (smaller
doc_id, or same doc_id and earlier start) marks its words.

Documents are taken in chunks.  A chunk sorts its windows, settles repeats inside by itself and sends
one entry per distinct window to the task that owns its hash; so however often a window occurs, an
owner gets it once per chunk.  Owners answer to the chunks.  Entries travel as packed columns, the
windows of one chunk and owner in one row.  Windows are compared by hashes of 64 bits at every level,
whatever the number of owners; among n different quarters about ``n * n / 2 ** 65`` pairs are taken for
equal, less than one for all of a corpus of a billion words.

Words are what ``[^\\x20\\x09-\\x0D]+`` matches.  Defined cases: null or blank text has no words and
keeps the empty text; rows with equal doc_id and start do not count as earlier than each other, so
repeated rows are treated alike; a null doc_id is smaller than all others; an empty table gives no
rows; other columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimeframe.llm.shared import stage
from rimeframe.storage import staging

CHUNK_WORDS = 1 << 21
MEMO_WORDS = 1 << 18
NULL_ID = -(1 << 63)
GROUPS_PER_TASK = 4

QUERY, SURVIVOR, DIRECTORY, REMOVED = 0, 1, 2, 3
ROW = "kind int, chunk bigint, owner int, body binary"
ROW_ARROW = pa.schema([
    ("kind", pa.int32()), ("chunk", pa.int64()), ("owner", pa.int32()), ("body", pa.binary()),
])

ODD = np.random.RandomState(20).randint(1 << 62, size=512).astype(np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(*columns: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, each compressed alone; zero planes cost nothing."""
    squeeze, out = zstandard.ZstdCompressor(level=1).compress, []
    for column in columns:
        kind = column.dtype.str.encode().ljust(4)
        planes = column.view(np.uint8).reshape(-1, column.itemsize)
        packed = [squeeze(np.ascontiguousarray(planes[:, i]).tobytes())
                  for i in range(column.itemsize)]
        out.append(kind + struct.pack("<I", len(column)) + b"".join(
            struct.pack("<I", len(x)) + x for x in packed))
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    expand, at, out = zstandard.ZstdDecompressor().decompress, 0, []
    while at < len(body):
        dtype = np.dtype(body[at : at + 4].strip().decode())
        (count,) = struct.unpack_from("<I", body, at + 4)
        planes, at = np.empty((count, dtype.itemsize), np.uint8), at + 8
        for i in range(dtype.itemsize):
            (size,) = struct.unpack_from("<I", body, at)
            planes[:, i] = np.frombuffer(expand(body[at + 4 : at + 4 + size]), np.uint8)
            at += 4 + size
        out.append(planes.reshape(-1).view(dtype))
    return out


def _differences(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


class _Rows:
    """Rows of a task, given on in record batches of bounded size."""

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, kind: int, chunk: int, owner: int, body: bytes) -> None:
        self.rows.append((kind, chunk, owner, body))
        self.size += len(body)

    def full(self, most: int = 1 << 23):
        if self.rows and self.size >= most:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, ROW_ARROW.types, strict=True)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=ROW_ARROW)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _owner(hashes: np.ndarray, owners: int) -> np.ndarray:
    """The task that settles a hash; it grows with the hash, so sorted hashes are sorted by owner."""
    return ((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _settled(key: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows in ``order`` of key: the first of each key, and all whose key is repeated."""
    ordered = key[order]
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.append(begin, len(order)))
    return order[begin], np.sort(order[np.repeat(count > 1, count)])


def _survive(rows: _Rows, chunk: int, pos: np.ndarray, key: np.ndarray) -> None:
    if len(pos):
        rows.add(SURVIVOR, chunk, chunk % (1 << 31), pack(
            _differences(pos.astype("<u4")), key.astype("<u8")))


def _by_owner(rows: _Rows, chunk: int, owner: np.ndarray, body) -> None:
    """A query row for each run of one owner."""
    if len(owner) == 0:
        return
    edges = np.concatenate(([0], np.flatnonzero(np.diff(owner.astype(np.int64))) + 1, [len(owner)]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows.add(QUERY, chunk, int(owner[a]), body(slice(a, b)))


def _ask(rows: _Rows, chunk: int, pos: np.ndarray, key: np.ndarray, owners: int) -> None:
    """Settle repeats inside the chunk, and send one entry for each distinct window to its owner."""
    firsts, repeated = _settled(key, np.argsort(key, kind="stable"))
    _survive(rows, chunk, pos[repeated], key[repeated])
    sent, at = key[firsts], pos[firsts].astype("<u4")
    _by_owner(rows, chunk, _owner(sent, owners), lambda p: pack(_differences(sent[p]), at[p]))


def _first_level(length: int, window: int, owners: int, chunk_words: int):
    """Chunks of documents to queries, survivors and a directory of the chunk's documents."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        memo, rows = _Hashes(), _Rows()
        docs, hashes, held = [], [], 0

        def finish():
            nonlocal number
            chunk = (part << 24) + number
            number += 1
            sizes = np.array([len(x) for x in hashes], dtype=np.int64)
            bases = np.cumsum(sizes + window) - sizes - window
            rows.add(DIRECTORY, chunk, chunk % (1 << 31), pack(
                bases.astype("<u4"), np.array([x[0] for x in docs], "<i8"),
                np.array([x[1] for x in docs], "<i8"), sizes.astype("<u4")))
            flat = np.zeros(int((sizes + window).sum()) + length, dtype=np.uint64)
            for base, own in zip(bases.tolist(), hashes, strict=True):
                flat[base : base + len(own)] = own
            n = len(flat) - length
            total = np.zeros(n, dtype=np.uint64)
            for j in range(length):
                total += flat[j : j + n] * ODD[j]
            many = np.maximum(sizes - length + 1, 0)
            pos = np.repeat(bases - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            if len(pos) == 0:
                return
            _ask(rows, chunk, pos, _mixed(total[pos]), owners)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for doc_id, text_hash, text in zip(*columns, strict=True):
                words = (text or "").encode().split()
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                docs.append((NULL_ID if doc_id is None else doc_id, text_hash))
                hashes.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
                held += len(words) + window
                if held >= chunk_words:
                    finish()
                    docs, hashes, held = [], [], 0
                    yield from rows.full()
        if docs:
            finish()
        yield from rows.full(0)

    return run


def _groups(batches, column: int):
    """Runs of rows with an equal value in a column, as (value, rows)."""
    held, value = [], None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if held and row[column] != value:
                yield value, held
                held = []
            value = row[column]
            held.append(row)
    if held:
        yield value, held


def _answers(batches):
    """Owners: keys that more than one chunk sent go back to those chunks as survivors."""
    rows = _Rows()
    for owner, some in _groups(batches, 2):
        chunks, keys, places = [], [], []
        for kind, chunk, _, body in some:
            if kind == QUERY:
                key, pos = unpack(body)
                chunks.append(np.full(len(pos), chunk, np.int64))
                keys.append(np.cumsum(key, dtype=key.dtype))
                places.append(pos)
            else:
                rows.add(kind, chunk, owner, body)
        if keys:
            key, chunk, pos = map(np.concatenate, (keys, chunks, places))
            _, repeated = _settled(key, np.argsort(key, kind="stable"))
            key, chunk, pos = key[repeated], chunk[repeated], pos[repeated]
            order = np.lexsort((pos, chunk))
            key, chunk, pos = key[order], chunk[order], pos[order]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(chunk)) + 1, [len(chunk)]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b > a:
                    _survive(rows, int(chunk[a]), pos[a:b], key[a:b])
        yield from rows.full()
    yield from rows.full(0)


def _joined(some) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys of a chunk's survivors, each position once, in order."""
    places, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for kind, _, _, body in some:
        if kind == SURVIVOR:
            pos, key = unpack(body)
            places.append(np.cumsum(pos, dtype=np.int64))
            keys.append(key)
    pos, at = np.unique(np.concatenate(places), return_index=True)
    return pos, np.concatenate(keys)[at]


def _extended(pos: np.ndarray, key: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose two parts, ``step`` words apart, both survive."""
    if len(pos) == 0:
        return pos, key
    at = np.minimum(np.searchsorted(pos, pos + step), len(pos) - 1)
    good = pos[at] == pos + step
    return pos[good], _mixed(key[good] * ODD[0] + key[at[good]] * ODD[1])


def _next_level(step: int, owners: int):
    def run(batches):
        rows = _Rows()
        for chunk, some in _groups(batches, 1):
            for kind, _, _, body in some:
                if kind == DIRECTORY:
                    rows.add(kind, chunk, chunk % (1 << 31), body)
            pos, key = _extended(*_joined(some), step)
            if len(pos):
                _ask(rows, chunk, pos, key, owners)
            yield from rows.full()
        yield from rows.full(0)

    return run


def _last_level(step: int, owners: int):
    """Each chunk sends the earliest occurrence of every window and settles the others itself."""

    def run(batches):
        rows = _Rows()
        for chunk, some in _groups(batches, 1):
            bases, doc_ids = None, None
            for kind, _, _, body in some:
                if kind == DIRECTORY:
                    rows.add(kind, chunk, chunk % (1 << 31), body)
                    bases, doc_ids, _, _ = unpack(body)
            pos, key = _extended(*_joined(some), step)
            if len(pos):
                doc = np.searchsorted(bases.astype(np.int64), pos, side="right") - 1
                doc_id, start = doc_ids[doc], pos - bases[doc].astype(np.int64)
                order = np.lexsort((start, doc_id, key))
                earliest = _earliest(key[order], doc_id[order], start[order])
                later = np.sort(order[~earliest])
                if len(later):
                    rows.add(REMOVED, chunk, chunk % (1 << 31),
                             pack(_differences(pos[later].astype("<u4"))))
                sent = order[earliest]
                columns = (key[sent], pos[sent].astype("<u4"), doc_id[sent].astype("<i8"),
                           start[sent].astype("<u4"))
                _by_owner(rows, chunk, _owner(key[sent], owners),
                          lambda p, c=columns: pack(*[x[p] for x in c]))
            yield from rows.full()
        yield from rows.full(0)

    return run


def _earliest(key: np.ndarray, doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of sorted rows, those equal to the first of their key."""
    begin = np.concatenate(([True], key[1:] != key[:-1]))
    first = np.maximum.accumulate(np.where(begin, np.arange(len(key)), 0))
    return (doc_id == doc_id[first]) & (start == start[first])


def _verdicts(batches):
    """Owners of the last level: all but the earliest occurrence go back as removed."""
    rows = _Rows()
    for owner, some in _groups(batches, 2):
        queries = []
        for kind, chunk, _, body in some:
            if kind == QUERY:
                key, pos, doc_id, start = unpack(body)
                queries.append((key, pos, doc_id, start, np.full(len(pos), chunk, np.int64)))
            else:
                rows.add(kind, chunk, owner, body)
        if queries:
            key, pos, doc_id, start, chunk = map(np.concatenate, zip(*queries, strict=True))
            order = np.lexsort((start, doc_id, key))
            later = order[~_earliest(key[order], doc_id[order], start[order])]
            later = later[np.lexsort((pos[later], chunk[later]))]
            edges = np.flatnonzero(np.diff(chunk[later])) + 1
            for part in np.split(later, edges):
                if len(part):
                    rows.add(REMOVED, int(chunk[part[0]]), owner, pack(_differences(pos[part])))
        yield from rows.full()
    yield from rows.full(0)


REPEAT_SCHEMA = "doc_id bigint, text_hash bigint, starts binary"


def _by_document(batches):
    """Starts of removed windows (packed) of every document that has some."""
    for _, some in _groups(batches, 1):
        places, directory = [np.empty(0, np.int64)], None
        for kind, _, _, body in some:
            if kind == REMOVED:
                places.append(np.cumsum(unpack(body)[0], dtype=np.int64))
            elif kind == DIRECTORY:
                directory = unpack(body)
        pos = np.unique(np.concatenate(places))
        if len(pos) == 0:
            continue
        bases, doc_ids, text_hashes, _ = directory
        doc = np.searchsorted(bases.astype(np.int64), pos, side="right") - 1
        firsts = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1))
        starts = (pos - bases[doc].astype(np.int64)).astype("<u4")
        found = doc[firsts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None if x == NULL_ID else x for x in doc_ids[found].tolist()], pa.int64()),
             pa.array(text_hashes[found]),
             pa.array([pack(_differences(x)) for x in np.split(starts, firsts[1:])], pa.binary())],
            ["doc_id", "text_hash", "starts"],
        )


def repeated_windows(
    docs: DataFrame, window: int = 20, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """doc_id, hash of the text and starts of windows that also start earlier, where there are any."""
    if window < 4:
        raise ValueError("windows have four words at least")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = parts * GROUPS_PER_TASK
    quarter = -(-window // 4)
    half = min(2 * quarter, window)
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.xxhash64(docs["text"].cast("string")).alias("text_hash"),
        docs["text"].cast("string").alias("text"),
    )

    def dealt(df: DataFrame, key: str) -> DataFrame:
        return df.repartition(parts, key).sortWithinPartitions(key, "chunk", "kind")

    first = rows.mapInArrow(_first_level(quarter, window, owners, chunk_words), ROW)
    with staging(docs.sparkSession) as keep:  # until the second level is written
        short = keep(dealt(first, "owner").mapInArrow(_answers, ROW), "windows")
        second = dealt(short, "chunk").mapInArrow(_next_level(half - quarter, owners), ROW)
        long = stage(dealt(second, "owner").mapInArrow(_answers, ROW), "windows")
    last = dealt(long, "chunk").mapInArrow(_last_level(window - half, owners), ROW)
    settled = dealt(last, "owner").mapInArrow(_verdicts, ROW)
    return dealt(settled, "chunk").mapInArrow(_by_document, REPEAT_SCHEMA)


def covered(starts: bytes | None, words: int, window: int) -> np.ndarray:
    """Which words stand in a removed window."""
    edges = np.zeros(words + 1, dtype=np.int64)
    if starts is not None:
        (steps,) = unpack(starts)
        at = np.cumsum(steps, dtype=np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    return np.cumsum(edges[:-1]) > 0


def with_repeats(docs: DataFrame, window: int = 20, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` with ``repeat_starts``; every row stays, rows of equal id and text get the same."""
    found = repeated_windows(docs, window, chunk_words).dropDuplicates(["doc_id", "text_hash"]).select(
        F.col("doc_id").alias("repeat: doc_id"), F.col("text_hash").alias("repeat: text_hash"),
        F.col("starts").alias("repeat_starts"),
    )
    same = docs["doc_id"].cast("bigint").eqNullSafe(found["repeat: doc_id"]) & (
        F.xxhash64(docs["text"].cast("string")) == found["repeat: text_hash"]
    )
    return docs.join(found, same, "left").drop("repeat: doc_id", "repeat: text_hash")


def kept_words(text: str | None, starts: bytes | None, window: int) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were."""
    words = (text or "").encode().split()
    if starts is None:
        return words, len(words)
    gone = covered(starts, len(words), window)
    return [w for w, x in zip(words, gone.tolist(), strict=True) if not x], len(words)


def remove_repeats(docs: DataFrame, window: int = 20, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` with repeated words taken out of ``text``; texts without any stay as they are."""

    @F.pandas_udf("string")
    def cleaned(text, starts):
        return text.combine(starts, lambda t, s: t if s is None else b" ".join(
            kept_words(t, bytes(s), window)[0]).decode())

    marked = with_repeats(docs, window, chunk_words)
    return marked.withColumn("text", cleaned("text", "repeat_starts")).drop("repeat_starts")


DIGEST_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def digests(docs: DataFrame, window: int = 20, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Per document the number of words, of removed ones, and the SHA-256 of those that stay."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, starts in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                kept, count = kept_words(text, starts, window)
                rows.append((count, count - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    marked = with_repeats(rows, window, chunk_words).select("doc_id", "text", "repeat_starts")
    return marked.mapInArrow(run, DIGEST_SCHEMA)
