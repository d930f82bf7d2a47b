"""Token-id files: canonical length-limited Huffman codes of ids, decoded by table.

A file is a head (magic, code lengths of all ids), blocks, and a directory of blocks and documents.
A block holds ``BLOCK_IDS`` ids, begins at a byte and is independent of others; its checkpoints give
the bit offset of every ``STRIDE``-th id, so a block is decoded from all checkpoints at once, one id
of each in a step.  Codes are canonical, so lengths are all that a reader needs.

Files hold documents in ascending doc_id order (null first, repeated ids by content), one file per
range of ids.  The table of files, written by Spark when all are complete, says which count.

Defined cases: a null or empty text is the end id alone; repeated rows are separate documents; an
empty table gives no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimeframe.llm.shared import folder_uri, open_for_reading, open_for_writing, packed_stage, stage
from rimeframe.llm.tokens import id_counts, id_type, token_ids

MAGIC = b"IDHUFF01"
LONGEST = 18
BLOCK_IDS = 1 << 16
STRIDE = 64
NULL_ID = -(1 << 63)
FILE_SCHEMA = "part bigint, file string, n_docs bigint, n_ids bigint"
DOCUMENT_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package-merge; 0 where a count is 0."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need codes longer than {longest} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, merged = [], leaves
    is_leaf = np.ones(len(leaves), dtype=bool)
    for _ in range(longest):
        levels.append(is_leaf)
        pairs = len(merged) // 2
        packages = merged[0 : 2 * pairs : 2] + merged[1 : 2 * pairs : 2]
        both = np.concatenate((leaves, packages))
        order = np.argsort(both, kind="stable")
        merged, is_leaf = both[order], order < len(leaves)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:take].sum())
        lengths[used[:taken]] += 1
        take = 2 * (take - taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        sizes = lengths[order].astype(np.int64)
        steps = (1 << (LONGEST - sizes)).astype(np.uint64)  # width of each code among the longest
        begins = np.cumsum(steps) - steps
        codes[order] = begins >> (LONGEST - sizes).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next ``LONGEST`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    width = 1 << (LONGEST - lengths[order].astype(np.int64))
    ids, sizes = np.repeat(order, width), np.repeat(lengths[order], width)
    rest = (1 << LONGEST) - len(ids)  # only where a single id is used
    pad = lambda x, v: np.concatenate((x, np.full(rest, v, dtype=x.dtype)))
    return pad(ids, 0).astype(np.uint32), pad(sizes, 1).astype(np.int64)


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """Number of ids and of bits, checkpoints (bits between them), bits (first ones high)."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    values, word = codes[ids], begins >> 6
    shift = 64 - (begins & 63) - sizes
    left = np.maximum(shift, 0).astype(np.uint64)
    right = np.maximum(-shift, 0).astype(np.uint64)
    out = np.zeros((int(ends[-1]) >> 6) + 2, dtype=np.uint64)
    firsts = np.concatenate(([0], np.flatnonzero(np.diff(word)) + 1))
    out[word[firsts]] = np.bitwise_or.reduceat((values >> right) << left, firsts)
    over = np.flatnonzero(shift < 0)
    out[word[over] + 1] |= values[over] << (64 + shift[over]).astype(np.uint64)
    total = int(ends[-1])
    points = np.diff(begins[::STRIDE]).astype("<u2")
    bits = out.astype(">u8").tobytes()[: (total + 7) // 8]
    return struct.pack("<II", len(ids), total) + points.tobytes() + bits


def decode_block(block: bytes, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of a block, a column of one id per checkpoint at a time."""
    count, _ = struct.unpack_from("<II", block)
    lanes = -(-count // STRIDE)
    points = np.frombuffer(block, "<u2", lanes - 1, 8).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(points)))
    data = np.frombuffer(block[8 + 2 * (lanes - 1) :] + bytes(4 + STRIDE * LONGEST // 8), np.uint8)
    wide = data.astype(np.uint32)
    peek = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    ids, sizes = table
    out = np.empty((lanes, STRIDE), dtype=np.uint32)
    low = np.uint32(32 - LONGEST)
    for step in range(STRIDE):
        look = (peek[at >> 3] << (at & 7).astype(np.uint32)) >> low
        out[:, step] = ids[look]
        at = at + sizes[look]
        np.minimum(at, (len(peek) - 1) << 3, out=at)  # behind the last id of the last lane
    return out.reshape(-1)[:count]


def _file_writer(folder: str, lengths: np.ndarray, dtype: str):
    codes = canonical_codes(lengths)
    head = zlib.compress(lengths.tobytes())

    def run(batches):
        part, waiting, held = TaskContext.get().partitionId(), [], 0
        doc_ids, sizes, blocks, out, opened, path = [], [], [], None, None, ""

        def flush(rest: bool):
            nonlocal waiting, held
            ids = np.concatenate(waiting) if len(waiting) != 1 else waiting[0]
            cut = 0
            while cut + BLOCK_IDS <= len(ids) or (rest and cut < len(ids)):
                block = encode_block(ids[cut : cut + BLOCK_IDS], lengths, codes)
                out.write(block)
                blocks.append(len(block))
                cut += BLOCK_IDS
            waiting = [ids[cut:]]
            held = len(waiting[0])

        for batch in batches:
            for doc_id, ids in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                if out is None:
                    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
                    opened = open_for_writing(path)
                    out = opened.__enter__()
                    out.write(MAGIC + struct.pack("<I", len(head)) + head)
                values = np.frombuffer(ids, dtype)
                doc_ids.append(NULL_ID if doc_id is None else doc_id)
                sizes.append(len(values))
                waiting.append(values)
                held += len(values)
                if held >= 8 * BLOCK_IDS:
                    flush(False)
        if out is not None:
            flush(True)
            directory = zlib.compress(
                np.array(blocks, "<i8").tobytes() + np.array(doc_ids, "<i8").tobytes()
                + np.array(sizes, "<i8").tobytes()
            )
            out.write(directory)
            out.write(struct.pack("<QQQ", len(blocks), len(doc_ids), len(directory)) + MAGIC)
            opened.__exit__(None, None, None)
            yield pa.RecordBatch.from_pydict({
                "part": [part], "file": [path], "n_docs": [len(doc_ids)], "n_ids": [sum(sizes)],
            })

    return run


def write_files(docs: DataFrame, path: str) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; one row per file."""
    spark, dtype = docs.sparkSession, id_type(path)
    tokens = packed_stage(token_ids(docs, path), "token-ids")
    counted = id_counts(tokens, dtype).collect()  # at most one row per id of the vocabulary
    counts = np.zeros(max([row["id"] for row in counted], default=0) + 1, dtype=np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        tokens.select("doc_id", "ids")
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    )
    write = _file_writer(folder_uri(spark, "id-files"), code_lengths(counts), dtype)
    return stage(ordered.mapInArrow(write, FILE_SCHEMA), "id-file-table")


def _documents(path: str, base: int, with_ids: bool):
    """Documents of one file, block by block."""
    with open_for_reading(path) as file:
        size = file.size()
        tail = struct.calcsize("<QQQ") + len(MAGIC)
        file.seek(size - tail)
        n_blocks, n_docs, packed = struct.unpack("<QQQ", file.read(tail)[: -len(MAGIC)])
        file.seek(size - tail - packed)
        numbers = np.frombuffer(zlib.decompress(file.read(packed)), "<i8")
        blocks, doc_ids, sizes = np.split(numbers, [n_blocks, n_blocks + n_docs])
        file.seek(0)
        head = file.read(len(MAGIC) + 4)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        lengths = np.frombuffer(zlib.decompress(file.read(struct.unpack("<I", head[-4:])[0])), "u1")
        table = decode_table(lengths)
        starts = np.cumsum(sizes) - sizes
        doc, crc, kept, done = 0, 0, [], 0
        for length in blocks.tolist():
            ids = decode_block(file.read(length), table)
            at = 0
            while at < len(ids):
                take = min(int(sizes[doc]) - done, len(ids) - at)
                piece = ids[at : at + take].astype("<u4").tobytes()
                crc = zlib.crc32(piece, crc)
                if with_ids:
                    kept.append(piece)
                at, done = at + take, done + take
                if done == sizes[doc]:
                    doc_id = int(doc_ids[doc])
                    yield (None if doc_id == NULL_ID else doc_id, base + int(starts[doc]),
                           int(sizes[doc]), crc, b"".join(kept) if with_ids else None)
                    doc, crc, kept, done = doc + 1, 0, [], 0


def read_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (unsigned 32-bit) from the files."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.binary()),
    ])

    def pack(rows):
        columns = dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True))
        return pa.RecordBatch.from_pydict(columns, schema)

    def run(batches):
        for batch in batches:
            for path, base in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                rows, held = [], 0
                for row in _documents(path, base, with_ids):
                    rows.append(row)
                    held += 64 + len(row[4] or b"")
                    if held > 1 << 23:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(parts, "file").mapInArrow(run, DOCUMENT_SCHEMA)
