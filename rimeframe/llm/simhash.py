"""SimHash fingerprints and their groups, found by pigeonring chains.

Fingerprints are 64 bits cut into ``SEGMENTS`` on a ring.  If two differ in at most ``k`` bits, then
from some segment on every chain of 1, 2, ... consecutive segments differs in at most
``length * k / SEGMENTS`` bits.  With five segments and k = 4 the first segment must be equal and the
second differ in at most one bit: that is the bucket key.  The longer chains are checked in the
bucket, then the whole distance.

Only distinct fingerprints are compared, a bucket emits a spanning forest of its links instead of
all pairs, and a bucket with many members is cut into blocks that are compared as separate groups.

Defined cases: no words (null or blank text) is fingerprint zero, linked like any other; equal
fingerprints are one group whatever the texts; rows with a null doc_id are members but never name a
group unless all its ids are null; repeated rows stay repeated; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimeframe.llm.shared import components, stage

SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
SEGMENTS = len(WIDTHS)
STARTS = tuple(sum(WIDTHS[:i]) for i in range(SEGMENTS))
#: Distinct fingerprints of one bucket that a block holds.
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 21
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    begin, end = starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, last, HASHES_AT_ONCE):
        hashes = np.array(
            [digest(joined[a:b], SEED)
             for a, b in zip(begin[i : i + HASHES_AT_ONCE], end[i : i + HASHES_AT_ONCE],
                             strict=True)],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits((2 * counts > last).astype(np.uint8), bitorder="little")
    return int(set_bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id") -> DataFrame:
    """(id, fp): one row per document, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(x, shingle) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"]
            )

    rows = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    return (fp >> np.uint64(STARTS[i])) & np.uint64((1 << WIDTHS[i]) - 1)


def _exact_keys(fp: np.ndarray, i: int) -> np.ndarray:
    second = (i + 1) % SEGMENTS
    return (
        (np.uint64(i) << np.uint64(26))
        | (_segment(fp, i) << np.uint64(WIDTHS[second]))
        | _segment(fp, second)
    )


def _bucket_rows(exact_only: bool):
    """Keys of each fingerprint: its own, and those with one set bit of the second segment cleared.

    Of two fingerprints that differ there in one bit, one has it set; so one side is enough.
    """

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for i in range(SEGMENTS):
                key = _exact_keys(fp, i)
                keys, owners, roles = [key], [fp], [np.zeros(len(fp), np.int32)]
                for bit in range(0 if exact_only else WIDTHS[(i + 1) % SEGMENTS]):
                    has = (key >> np.uint64(bit)) & np.uint64(1) == 1
                    keys.append(key[has] ^ np.uint64(1 << bit))
                    owners.append(fp[has])
                    roles.append(np.ones(int(has.sum()), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)),
                     pa.array(np.concatenate(roles)),
                     pa.array(np.concatenate(owners).view(np.int64))],
                    ["key", "role", "fp"],
                )

    return run


def _chain_masks(i: int) -> list[np.uint64]:
    """Bits of the chains of 1, 2, ... segments from ``i`` on."""
    masks, bits = [], 0
    for step in range(SEGMENTS):
        j = (i + step) % SEGMENTS
        bits |= ((1 << WIDTHS[j]) - 1) << STARTS[j]
        masks.append(np.uint64(bits))
    return masks


MASKS = np.array([_chain_masks(i) for i in range(SEGMENTS)], dtype=np.uint64)


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one that it reaches."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (a, b):
            np.minimum.at(new, root[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _links_of(key, side, fp, group, distance: int):
    """Linked pairs among rows sorted by group and side; rows of side 0 pair with all after them."""
    n = len(key)
    end = np.searchsorted(group, group, side="right")
    left = np.flatnonzero(side == 0)
    partners = end[left] - left - 1
    left, partners = left[partners > 0], partners[partners > 0]
    for lo, hi in _portions(partners):
        some, counts = left[lo:hi], partners[lo:hi]
        one = np.repeat(some, counts)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        two = one + 1 + (np.arange(len(one)) - first)
        differ = fp[one] ^ fp[two]
        i = (key[one] >> np.uint64(26)).astype(np.int64)
        good = differ != 0
        for step in range(2, SEGMENTS + 1):
            counted = np.bitwise_count(differ & MASKS[i, step - 1])
            good &= counted <= (step * distance) // SEGMENTS
        yield fp[one[good]], fp[two[good]]


def _portions(counts):
    """Ranges of rows whose pairs fit in memory together."""
    lo, total = 0, 0
    for at, c in enumerate(counts.tolist()):
        if total and total + c > PAIRS_AT_ONCE:
            yield lo, at
            lo, total = at, 0
        total += c
    if total:
        yield lo, len(counts)


def _linker(distance: int):
    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            last = np.ones(len(now[0]), dtype=bool)
            for x in now[:3]:
                last &= x == x[-1]
            cut = int(np.argmax(last))
            held = [x[cut:] for x in now]
            if cut:
                yield from _forest([x[:cut] for x in now], distance)
        if held is not None:
            yield from _forest(held, distance)

    return run


def _forest(columns, distance: int):
    key, a, b, side, fp = columns
    change = np.flatnonzero(
        (np.diff(key) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
    )
    group = np.zeros(len(key), dtype=np.int64)
    group[change + 1] = 1
    group = np.cumsum(group)
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for one, two in _links_of(key.view(np.uint64), side, fp.view(np.uint64), group, distance):
        u, v = spanning(
            np.concatenate((u, one.view(np.int64))), np.concatenate((v, two.view(np.int64)))
        )
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (u, v) that connect all fingerprints (column ``fp``, distinct) at ``distance`` or less.

    The bucket key needs the first segment equal and one bit in the second: distance 3 or 4 bits.
    """
    if not SEGMENTS > distance >= 0:
        raise ValueError("the bucket keys are made for distances below the number of segments")
    keys = "key bigint, role int, fp bigint"
    rows = distinct.select("fp").mapInArrow(_bucket_rows(False), keys)
    members = distinct.select("fp").mapInArrow(_bucket_rows(True), keys).groupBy("key").count()
    crowded = members.filter(F.col("count") > BLOCK).select(
        "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")
    )
    placed = rows.join(crowded, "key", "left").withColumns({
        "blocks": F.coalesce("blocks", F.lit(1)),
        "own": F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"),
    })
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_left = F.transform(all_blocks, lambda b: F.struct(
        F.col("own").alias("a"), b.alias("b"), F.lit(0).alias("side")))
    before = F.filter(all_blocks, lambda a: a < F.col("own"))
    as_right = F.transform(before, lambda a: F.struct(
        a.alias("a"), F.col("own").alias("b"), F.lit(1).alias("side")))
    as_variant = F.transform(all_blocks, lambda a: F.struct(
        a.alias("a"), F.col("own").alias("b"), F.lit(2).alias("side")))
    # left block a meets right block b; an exact pair of two blocks meets once, in (smaller, larger)
    left_units = F.filter(as_left, lambda x: x["b"] >= F.col("own"))
    variant_only = F.filter(as_left, lambda x: x["b"] < F.col("own"))
    units = F.when(F.col("role") == 0, F.concat(left_units, variant_only, as_right)).otherwise(
        as_variant)
    dealt = (
        placed.select("key", "fp", F.inline(units))
        .select("key", "a", "b", "side", "fp")
        .repartition("key", "a", "b")
        .sortWithinPartitions("key", "a", "b", "side", "fp")
    )
    return dealt.mapInArrow(_linker(distance), "u bigint, v bigint")


def groups(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id"
) -> DataFrame:
    """doc_id, fp and component_id for every row of ``docs``."""
    fps = stage(with_fingerprints(docs, shingle, id_column), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes, distance))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` without all but the smallest doc_id of each group; columns as they were.

    Of rows with that doc_id one stays.  A null doc_id stands behind all others; texts tell such
    rows apart.
    """
    key, nth = "kept by simhash: key", "kept by simhash: place"
    stand_in = F.shiftrightunsigned(F.xxhash64(docs["text"]), 2) + (1 << 62)
    keyed = docs.withColumn(key, F.coalesce(docs["doc_id"].cast("bigint"), stand_in))
    chosen = groups(keyed, shingle, distance, key).select(
        F.col("component_id").alias(key)).distinct()
    place = Window.partitionBy(key).orderBy(F.xxhash64("text"))
    numbered = keyed.withColumn(nth, F.row_number().over(place)).filter(F.col(nth) == 1)
    return numbered.join(chosen, key, "left_semi").select(*docs.columns)
