"""Product codes of vectors: exact integer clustering over Hilbert-sorted flat blocks.

Vectors become integers ``floor(SCALE * x)`` and are cut into ``PARTS`` equal consecutive parts, each with a
codebook of ``ENTRIES`` entries.  ``encode`` fits the codebooks in ``ROUNDS`` rounds over all vectors and then
gives every vector its code.

1.  Tasks gather their vectors into chunks.  In a chunk the points of each part are sorted along a Hilbert
    curve and cut into flat blocks of ``BLOCK`` points.  A block stores its points, the smallest and largest
    value of each position (its box) and the sums of its points.  Chunks are written once.
2.  In a round, an entry stays on the shortlist of a block if the least distance from it to the box is not
    above the least of the entries' largest distances to the box; no other entry can be the nearest of any
    point in it.  A block with one entry on its list adds its sums whole.  For the others, an integer kernel
    for each entry runs over the blocks that list it, and a nearer entry replaces a farther one, so that ties
    go to the lower index.  Integers are of 32 bits where all squares fit, else of 64.
3.  Tasks return one sum and count for each entry and position; these small sums give the next codebooks,
    which travel with the next round.  No vector is shuffled for a code.

Chunks hold at most ``CHUNK_CELLS`` integers, so a task's memory does not depend on its input.

Defined cases: a vector goes if it is null, empty, has a null or non-finite component, or another length than
the kept vector of smallest id; that length must be a multiple of ``PARTS``, vectors of other lengths go first.
Null ids come last among the smallest ids and equal ids are ordered by their vectors.  Fewer than ``ENTRIES``
kept vectors make smaller codebooks; repeated rows stay apart; an empty table gives no rows; other columns are
not read.  Components so large that squared distances exceed 63 bits raise a ValueError.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimeframe.storage import stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Points of a block, and integers of a chunk.
BLOCK = 32
CHUNK_CELLS = 1 << 21
#: Bits of a Hilbert key's words.
KEY_BITS = 64


def kept_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that can be coded."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.select(
        vectors[vec_id].cast("bigint").alias("vec_id"),
        vectors[label].alias("label"),
        vectors[vector].cast("array<double>").alias("vector"),
    )
    return rows.filter((F.size("vector") > 0) & (F.size("vector") % PARTS == 0) & finite)


def first_codebooks(kept: DataFrame, entries: int) -> np.ndarray:
    """(part, entry, position): the parts of the vectors of smallest ids."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not rows:
        return np.zeros((PARTS, 0, 0), np.int64)
    size = len(rows[0]["vector"])
    values = integers(np.array([r["vector"] for r in rows if len(r["vector"]) == size]))
    return values.reshape(len(values), PARTS, size // PARTS).transpose(1, 0, 2).copy()


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact as SCALE is a power of two."""
    scaled = np.floor(values * SCALE)
    if values.size and values.shape[1] * (2 * float(np.abs(scaled).max())) ** 2 >= 2.0**62:
        raise ValueError("components are too large for squared distances of 63 bits")
    return scaled.astype(np.int64)


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Rows of points (n x d) in the order of a Hilbert curve through their bounding box."""
    n, d = points.shape
    bits = max(1, KEY_BITS // d)
    low = points.min(axis=0)
    spread = int((points.max(axis=0) - low).max())
    shift = max(0, spread.bit_length() - bits)
    x = ((points - low) >> shift).astype(np.uint64).T.copy()
    bits = min(bits, max(1, spread.bit_length()))
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q, p = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(d):
            hit = (x[i] & q) != 0
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] >> np.uint64(bit)) & one, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    words, held = [np.zeros(n, np.uint64)], 0
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            if held == KEY_BITS:
                words.append(np.zeros(n, np.uint64))
                held = 0
            words[-1] = (words[-1] << one) | ((x[i] >> np.uint64(bit)) & one)
            held += 1
    return np.lexsort(words[::-1])


class Blocks:
    """The points of one part of a chunk in flat blocks; the last block is filled up with its last point."""

    def __init__(self, points: np.ndarray, n: int, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.points, self.n, self.low, self.high, self.sums = points, n, low, high, sums

    @classmethod
    def of(cls, sorted_points: np.ndarray) -> "Blocks":
        n, d = sorted_points.shape
        rows = np.minimum(np.arange(-(-n // BLOCK) * BLOCK), n - 1)
        points = sorted_points[rows].reshape(-1, BLOCK, d)
        sums = points.sum(axis=1)
        sums[-1] -= (len(rows) - n) * sorted_points[-1]
        return cls(points, n, points.min(axis=1), points.max(axis=1), sums)

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """(block, entry): may the entry be the nearest of a point in the block?"""
        low, high = self.low[:, None, :].astype(np.int64), self.high[:, None, :].astype(np.int64)
        outside = np.maximum(np.maximum(low - book, book - high), 0)
        across = np.maximum(np.abs(book - low), np.abs(high - book))
        least, most = (np.einsum("bed,bed->be", x, x) for x in (outside, across))
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, book: np.ndarray, lists: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, point): the nearest entry and its squared distance, for the blocks of ``some``."""
        reach = max(int(np.abs(self.low).max()), int(np.abs(self.high).max())) + int(np.abs(book).max())
        kind = np.int32 if book.shape[1] * reach**2 < 1 << 31 else np.int64
        points, lists, book = self.points[some].astype(kind, copy=False), lists[some], book.astype(kind)
        best = np.full(points.shape[:2], np.iinfo(kind).max, kind)
        entry = np.zeros(points.shape[:2], np.uint8)
        for e in range(len(book)):
            own = np.flatnonzero(lists[:, e])
            if len(own):
                away = points[own] - book[e]
                far = np.einsum("bpd,bpd->bp", away, away)
                nearer = far < best[own]
                best[own] = np.where(nearer, far, best[own])
                entry[own] = np.where(nearer, np.uint8(e), entry[own])
        return entry, best

    def totals(self, book: np.ndarray) -> np.ndarray:
        """(entry, position): sums of the points nearest to each entry, and at the end their counts."""
        entries, d = book.shape
        lists = self.shortlists(book)
        sizes = np.full(len(lists), BLOCK)
        sizes[-1] -= len(lists) * BLOCK - self.n
        alone = lists.sum(axis=1) == 1
        out = np.zeros((entries, d + 1), np.int64)
        owner = lists.argmax(axis=1)
        np.add.at(out[:, :d], owner[alone], self.sums[alone])
        np.add.at(out[:, d], owner[alone], sizes[alone])
        some = np.flatnonzero(~alone)
        if len(some):
            entry, _ = self.nearest(book, lists, some)
            real = np.arange(BLOCK) < sizes[some, None]
            entry, points = entry[real].astype(np.int64), self.points[some][real]
            out[:, d] += np.bincount(entry, minlength=entries)
            at = (entry[:, None] * d + np.arange(d)).ravel()
            # Sums of a chunk are whole numbers below 2 ** 53, so doubles hold them exactly.
            out[:, :d] += np.bincount(at, points.ravel(), entries * d).astype(np.int64).reshape(entries, d)
        return out

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of the n points, in sorted order."""
        lists = self.shortlists(book)
        entry, far = self.nearest(book, lists, np.arange(len(lists)))
        return entry.ravel()[: self.n], far.ravel()[: self.n]


def chunks(kept: DataFrame, size: int) -> DataFrame:
    """One row a chunk: ids, labels, and for all parts the places, points, boxes and sums of its blocks."""
    most = max(BLOCK, CHUNK_CELLS // size)
    d = size // PARTS

    def build(ids: list[pa.Array], labels: list[pa.Array], values: list[np.ndarray]) -> pa.RecordBatch:
        points = integers(np.concatenate(values))
        places, flat, boxes = [], [], []
        narrow = np.int32 if np.abs(points).max() < 1 << 31 else np.int64
        for part in range(PARTS):
            own = points[:, part * d : (part + 1) * d]
            order = hilbert_order(own)
            blocks = Blocks.of(own[order])
            places.append(order.astype("<u4").tobytes())
            flat.append(blocks.points.astype(narrow).tobytes())
            boxes.append(np.stack([blocks.low, blocks.high, blocks.sums]).tobytes())
        kinds = [pa.array([x]) for x in (len(points), np.dtype(narrow).itemsize)]
        blobs = [pa.array([b"".join(x)], pa.binary()) for x in (places, flat, boxes)]
        lists = [
            pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), pa.concat_arrays(x))
            for x in (ids, labels)
        ]
        return pa.RecordBatch.from_arrays([*lists, *kinds, *blobs], names)

    def run(batches: Iterator[pa.RecordBatch]):
        ids, labels, values, held = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                while piece.num_rows:
                    taken = piece.slice(0, most - held)
                    ids.append(taken.column(0))
                    labels.append(taken.column(1))
                    values.append(taken.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
                    held, piece = held + taken.num_rows, piece.slice(taken.num_rows)
                    if held == most:
                        yield build(ids, labels, values)
                        ids, labels, values, held = [], [], [], 0
        if held:
            yield build(ids, labels, values)

    names = ["ids", "labels", "n", "width", "places", "points", "boxes"]
    kind = kept.schema["label"].dataType.simpleString()
    schema = (
        f"ids array<bigint>, labels array<{kind}>, n bigint, width bigint, places binary, points binary, "
        "boxes binary"
    )
    rows = kept.filter(F.size("vector") == size).select("vec_id", "label", "vector")
    return rows.mapInArrow(run, schema)


def _parts(n: int, width: int, points: bytes, boxes: bytes, d: int) -> Iterator[Blocks]:
    count = -(-n // BLOCK)
    flat = np.frombuffer(points, f"<i{width}").reshape(PARTS, count, BLOCK, d)
    boxed = np.frombuffer(boxes, "<i8").reshape(PARTS, 3, count, d)
    for part in range(PARTS):
        yield Blocks(flat[part], n, *boxed[part])


def next_codebooks(staged: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the rounded-down mean of its points; entries without points stay."""
    d = books.shape[2]

    def run(batches):
        total = np.zeros((*books.shape[:2], d + 1), np.int64)
        for batch in batches:
            for n, width, points, boxes in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for part, blocks in enumerate(_parts(n, width, points, boxes, d)):
                    total[part] += blocks.totals(books[part])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "total"])

    summed = staged.select("n", "width", "points", "boxes").mapInArrow(run, "at bigint, total bigint")
    summed = summed.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = np.zeros(books.shape[0] * books.shape[1] * (d + 1), object)
    for row in summed.collect():  # at most one row for each entry and position
        totals[row["at"]] = int(row["total"])
    totals = totals.reshape(*books.shape[:2], d + 1)
    out = books.copy()
    for part, entry in zip(*np.nonzero(totals[:, :, d]), strict=True):
        out[part, entry] = [x // totals[part, entry, d] for x in totals[part, entry, :d]]
    return out


def fit(staged: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        books = next_codebooks(staged, books)
    return books


def assign(staged: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector."""
    d = books.shape[2]
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])])

    def run(batches):
        for batch in batches:
            own = [batch.column(i).to_pylist() for i in range(2, 7)]
            for row, (n, width, places, points, boxes) in enumerate(zip(*own, strict=True)):
                entry, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                order = np.frombuffer(places, "<u4").reshape(PARTS, n)
                for part, blocks in enumerate(_parts(n, width, points, boxes, d)):
                    found, far = blocks.codes(books[part])
                    entry[order[part], part] = found
                    error[order[part]] += far
                codes = ["".join(x) for x in digits[entry].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1).flatten(), batch.column(1).slice(row, 1).flatten(),
                     pa.array(codes, pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    kind = staged.schema["labels"].dataType.elementType.simpleString()
    columns = staged.select("ids", "labels", "n", "width", "places", "points", "boxes")
    return columns.mapInArrow(run, f"vec_id bigint, label {kind}, code string, error bigint")


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
           entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The codes (vec_id, label, code, error) and the codebooks (part, entry, position)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    kept = kept_vectors(vectors, vec_id, vector, label)
    books = first_codebooks(kept, entries)
    if not books.size:
        kind = kept.schema["label"].dataType.simpleString()
        schema = f"vec_id bigint, label {kind}, code string, error bigint"
        return vectors.sparkSession.createDataFrame([], schema), books
    staged = stage(chunks(kept, PARTS * books.shape[2]), "chunks")
    books = fit(staged, books, rounds)
    return assign(staged, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """With the error summed over equal labels; null labels are equal."""
    sums = codes.groupBy(F.col("label").alias("of")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    joined = codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select(*codes.columns, F.expr("try_cast(total as bigint)").alias("label_error"))


def sql(rounds: int = ROUNDS) -> str:
    """The query in DuckDB: rounds written out, distances by joins of components."""
    text = f"""
    with sound as (
      select vec_id, label, embedding, row_number() over (order by vec_id nulls last, embedding) - 1 as place
      from embeddings
      where len(embedding) > 0 and len(embedding) % {PARTS} = 0
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    ), rows as (
      select * from sound where len(embedding) = (select len(embedding) from sound where place = 0)
    ), cells as (
      select place, i // (size // {PARTS}) as part, i % (size // {PARTS}) as pos,
        floor({SCALE} * embedding[i + 1]::double)::bigint as v
      from (select place, embedding, len(embedding) as size, unnest(range(len(embedding))) as i from rows)
    ), book0 as (
      select part, dense_rank() over (order by place) - 1 as entry, pos, v from cells where place < {ENTRIES}
    )"""
    for r in range(rounds + 1):
        text += f""", near{r} as (
      select place, part, min(far * {ENTRIES} + entry) as best from (
        select c.place, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v))::bigint as far
        from cells c join book{r} b using (part, pos) group by all)
      group by all
    )"""
        if r < rounds:
            text += f""", mean{r} as (
      select c.part, best % {ENTRIES} as entry, pos, floor(sum(v) / count(*))::bigint as v
      from cells c join near{r} n using (place, part) group by all
    ), book{r + 1} as (
      select part, entry, pos, coalesce(m.v, b.v) as v from book{r} b left join mean{r} m using (part, entry, pos)
    )"""
    return text + f""", coded as (
      select place, sum(best // {ENTRIES})::bigint as error,
        string_agg(printf('%02x', (best % {ENTRIES})::bigint), '' order by part) as code
      from near{rounds} group by all
    ), books as (
      select sha256(string_agg(v::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from book{rounds}
    )
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
    from rows join coded using (place), books
    """
