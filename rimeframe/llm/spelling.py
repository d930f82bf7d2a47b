"""Spelling variants: words one edit apart, found by dense tiles of code points, and their usual forms.

Two words are near if one inserted, deleted or replaced code point tells them apart.  For words of
lengths ``c`` and ``c`` or ``c + 1`` that is: their common prefix and common suffix together reach the
longer length less one.  ``near_words`` finds all such pairs:

1.  Words meet in buckets of a class ``c``, which holds the words of ``c`` and ``c + 1`` code points.  With
    one edit, either the first ``c // 2`` or the last ``c - c // 2`` code points agree, so a word enters
    the bucket of its prefix and that of its suffix.
2.  A bucket of more than ``CROWDED`` rows is split by the same argument on the part that is still open:
    its words go on to buckets of a longer prefix and of a longer suffix, until the open part is one code
    point.  Then the alphabet bounds a bucket, so no prefix or suffix makes a task large.  The limits
    ``p <= common prefix < below`` and ``s <= common suffix`` of a bucket give every pair to one bucket.
3.  A task reads its rows sorted by bucket, cuts them into blocks and holds a block as two padded matrices
    of code points, one aligned left and one aligned right.  Pairs of blocks that share a bucket are
    compared column by column, which gives all common prefixes and suffixes of the tile at once.

A task hands on, for each row, how many near words it has in its bucket and the most frequent of them, so
pairs need not be shuffled.

Defined cases: null and empty texts have no words; a null doc_id reads as an empty string in the hash that
picks deletions; repeated rows count again; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimeframe.storage import stage

#: Letters of a word, and the shortest word and rarest word that is looked at.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One in so many distinct words of a document loses a code point; 0: none.
DROP_ONE_IN = 31
#: A form is so many times as frequent as its variant.
FORM_TIMES = 10
#: Rows of a bucket beyond which it is split.
CROWDED = 2048
#: Rows of a block at most, and cells that the matrices of a tile may have.
BLOCK = 256
TILE_CELLS = 1 << 23

BUCKET = ["c", "p", "s", "below", "h"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, drop_one_in: int = DROP_ONE_IN, least_length: int = LEAST_LENGTH,
          least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of whole texts, ASCII lower-cased, and their occurrences.

    The unsigned crc32 ``h`` of "doc_id:run" picks the runs that lose their code point ``h % length``.
    """
    text = F.translate(docs["text"].cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))).alias("run"),
    )
    if drop_one_in:
        runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        less = F.concat(F.expr("left(run, cast(h % char_length(run) as int))"), F.substr("run", at + 2))
        runs = runs.select(F.when(F.col("h") % drop_one_in == 0, less).otherwise(F.col("run")).alias("run"))
    return (
        runs.filter(F.char_length("run") >= least_length)
        .groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


def _placed(rows: DataFrame) -> DataFrame:
    """With ``h``, the hash of the first p and last s code points."""
    ends = F.expr("xxhash64(left(word, p), right(word, s))")
    return rows.withColumn("h", ends)


def _first_buckets(counted: DataFrame) -> DataFrame:
    def of(c: Column) -> list[Column]:
        half = F.floor(c / 2).cast("int")
        return [
            F.struct(c.alias("c"), half.alias("p"), F.lit(0).alias("s"), (c + 1).alias("below")),
            F.struct(c.alias("c"), F.lit(0).alias("p"), (c - half).alias("s"), half.alias("below")),
        ]

    size = F.char_length("word")
    places = F.explode(F.array(*of(size), *of(size - 1)))
    rows = counted.select("word", "n", places.alias("b")).select("word", "n", "b.*")
    return _placed(rows.filter("c > 0"))


def _split(rows: DataFrame) -> DataFrame:
    """Each row in the two buckets that part the pairs of its bucket by their common prefix."""
    rows = rows.withColumn("cut", F.expr("p + (c - p - s) div 2").cast("int")).drop("h")
    places = F.explode(F.array(
        F.struct(F.col("cut").alias("p"), F.col("s"), F.col("below")),
        F.struct(F.col("p"), (F.col("c") - F.col("cut")).alias("s"), F.least("below", "cut").alias("below")),
    ))
    rows = rows.select("word", "n", "c", places.alias("b")).select("word", "n", "c", "b.*")
    return _placed(rows.filter("p < below"))


def buckets(counted: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """word, n and its buckets; those with more than ``crowded`` rows are split as far as they can be."""
    level, done = _first_buckets(counted), None
    while True:
        sizes = level.filter("c - p - s > 1").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"))
        large = stage(sizes.filter(F.col("rows") > crowded).select(BUCKET), "crowded")
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        small = level.join(large, BUCKET, "left_anti")
        done = small if done is None else done.unionByName(small)
        level = stage(_split(level.join(large, BUCKET, "left_semi")).select("word", "n", *BUCKET), "split")


class Rows:
    """Words of whole buckets, as flat code points."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = batch.column(0)
        self.n = batch.column(1).to_numpy()
        places = [batch.column(i).to_numpy() for i in range(2, 7)]
        self.c, self.p, self.s, self.below, h = places
        texts = self.words.to_pylist()
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.flat = flat.astype(np.uint8) if len(flat) and flat.max() < 256 else flat
        self.ends = np.cumsum(self.sizes)
        kind = np.ones(len(texts), bool)
        kind[1:] = np.any([x[1:] != x[:-1] for x in places[:4]], axis=0)
        own = kind.copy()
        own[1:] |= h[1:] != h[:-1]
        #: The number of the bucket, and of the bounds that blocks share.
        self.bucket, self.kind = np.cumsum(own), np.cumsum(kind)

    def matrix(self, begin: int, end: int, width: int, from_end: bool) -> np.ndarray:
        sizes, ends = self.sizes[begin:end, None], self.ends[begin:end, None]
        column = np.arange(width)
        at = ends - 1 - column if from_end else ends - sizes + column
        return np.where(column < sizes, self.flat[np.clip(at, 0, len(self.flat) - 1)], 0)

    def blocks(self) -> list[tuple[int, int]]:
        """Runs of rows with the same bounds; fewer rows if their words are long."""
        edges = [0, *(np.flatnonzero(np.diff(self.kind)) + 1).tolist(), len(self.n)]
        out = []
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if end > begin:
                rows = max(1, min(BLOCK, isqrt(TILE_CELLS // (int(self.c[begin]) + 1))))
                out += [(x, min(end, x + rows)) for x in range(begin, end, rows)]
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows i < j of near words, tile by tile."""
        blocks = self.blocks()
        for x, (begin, end) in enumerate(blocks):
            c, p, s, below = (int(v[begin]) for v in (self.c, self.p, self.s, self.below))
            sides = [self.matrix(begin, end, c + 1, last) for last in (False, True)]
            long = self.sizes[begin:end] > c
            for other, (begin2, end2) in enumerate(blocks[x:]):
                if self.bucket[end - 1] != self.bucket[begin2] and other:
                    break
                tile = self.bucket[begin:end, None] == self.bucket[None, begin2:end2]
                long2 = self.sizes[begin2:end2] > c
                tile &= ~(long[:, None] & long2[None, :])
                if not other:
                    tile &= np.tri(end - begin, k=-1, dtype=bool).T
                if not tile.any():
                    continue
                common = [
                    _common(side, side if not other else self.matrix(begin2, end2, c + 1, last))
                    for last, side in zip((False, True), sides, strict=True)
                ]
                prefix, suffix = common
                longer = c + (long[:, None] | long2[None, :])
                tile &= (prefix >= p) & (prefix < below) & (suffix >= s) & (prefix + suffix >= longer - 1)
                i, j = np.nonzero(tile)
                if len(i):
                    yield i + begin, j + begin2


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows, how many first columns agree."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros(alive.shape, np.int16 if a.shape[1] < 1 << 14 else np.int64)
    for column in range(a.shape[1]):
        alive &= a[:, column, None] == b[None, :, column]
        if not alive.any():
            break
        out += alive
    return out


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """Batches of sorted rows, cut between buckets."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy() for i in range(2, 7)]
        turns = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
        if held and any(x[0] != y for x, y in zip(keys, held_key, strict=True)):
            turns = np.concatenate(([0], turns))
        if len(turns):
            cut = int(turns[-1])
            table = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            yield from map(Rows, table.to_batches())
            held, batch = [], batch.slice(cut)
        held, held_key = [*held, batch], [x[-1] for x in keys]
    if held:
        yield from map(Rows, pa.Table.from_batches(held).combine_chunks().to_batches())


def _by_bucket(counted: DataFrame, crowded: int) -> DataFrame:
    rows = buckets(counted, crowded).select("word", F.col("n").cast("bigint").alias("n"), *BUCKET)
    return rows.repartition(*BUCKET).sortWithinPartitions(*BUCKET)


def near_pairs(counted: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b): every pair of near words once.  ``counted`` has distinct words and their counts n."""

    def run(batches):
        for rows in _whole_buckets(batches):
            for i, j in rows.pairs():
                both = [rows.words.take(pa.array(x)) for x in (i, j)]
                yield pa.RecordBatch.from_arrays(both, ["a", "b"])

    return _by_bucket(counted, crowded).mapInArrow(run, "a string, b string")


def near_words(counted: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """word, n_near, and its near word of largest n (ties: smallest in code-point order), as near, near_n.

    Words without a near word are left out.
    """

    def run(batches):
        for rows in _whole_buckets(batches):
            found = list(rows.pairs())
            if not found:
                continue
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            row, other = np.concatenate([i, j]), np.concatenate([j, i])
            texts = rows.words.to_pylist()
            used = np.unique(other)
            best_first = sorted(used.tolist(), key=lambda k: (-rows.n[k], texts[k]))
            rank = np.zeros(len(texts), np.int64)
            rank[best_first] = np.arange(len(best_first))
            order = np.lexsort((rank[other], row))
            row, other = row[order], other[order]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            count = np.diff(np.append(first, len(row)))
            yield pa.RecordBatch.from_arrays(
                [rows.words.take(pa.array(row[first])), pa.array(count.astype(np.int64)),
                 rows.words.take(pa.array(other[first])), pa.array(rows.n[other[first]])],
                ["word", "n_near", "near", "near_n"])

    own = _by_bucket(counted, crowded).mapInArrow(run, "word string, n_near bigint, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return own.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of (word, form): the end of its chain of forms.

    A form is at least twice as frequent as its word, so chains end; each round doubles the steps taken.
    """
    known = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = known.join(ahead, "root", "left")
        known = stage(
            further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots")
        if known.filter("moved").isEmpty():
            return known.drop("moved")
        known = known.drop("moved")


def variants(docs: DataFrame, times: int = FORM_TIMES, crowded: int = CROWDED, **options) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word; ``options`` are those of ``words``."""
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its variant")
    counted = stage(words(docs, **options), "words")
    found = counted.join(near_words(counted, crowded), "word", "left")
    usual = F.col("near_n") >= times * F.col("n")
    found = stage(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(usual, F.col("near")).alias("form"), F.when(usual, F.col("near_n")).alias("form_n")),
        "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def sql() -> str:
    """The query in DuckDB: crc32 by its table, pairs by equal words without one code point."""
    return f"""
    with recursive crc as (
      select list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps
    ), runs as (
      select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all(
        translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]{{{LEAST_LENGTH},}}')) as run
      from documents
    ), own as (
      select doc, run, count(*) as n from runs group by all
    ), bytes as (
      select run, n, flatten(list_transform(string_split(doc || ':' || run, ''), lambda x:
        case when ord(x) < 128 then [ord(x)] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] end)) as b
      from own
    ), hashed as (
      select run, n, xor(list_reduce([4294967295] || b::bigint[], lambda c, x:
        xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) as h
      from bytes, crc
    ), words as (
      select case when h % {DROP_ONE_IN} = 0
        then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
        else run end as word, sum(n)::bigint as n
      from hashed group by 1
      having length(word) >= {LEAST_LENGTH} and sum(n) >= {LEAST_COUNT}
    ), less as (
      select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
      from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
    ), pairs as (
      select a.word, a.n, b.word as other, b.n as other_n from less a join less b
        on a.i = b.i and a.rest = b.rest and a.word <> b.word
      union
      select l.word, l.n, w.word, w.n from less l join words w on l.rest = w.word
      union
      select w.word, w.n, l.word, l.n from less l join words w on l.rest = w.word
    ), best as (
      select word, n, count(*) as n_near, max(other_n) as most from pairs group by all
    ), named as (
      select b.word, b.n_near, min(p.other) as near, b.most from best b join pairs p
        on p.word = b.word and p.other_n = b.most group by all
    ), forms as (
      select w.word, w.n, coalesce(n_near, 0) as n_near,
        case when most >= {FORM_TIMES} * w.n then near end as form,
        case when most >= {FORM_TIMES} * w.n then most end as form_n
      from words w left join named using (word)
    ), chains as (
      select word, word as root from forms where form is null
      union all
      select f.word, c.root from forms f join chains c on f.form = c.word
    )
    select word, n, n_near, form, form_n, root from forms join chains using (word)
    """
