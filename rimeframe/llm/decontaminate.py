"""Benchmark passages in documents: latent semantic retrieval, then sequence and answer checks.

1. Passages of ``PASSAGE`` words are rows of a TF-IDF matrix over ``FEATURES`` hashed words.  One pass
   over all documents gives document frequencies and the product with a random test matrix; both add
   up over tasks, and a Nystroem step turns their sum into the leading right singular vectors and
   values (a randomised SVD of the whole corpus).
2. Overlapping passages of every whole text are projected (singular values divided out, so frequent
   words don't drown the others) and compared by cosine with the windows of all benchmark items, as
   blocks of a matrix product.  Items of less than 16 words are compared with passages of 8 or 4
   words.  Pairs from ``LEAST_COSINE`` on (less for windows shorter than the passage) that share
   enough words are candidates.
3. A candidate is a leak if the longest common subsequence of the item and the text around the
   passage is ``LEAST_SHARE`` of the item, and that of the item's answer (what follows the last
   question mark, else its last quarter) is ``LEAST_ANSWER`` of the answer.

What leaves the tasks of step 1 is one FEATURES x RANK matrix each.  The benchmark is broadcast in
slices of about ``ITEMS_AT_ONCE`` items, whatever its size.

Defined cases: null and blank texts and items match nothing, nor do items of less than
``LEAST_ITEM_WORDS`` words, which common phrases contain by chance; of several places the best is given;
a repeated document gives repeated rows, an item repeated with its id none more; a null item_id or doc_id
is given as null; rows without an id, or with one that other rows have, are told apart by their texts;
an empty benchmark or an empty corpus gives no rows; other columns are kept by ``remove_leaks``.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 16
STRIDE = 8
QUERY_STRIDE = 4
FEATURES = 1 << 14
RANK = 48
OVERSAMPLE = 8
SEED = 11
LEAST_COSINE = 0.5
#: Words that a passage and a window must share, as a part of the window's.
LEAST_COMMON = 0.5
LEAST_SHARE = 0.7
LEAST_ANSWER = 0.5
LEAST_ITEM_WORDS = 4
#: Lengths and strides of passages, stride of windows, and the words of an item from which they hold.
LENGTHS = (
    (PASSAGE, STRIDE, QUERY_STRIDE, PASSAGE),
    (8, 2, 1, 8),
    (4, 1, 1, LEAST_ITEM_WORDS),
)
ITEMS_AT_ONCE = 2048
BYTES_AT_ONCE = 900_000
ROWS_AT_ONCE = 2048
BLOCKS = 64
MANY_ENTRIES = 48

OUTER = b".,;:!?\"'()[]{}<>*#$%&|-_~`"


@functools.lru_cache(maxsize=1 << 16)
def normal(word: bytes) -> bytes:
    return word.translate(None, OUTER)


#: What each byte is: 0 white space, 1 punctuation that words are compared without, 2 other.
BYTE_KIND = np.full(256, 2, dtype=np.uint8)
BYTE_KIND[list(OUTER)] = 1
BYTE_KIND[[9, 10, 11, 12, 13, 32]] = 0
ODD = np.uint64(0x9E3779B97F4A7C15)
LONGEST_RUN = 1 << 20
POWERS = np.cumprod(np.full(LONGEST_RUN, ODD, dtype=np.uint64))
INVERSES = np.cumprod(np.full(LONGEST_RUN, pow(int(ODD), -1, 1 << 64), dtype=np.uint64))


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode()


def features_of(texts: list[bytes]) -> list[np.ndarray]:
    """The hashed feature of every word of every text: a polynomial of its bytes.

    Texts are hashed side by side; a long one is taken in runs that end at a space.
    """
    out, some, size = [], [], 0
    for text in texts:
        if len(text) >= LONGEST_RUN // 2:
            out += _features(some) if some else []
            some, size = [], 0
            parts = []
            while len(text) >= LONGEST_RUN // 2:
                cut = max(text.rfind(c, 0, LONGEST_RUN // 2) for c in (b" ", b"\n", b"\t"))
                cut = cut if cut > 0 else LONGEST_RUN // 2
                parts.append(_features([text[:cut]])[0])
                text = text[cut:]
            out.append(np.concatenate([*parts, _features([text])[0]]))
            continue
        if size + len(text) + 1 > LONGEST_RUN:
            out += _features(some)
            some, size = [], 0
        some.append(text)
        size += len(text) + 1
    return out + (_features(some) if some else [])


def _features(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    kind = BYTE_KIND[data]
    space = kind == 0
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not space[0]:
        starts = np.concatenate(([0], starts))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    counted = kind == 2
    sums = np.cumsum(np.where(counted, data, 0) * POWERS[: len(data)])
    sums = np.concatenate((np.zeros(1, np.uint64), sums))
    first = starts
    odd = np.flatnonzero(~counted[starts])
    if len(odd):  # words that begin with punctuation count from their first other byte
        first = starts.copy()
        at = np.flatnonzero(counted)
        after = np.searchsorted(at, starts[odd])
        first[odd] = np.minimum(at[np.minimum(after, max(0, len(at) - 1))], ends[odd]) if len(at) else (
            starts[odd])
    value = (sums[ends] - sums[starts]) * INVERSES[np.minimum(first, len(data) - 1)]
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    found = ((value >> np.uint64(40)) % np.uint64(FEATURES)).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    edges = np.searchsorted(starts, np.cumsum(sizes)[:-1])
    return np.split(found, edges)


def test_matrix() -> np.ndarray:
    return np.random.RandomState(SEED).randn(FEATURES, RANK + OVERSAMPLE).astype(np.float32)


def _add_rows(total: np.ndarray, row: np.ndarray, product: np.ndarray, place: np.ndarray) -> None:
    """total[row] += product[place] for sorted, repeated rows.

    Rows with many entries are summed one by one, all others side by side, an entry of each at a time.
    """
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    counts = np.diff(np.append(starts, len(row)))
    for at in np.flatnonzero(counts > MANY_ENTRIES).tolist():
        begin = starts[at]
        total[row[begin]] += product[place[begin : begin + counts[at]]].sum(axis=0)
    few = counts <= MANY_ENTRIES
    starts, counts = starts[few], counts[few]
    sums = np.zeros((len(starts), product.shape[1]), np.float32)
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    for k in range(int(counts[0]) if len(counts) else 0):
        n = int(np.searchsorted(-counts, -k, side="left"))  # those with more than k entries
        sums[:n] += product[place[starts[:n] + k]]
    total[row[starts]] += sums


def _gathered(batches):
    """Passages' counts of features: those of a passage in one piece of a text, without overlap."""
    omega = np.concatenate((test_matrix(), np.zeros((1, RANK + OVERSAMPLE), np.float32)))
    total = np.zeros((FEATURES, RANK + OVERSAMPLE + 1), dtype=np.float64)
    passages, waiting, size = 0, [], 0

    def add():
        nonlocal passages
        held = features_of(waiting)
        counts = np.array([-(-len(f) // PASSAGE) for f in held], dtype=np.int64)
        begins = (np.cumsum(counts) - counts) * PASSAGE
        flat = np.full(int(counts.sum()) * PASSAGE, FEATURES, dtype=np.int64)
        for begin, f in zip(begins.tolist(), held, strict=True):
            flat[begin : begin + len(f)] = f
        if len(flat) == 0:
            return
        words = flat.reshape(-1, PASSAGE)
        product = omega[words[:, 0]]
        for j in range(1, PASSAGE):
            product += omega[words[:, j]]
        real = np.flatnonzero(flat < FEATURES)
        keys = np.sort((flat[real] << 32) | (real // PASSAGE))
        row, place = keys >> 32, keys & 0xFFFFFFFF
        _add_rows(total[:, :-1], row, product, place)
        once = np.concatenate(([True], keys[1:] != keys[:-1]))
        total[:, -1] += np.bincount(row[once], minlength=FEATURES)
        passages += len(words)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            waiting.append(folded(text))
            size += len(waiting[-1])
            if size >= BYTES_AT_ONCE:
                add()
                waiting, size = [], 0
    if waiting:
        add()
    if passages:
        blocks = np.split(total.astype(np.float32), BLOCKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([passages] * BLOCKS, pa.int64()),
             pa.array([x.tobytes() for x in blocks], pa.binary())],
            ["block", "passages", "body"],
        )


def _summed(batches):
    """Blocks of a task added up."""
    found: dict[int, list] = {}
    for batch in batches:
        for block, passages, body in zip(
            *(batch.column(i).to_pylist() for i in range(3)), strict=True
        ):
            values = np.frombuffer(body, np.float32).astype(np.float64)
            if block in found:
                found[block][0] += passages
                found[block][1] += values
            else:
                found[block] = [passages, values]
    for block, (passages, values) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([passages], pa.int64()),
             pa.array([values.astype(np.float32).tobytes()], pa.binary())],
            ["block", "passages", "body"],
        )


def latent_space(docs: DataFrame) -> np.ndarray | None:
    """FEATURES x RANK: a word's IDF-weighted place in the whitened latent space of all passages."""
    schema = "block int, passages bigint, body binary"
    parts = docs.select(docs["text"].cast("string")).mapInArrow(_gathered, schema)
    rows = parts.repartition(BLOCKS, "block").mapInArrow(_summed, schema).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["block"])
    width = RANK + OVERSAMPLE + 1
    total = np.concatenate([np.frombuffer(r["body"], np.float32).reshape(-1, width) for r in rows])
    total = total.astype(np.float64)
    idf = np.maximum(np.log((rows[0]["passages"] + 1) / (total[:, -1] + 1)), 0.05)
    product = total[:, :-1] * idf[:, None]
    core = (test_matrix() / idf[:, None]).T @ product
    q, r = np.linalg.qr(product)
    small = r @ np.linalg.pinv((core + core.T) / 2) @ r.T
    values, turned = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:RANK]
    good = best[values[best] > values.max() * 1e-9]
    return (q @ turned[:, good] * idf[:, None] / np.sqrt(values[good])).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-9)


class Item:
    def __init__(self, item_id: int, text: str):
        raw = folded(text).split()
        self.item_id = item_id
        words = [normal(w) for w in raw]
        asked = [i for i, w in enumerate(raw[:-1]) if w.endswith(b"?")]
        answer = asked[-1] + 1 if asked else len(raw) - max(1, len(raw) // 4)
        self.words = words
        self.all = masks(words)
        self.answer = masks(words[answer:])
        self.n_answer = len(words) - answer


def masks(words: list[bytes]) -> dict[bytes, int]:
    found: dict[bytes, int] = {}
    for i, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << i
    return found


def common_length(bits: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as one integer."""
    row = full = (1 << size) - 1
    for w in words:
        match = bits.get(w)
        if match:
            low = row & match
            row = ((row + low) | (row - low)) & full
    return size - row.bit_count()


class Windows:
    """Windows of items, to be compared with passages of one length."""

    def __init__(self, length: int, stride: int, parts: list[np.ndarray], owner: list[int], space):
        self.length, self.stride, self.space = length, stride, space
        self.owner = np.array(owner, dtype=np.int64)
        self.windows = np.full((len(parts), length), -1, dtype=np.int64)
        for window, part in zip(self.windows, parts, strict=True):
            window[: len(part)] = part
        self.sizes = (self.windows >= 0).sum(axis=1)
        self.valid = (self.windows >= 0).astype(np.uint64)
        self.shifts = (self.windows & 63).astype(np.uint64)
        # k words among others have a cosine of about sqrt(k / length) with the k words alone
        self.limits = (LEAST_COSINE * np.sqrt(self.sizes / length)).astype(np.float32)
        at = np.where(self.windows < 0, FEATURES, self.windows)
        self.queries = np.ascontiguousarray(_unit(self.space[at].sum(axis=1)).T)
        #: Words of any window, and how many of them a passage needs to share enough with some window.
        self.known = np.zeros(FEATURES + 1, dtype=bool)
        self.known[self.windows[self.windows >= 0]] = True
        self.least_known = min(map(self._least_different, self.windows), default=0)

    def _least_different(self, window: np.ndarray) -> int:
        """How many different words make up the wanted part of a window, taking its most repeated first."""
        own = window[window >= 0]
        repeats = np.sort(np.unique(own, return_counts=True)[1])[::-1]
        return int(np.searchsorted(np.cumsum(repeats), LEAST_COMMON * len(own))) + 1

    def candidates(self, features: list[np.ndarray]):
        """Arrays of (document, item, begin of the passage, cosine)."""
        stride, n = self.stride, self.length // self.stride
        counts = [max(n, -(-len(f) // stride)) for f in features]
        flat = np.full(sum(counts) * stride, FEATURES, dtype=np.int64)
        base = (np.cumsum(counts) - counts) * stride
        for b, f in zip(base.tolist(), features, strict=True):
            flat[b : b + len(f)] = f
        rows = flat.reshape(-1, stride)
        doc = np.repeat(np.arange(len(features)), counts)
        first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
        shared = np.cumsum(np.concatenate(([0], self.known[flat].reshape(-1, stride).sum(axis=1))))
        first = first[shared[first + n] - shared[first] >= self.least_known]
        used = np.zeros(len(rows) + n, dtype=bool)
        for k in range(n):
            used[first + k] = True
        used = np.flatnonzero(used[: len(rows)])
        place = np.zeros(len(rows), dtype=np.int64)
        place[used] = np.arange(len(used))
        some_rows = rows[used]
        pieces = self.space[some_rows[:, 0]]
        marks = np.uint64(1) << (some_rows[:, 0] & 63).astype(np.uint64)
        for j in range(1, stride):
            pieces += self.space[some_rows[:, j]]
            marks |= np.uint64(1) << (some_rows[:, j] & 63).astype(np.uint64)
        found = []
        for lo in range(0, len(first), ROWS_AT_ONCE):
            some = first[lo : lo + ROWS_AT_ONCE]
            passages, held = pieces[place[some]], marks[place[some]]
            for k in range(1, n):
                passages, held = passages + pieces[place[some + k]], held | marks[place[some + k]]
            likeness = _unit(passages) @ self.queries
            p, q = np.divmod(np.flatnonzero((likeness >= self.limits).ravel()), likeness.shape[1])
            for cut in range(0, len(p), ROWS_AT_ONCE):
                pp, qq = p[cut : cut + ROWS_AT_ONCE], q[cut : cut + ROWS_AT_ONCE]
                bits = held[pp][:, None] >> self.shifts[qq]
                most = (bits & self.valid[qq]).sum(axis=1)  # no less than the words in common
                ok = most >= LEAST_COMMON * self.sizes[qq]
                pp, qq = pp[ok], qq[ok]
                here = rows[some[pp][:, None] + np.arange(n)].reshape(len(pp), self.length)
                both = (self.windows[qq][:, :, None] == here[:, None, :]).any(axis=2).sum(axis=1)
                ok = both >= LEAST_COMMON * self.sizes[qq]
                pp, qq = pp[ok], qq[ok]
                at = some[pp]
                found.append(np.column_stack((
                    doc[at], self.owner[qq], at * stride - base[doc[at]], likeness[pp, qq])))
        return found


class Searcher:
    """One slice of the benchmark, ready to be compared with documents."""

    def __init__(self, items: list[tuple[int, str]], space: np.ndarray):
        space = np.concatenate((space, np.zeros((1, space.shape[1]), np.float32)))
        self.items = []
        parts = {length: ([], []) for length, *_ in LENGTHS}
        for item_id, text in items:
            features = features_of([folded(text)])[0]
            if len(features) < LEAST_ITEM_WORDS:
                continue
            length, step = next((n, s) for n, _, s, least in LENGTHS if len(features) >= least)
            last = max(0, len(features) - length)
            own = [features[start : start + length]
                   for start in sorted({*range(0, last + 1, step), last})]
            if PASSAGE <= len(features) < PASSAGE + STRIDE:
                # no passage need lie inside such an item: its ends are looked for as well
                own += [features[: PASSAGE - STRIDE // 2], features[STRIDE // 2 - PASSAGE :]]
            parts[length][0].extend(own)
            parts[length][1].extend([len(self.items)] * len(own))
            self.items.append(Item(item_id, text))
        self.lengths = [
            Windows(n, stride, *parts[n], space) for n, stride, *_ in LENGTHS if parts[n][0]]

    def candidates(self, features: list[np.ndarray]):
        """(document, item, begin of the passage, cosine), by document and item."""
        found = [x for windows in self.lengths for x in windows.candidates(features)]
        if not found:
            return np.empty((0, 4))
        every = np.concatenate(found)
        return every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]

    def leaks(self, texts: list[bytes]):
        """(document, item, begin, end, cosine, share, answer share): the best place of each pair."""
        every = self.candidates(features_of(texts))
        if len(every) == 0:
            return
        held, words = -1, []
        pairs = np.flatnonzero((np.diff(every[:, :2], axis=0, prepend=-1) != 0).any(axis=1))
        for a, b in zip(pairs.tolist(), [*pairs[1:].tolist(), len(every)], strict=True):
            doc, item = int(every[a, 0]), self.items[int(every[a, 1])]
            if doc != held:
                held, words = doc, texts[doc].split()
            reach, best, from_place = len(item.words), None, 0
            least, least_answer = math.ceil(LEAST_SHARE * reach), math.ceil(LEAST_ANSWER * item.n_answer)
            for place, cosine in every[a:b, 2:]:
                begin = max(0, int(place) - reach)
                end = min(len(words), int(place) + PASSAGE + reach)
                if place < from_place:
                    continue
                text = [normal(w) for w in words[begin:end]]
                common = common_length(item.all, reach, text)
                if common < least:  # a place n words on has at most n more in common
                    from_place = place + least - common
                    continue
                answer = common_length(item.answer, item.n_answer, text)
                if answer < least_answer:
                    from_place = place + least_answer - answer
                    continue
                from_place = place + reach // 2 + 1
                if best is None or common / reach > best[3]:
                    best = (begin, end, float(cosine), common / reach, answer / item.n_answer)
            if best is not None:
                yield doc, item.item_id, *best


HIT_SCHEMA = """doc_id bigint, item_id bigint, begin_word bigint, end_word bigint, cosine double,
    share double, answer_share double"""
HIT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("begin_word", pa.int64()),
    ("end_word", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()),
    ("answer_share", pa.float64()),
])


#: With the hash of the document's text, which tells rows of equal ids apart.
FOUND_SCHEMA = HIT_SCHEMA + ", text_hash bigint"
FOUND_ARROW = HIT_ARROW.append(pa.field("text_hash", pa.int64()))


def _row_key(docs: DataFrame) -> list[Column]:
    return [
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.xxhash64(docs["text"].cast("string")).alias("text_hash"),
    ]


def _search(docs: DataFrame, items: list[tuple[int, str]], space: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((items, space))  # bounded: see ITEMS_AT_ONCE

    def run(batches):
        searcher = Searcher(*shared.value)

        def finish(ids, texts):
            rows = [(ids[d][0], *rest, ids[d][1]) for d, *rest in searcher.leaks(texts)]
            columns = list(zip(*rows, strict=True)) or [()] * len(FOUND_ARROW)
            arrays = [pa.array(c, t) for c, t in zip(columns, FOUND_ARROW.types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=FOUND_ARROW)

        for batch in batches:
            ids, texts, held = [], [], 0
            for *key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(key)
                texts.append(folded(text))
                held += len(texts[-1])
                if held >= BYTES_AT_ONCE:
                    yield finish(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield finish(ids, texts)

    return docs.select(*_row_key(docs), docs["text"].cast("string")).mapInArrow(run, FOUND_SCHEMA)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item that it contains."""
    return _found(docs, benchmark).drop("text_hash")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    known = benchmark.select(
        benchmark["item_id"].cast("bigint").alias("item_id"), benchmark["text"].cast("string")
    ).filter("text is not null").distinct()
    count = known.count()
    space = latent_space(docs) if count else None
    nothing = spark.createDataFrame([], FOUND_SCHEMA)
    if space is None:
        return nothing
    slices = -(-count // ITEMS_AT_ONCE)
    found = []
    for k in range(slices):
        part = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        items = [tuple(r) for r in part.orderBy("item_id", "text").collect()]
        if items:
            found.append(_search(docs, items, space))
    return functools.reduce(DataFrame.union, found, nothing) if len(found) > 1 else found[0]


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item; rows of the same id with other texts stay."""
    leaked = _found(docs, benchmark).select(
        F.col("doc_id").alias("leaked: doc_id"), F.col("text_hash").alias("leaked: text_hash")).distinct()
    doc_id, text_hash = _row_key(docs)
    same = doc_id.eqNullSafe(leaked["leaked: doc_id"]) & (text_hash == leaked["leaked: text_hash"])
    return docs.join(leaked, same, "left_anti")
