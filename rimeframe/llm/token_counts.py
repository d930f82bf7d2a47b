"""Token counts of whole texts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

A byte-level tokenizer cuts a text into pre-tokens by one fixed pattern and encodes each alone, so a
text's token count is the sum of its pre-tokens' lengths in tokens.

1.  ``frequent_lengths``: every task counts the pre-tokens of all its texts in a table of bounded
    size and hands on its ``KEEP`` commonest.  The sums of these summaries give the ``FREQUENT``
    commonest pre-tokens, whose lengths become one compact table, broadcast to all workers.
2.  ``count_tokens``: a task looks every pre-token up in that table, then in the cache of its worker,
    and encodes it with the library only if both lack it.  The cache is emptied when it reaches
    ``CACHE_BYTES``.

Which pre-tokens are in the table decides the speed, never a count.  The broadcast holds at most
``FREQUENT`` keys of at most ``LONGEST`` characters, about 2 MB.  Pre-tokens of documents are never
shuffled; the summaries are ``KEEP`` rows a task.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a null doc_id stays null; repeated rows
stay apart; an empty table gives no rows; other columns are neither read nor returned.  A text that
holds an added token's string, or a character that the pattern's classes and the library's tables
tell apart differently, is encoded as a whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FREQUENT = 1 << 15
LONGEST = 32
#: Pre-tokens that the summary of a task keeps, and that its table may hold before it is cut.
KEEP = 1 << 13
HELD = 1 << 17
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 170
#: Longer texts are cut into pre-tokens piecewise, this many at once.
LONG_TEXT = 1 << 20
PIECES_AT_ONCE = 1 << 16

#: The byte-level pattern; letters and numbers are spelled for characters that ``Lengths.plain`` knows.
PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Lengths(dict):
    """Tokens of a pre-token: the broadcast table, with the worker's cache and the library behind it."""

    def __init__(self, path: str, table: dict[str, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(table or {})
        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        before = settings["pre_tokenizer"] or {}
        if settings["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = tuple(x.content for x in added)
        ascii = set(map(chr, range(128)))
        self.odd = {c for c in ascii if not self._agrees(c)}
        self.agreed = ascii - self.odd
        self.odd_ascii = tuple(self.odd)
        self.cache, self.held = {}, 0

    def __missing__(self, piece: str) -> int:
        found = self.cache.get(piece)
        if found is None:
            found = self.encoded(piece)
            if len(piece) <= LONGEST:
                if self.held >= CACHE_BYTES:
                    self.cache, self.held = {}, 0
                self.cache[piece] = found
                self.held += ENTRY_BYTES
        return found

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0])

    def plain(self, text: str) -> bool:
        """Is every character in the same class for the pattern and for the library?"""
        if text.isascii():
            return not any(c in text for c in self.odd_ascii)
        seen = set(text) - self.agreed
        for c in seen - self.odd:
            (self.agreed if self._agrees(c) else self.odd).add(c)
        return not seen & self.odd

    def _agrees(self, c: str) -> bool:
        """Both cut every probe alike: the character beside letters, digits, marks and spaces."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        probes = [x + c + y for x in ("", "a", "1", "!", " ", "\t", c) for y in ("", "a", "1", "!", " ")]
        return all(
            [x[1] for x in cut(probe)] == [m.span() for m in PIECE.finditer(probe)]
            for probe in probes
        )

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, all at once or, for a long one, many at a time."""
        if len(text) <= LONG_TEXT:
            yield PIECE.findall(text)
            return
        found = (m.group() for m in PIECE.finditer(text))
        while part := list(islice(found, PIECES_AT_ONCE)):
            yield part

    def count(self, text: str) -> int:
        if any(x in text for x in self.added) or not self.plain(text):
            return self.encoded(text)
        get = self.__getitem__
        return sum(sum(map(get, part)) for part in self.pieces(text))


@lru_cache(maxsize=1)
def _worker_lengths(path: str, packed: tuple[bytes, bytes, bytes]) -> Lengths:
    """One table and cache for all tasks that a Python worker runs."""
    return Lengths(path, unpack(packed))


def pack(table: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """Keys end to end, their sizes in characters and their lengths in tokens."""
    sizes = bytes(map(len, table))
    return "".join(table).encode(), sizes, b"".join(n.to_bytes(2, "little") for n in table.values())


def unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    keys, sizes, lengths = packed[0].decode(), packed[1], memoryview(packed[2]).cast("H")
    table, at = {}, 0
    for size, n in zip(sizes, lengths, strict=True):
        table[keys[at : at + size]] = n
        at += size
    return table


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def _cut(counts: Counter, keep: int) -> Counter:
    return Counter(dict(counts.most_common(keep)))


def piece_counts(counts: Counter) -> Counter:
    """Pre-tokens of counted words, each taken with the space in front of it."""
    out = Counter()
    for word, n in counts.items():
        for piece in PIECE.findall(" " + word):
            if len(piece) <= LONGEST:
                out[piece] += n
    return out


def frequent_lengths(docs: DataFrame, path: str, size: int = FREQUENT) -> dict[str, int]:
    """The ``size`` commonest pre-tokens of all texts and their lengths in tokens.

    Tasks count words between spaces, of which far fewer objects are made than of pre-tokens, and cut
    the commonest ones into pre-tokens at their end.
    """

    def run(batches):
        counts = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                for at in range(0, len(text or ""), LONG_TEXT):
                    words = text[at : at + LONG_TEXT].split(" ")
                    counts.update([word for word in words if len(word) < LONGEST])
                if len(counts) > HELD:
                    counts = _cut(counts, HELD // 4)
        top = piece_counts(_cut(counts, 2 * KEEP)).most_common(KEEP)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["piece", "n"])

    summaries = _texts(docs).mapInArrow(run, "piece string, n bigint")
    top = (
        summaries.groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(size)
    )
    own = Lengths(path)
    found = {row["piece"]: own.encoded(row["piece"]) for row in top.collect()}
    return {piece: n for piece, n in found.items() if n < 1 << 16}


def count_tokens(docs: DataFrame, path: str, table: dict[str, int] | None = None) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens (no begin, end or padding tokens) of every row."""
    table = frequent_lengths(docs, path) if table is None else table
    shared = docs.sparkSession.sparkContext.broadcast(pack(table))

    def run(batches):
        lengths = _worker_lengths(path, shared.value)
        for batch in batches:
            texts = batch.column(1)
            counts = [lengths.count(x.as_py() or "") for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return _texts(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
