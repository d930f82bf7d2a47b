"""Token ids of whole texts, by the tokenizers library with a bounded memo of pieces.

Both supported kinds of tokenizer treat the pieces between single spaces alone: one drops white
space, the other gives a space to the piece behind it.  So each distinct piece is encoded once per
task and ids are joined.  A text in which that does not hold (three white-space characters around a
space, or the string of an added token) is encoded as it is.

Usual texts, whose white space is spaces and lone line ends, are cut, looked up and joined as Arrow
arrays, many texts at once; only pieces that the memo lacks become Python strings.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_OF_TEXT = 1
#: Bytes of pieces and ids that the memo of unusual texts may hold.
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 160
#: Bytes of the Arrow arrays that are the memo of usual texts.
KNOWN_BYTES = 48 << 20
PIECES_AT_ONCE = 512
RUNS_AT_ONCE = 64
#: Bytes of text whose pieces are looked up together; longer texts than the second are unusual.
BYTES_AT_ONCE = 1 << 24
LONG_TEXT = 1 << 27

WHITE = re.compile(r"\s \s")
SPACE = re.compile(r"\s")
#: How byte-level vocabularies spell a space.
SPACE_BYTE = "\u0120"
#: A text of ASCII without any of these has single spaces and single line ends only.
NOT_SIMPLE = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
LINE = re.compile(r"^\n|\s\n|\n\s|\n\Z")
#: White space other than one or two spaces or a lone line end inside the text (RE2; its \\s is ASCII only).
UNUSUAL = (
    r"[\t\r\v\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|   |[ \n]\n|\n |\A\n|\n\z")


@lru_cache(maxsize=2)
def encoder(path: str) -> "Encoder":
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(path)


def id_type(path: str) -> str:
    """The array type of packed ids, by the size of the tokenizer's vocabulary."""
    return f"<u{encoder(path).width}"


class Encoder:
    """Text to ids, as bytes of unsigned little-endian integers of ``width`` bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = tuple(x.content for x in added)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.drops_space = not self._direct([" "])[0]
        self.newline = self._direct(["\n"])[0]
        self.end = array(self.code, [END_OF_TEXT]).tobytes()
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE_BYTE)]] = True
        self._forget()
        self._forget_known()

    def _forget(self) -> None:
        self.first: dict[str, bytes] = {}
        self.rest = self.first if self.drops_space else {}
        self.held = 0

    def _forget_known(self) -> None:
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def _direct(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in encoded]

    def _each(self, texts: list[str], with_offsets: bool = False):
        """Encodings of texts, a few of which are held at a time."""
        encode = self.tokenizer.encode_batch if with_offsets else self.tokenizer.encode_batch_fast
        for i in range(0, len(texts), RUNS_AT_ONCE):
            yield from encode(texts[i : i + RUNS_AT_ONCE], add_special_tokens=False)

    def _in_runs(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that follow a space and have no white space: many are encoded as one text.

        A token belongs to the piece in which it starts.
        """
        runs = [pieces[i : i + PIECES_AT_ONCE] for i in range(0, len(pieces), PIECES_AT_ONCE)]
        out = []
        for run, found in zip(runs, self._each([" " + " ".join(run) for run in runs], True), strict=True):
            sizes = np.fromiter(map(len, run), np.int64, len(run)) + 1
            ends = np.cumsum(sizes)
            starts = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            owner = np.searchsorted(ends, starts, side="right")
            cuts = np.searchsorted(owner, np.arange(len(run) + 1)) * self.width
            ids, cuts = array(self.code, found.ids).tobytes(), cuts.tolist()
            out += [ids[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _in_lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without white space: many are encoded as the lines of one text.

        A line end between other characters is a token of its own, so it shows where pieces end.
        """
        runs = [pieces[i : i + PIECES_AT_ONCE] for i in range(0, len(pieces), PIECES_AT_ONCE)]
        mark, out = int.from_bytes(self.newline, "little"), []
        for found in self._each(["\n".join(run) for run in runs]):
            ids = array(self.code, found.ids)
            cuts = np.flatnonzero(np.frombuffer(ids, self.code) == mark) * self.width
            begins, ends = [0, *(cuts + self.width).tolist()], [*cuts.tolist(), len(ids) * self.width]
            ids = ids.tobytes()
            out += [ids[x:y] for x, y in zip(begins, ends, strict=True)]
        return out

    def _after_spaces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces behind a space and without white space: many are encoded as one text.

        The first token of each begins with the space, and no other token does.
        """
        runs = [pieces[i : i + PIECES_AT_ONCE] for i in range(0, len(pieces), PIECES_AT_ONCE)]
        out = []
        for run, found in zip(runs, self._each([" " + " ".join(run) for run in runs]), strict=True):
            ids = np.array(found.ids, dtype=f"<u{self.width}")
            cuts = (np.flatnonzero(self.spaced[ids]) * self.width).tolist()
            ids = ids.tobytes()
            if len(cuts) == len(run) and cuts[:1] == [0]:
                out += [ids[x:y] for x, y in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
            else:
                out += self._direct([" " + x for x in run])
        return out

    def _encoded(self, pieces: list[str], space: str) -> list[bytes]:
        if "" not in pieces and not SPACE.search("".join(pieces)):
            if self.drops_space:
                return self._in_runs(pieces)
            return self._after_spaces(pieces) if space else self._in_lines(pieces)
        plain = [x for x in pieces if x and not SPACE.search(x)]
        found = dict(zip(plain, self._encoded(plain, space), strict=True))
        other = [x for x in pieces if x not in found]
        found.update(zip(other, self._direct([space + x for x in other]), strict=True))
        return [found[x] for x in pieces]

    def _learn(self, memo: dict[str, bytes], new: set[str], space: str) -> None:
        pieces = list(new)
        memo.update(zip(pieces, self._encoded(pieces, space), strict=True))
        self.held += sum(map(len, pieces)) + ENTRY_BYTES * len(pieces)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.held > MEMO_BYTES:
            self._forget()
        if self.drops_space:
            cut = [None if self._has_added(x) else x.replace("\n", " ").split(" ") for x in texts]
            known = [pieces for pieces in cut if pieces is not None]
            self._learn(self.rest, set().union(*known) - self.rest.keys(), "")
            get = self.rest.__getitem__
            return [
                self._direct([text])[0] if pieces is None else b"".join(map(get, pieces))
                for text, pieces in zip(texts, cut, strict=True)
            ]
        lines = [self._lines(x) for x in texts]
        known = [line for own in lines for line in own]
        self._learn(self.first, {x[0] for x in known} - self.first.keys(), "")
        rest = set().union(*[x[1:] for x in known]) - self.rest.keys()
        self._learn(self.rest, rest, " ")
        first, get = self.first.__getitem__, self.rest.__getitem__
        return [
            self.newline.join([
                b"".join([first(line[0]), *map(get, line[1:])]) for line in own
            ]) if own else self._direct([text])[0]
            for text, own in zip(texts, lines, strict=True)
        ]

    def _has_added(self, text: str) -> bool:
        return any(x in text for x in self.added)

    def _lines(self, text: str) -> list[list[str]]:
        """Pieces by line; nothing if the text must be encoded as it is.

        Line ends next to other white space stay inside pieces.
        """
        if self._has_added(text):
            return []
        if text.isascii() and not any(x in text for x in NOT_SIMPLE):
            simple = text[:1] != "\n" and text[-1:] != "\n"
            return [x.split(" ") for x in (text.split("\n") if simple else [text])]
        if WHITE.search(text):
            return []
        return [x.split(" ") for x in ([text] if LINE.search(text) else text.split("\n"))]

    def _usual(self, texts: pa.Array) -> np.ndarray:
        """Which texts are cut at every space, and at every line end if that is no space."""
        usual = pc.less_equal(pc.binary_length(texts), LONG_TEXT)
        for x in self.added:
            usual = pc.and_not(usual, pc.match_substring(texts, x))
        if not self.drops_space:
            usual = pc.and_not(usual, pc.match_substring_regex(texts, UNUSUAL))
        return usual.to_numpy(zero_copy_only=False)

    def _marked(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces as ``_by_pieces`` cuts them: behind a space, or behind the line end that they begin with."""
        first = [x[1:] for x in pieces if x[:1] == "\n"]
        rest = [x for x in pieces if x[:1] != "\n"]
        slot = self.end if self.drops_space else self.newline
        after_line = iter(self._encoded(first, ""))
        after_space = iter(self._encoded(rest, "" if self.drops_space else " "))
        return [slot + next(after_line) if x[:1] == "\n" else next(after_space) for x in pieces]

    def _by_pieces(self, texts: pa.Array) -> pa.Array:
        """Ids of usual texts.

        Each text begins with a line end of its own, one id wide; without the first of these ids every text
        has that of its successor as its last, where the end id is put.
        """
        if self.drops_space:
            marked = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " "), " ")
        else:
            marked = pc.binary_join_element_wise("", pc.replace_substring(texts, "\n", " \n"), "\n")
        cut = pc.split_pattern(marked, " ")
        pieces = cut.flatten().dictionary_encode()
        if self.known.nbytes + self.known_ids.nbytes > KNOWN_BYTES:
            self._forget_known()
        at = pc.index_in(pieces.dictionary, value_set=self.known)
        new = pieces.dictionary.filter(pc.is_null(at))
        at = pc.fill_null(at, -1).to_numpy().copy()
        at[at < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            ids = pa.array(self._marked(new.to_pylist()), pa.binary())
            self.known = pa.concat_arrays([self.known, new])
            self.known_ids = pa.concat_arrays([self.known_ids, ids])
        joined = self.known_ids.take(pa.array(at)).take(pieces.indices)
        bounds = _bounds(joined)[cut.offsets.to_numpy()]
        ids = np.frombuffer(joined.buffers()[2], f"<u{self.width}", bounds[-1] // self.width)
        ids = np.append(ids[1:], ids[:1])
        ids[bounds[1:] // self.width - 1] = END_OF_TEXT
        return pa.Array.from_buffers(
            pa.binary(), len(texts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)])

    def packed(self, texts: pa.Array):
        """Arrays of ids with the end id, for some texts at a time; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        begin = 0
        while begin < len(texts):
            held = ends[begin - 1] if begin else 0
            size = max(1, int(np.searchsorted(ends, held + BYTES_AT_ONCE, side="right")) - begin)
            part = texts.slice(begin, size)
            begin += size
            usual = self._usual(part)
            if usual.all():
                yield self._by_pieces(part)
                continue
            odd = [x + self.end for x in self(part.filter(pa.array(~usual)).to_pylist())]
            both = [pa.array(odd, pa.binary())]
            if usual.any():
                both.append(self._by_pieces(part.filter(pa.array(usual))))
            place = np.where(usual, len(odd) + np.cumsum(usual) - 1, np.cumsum(~usual) - 1)
            yield pa.concat_arrays(both).take(pa.array(place))

    def stream(self, texts: list[str | None]):
        """Ids with the end id, text by text."""
        for part in self.packed(pa.array(texts, pa.string())):
            yield from part.to_pylist()


def _bounds(values: pa.Array) -> np.ndarray:
    """Where each value of a binary array begins, and where the last one ends."""
    return np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]


def sketches(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest hash of two neighbouring ids of each document: near copies mostly have the same.

    Documents lie between ``bounds``; one of a single id has the hash of that.
    """
    mixed = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    pairs = mixed.copy()
    pairs[:-1] ^= mixed[1:] * np.uint32(0x85EBCA6B)
    ends, single = bounds[1:] - 1, np.diff(bounds) == 1
    pairs[ends[single]] = mixed[ends[single]]
    pairs = (pairs ^ (pairs >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    pairs ^= pairs >> np.uint32(13)
    pairs[ends[~single]] = np.uint32(0xFFFFFFFF)
    return np.minimum.reduceat(pairs, bounds[:-1]).astype(np.int64)


def token_ids(docs: DataFrame, path: str, with_sketch: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (binary) of every row, with the end id; and a sketch if wanted."""

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            begin = 0
            for ids in encode.packed(batch.column(1)):
                yield part(batch.column(0).slice(begin, len(ids)), ids, encode.width)
                begin += len(ids)

    def part(keys, ids, width):
        bounds = _bounds(ids).astype(np.int64) // width
        columns = [keys, pa.array(np.diff(bounds)), ids]
        if with_sketch:
            flat = np.frombuffer(ids.buffers()[2], f"<u{width}", bounds[-1])
            columns.append(pa.array(sketches(flat[bounds[0] :], bounds - bounds[0])))
        return pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_tokens", "ids", "sketch"][: len(columns)])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string"))
    schema = "doc_id bigint, n_tokens bigint, ids binary" + ", sketch bigint" * with_sketch
    return rows.mapInArrow(run, schema)


def id_counts(tokens: DataFrame, dtype: str, of_documents: bool = False) -> DataFrame:
    """(id, n): how often each id occurs, or in how many documents; summed in tasks first."""

    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            values = batch.column(0).to_pylist()
            if of_documents:
                most = max((int(np.frombuffer(x, dtype).max()) for x in values if x), default=-1)
                total = np.append(total, np.zeros(max(0, most + 1 - len(total)), dtype=np.int64))
                for x in values:
                    total[np.frombuffer(x, dtype)] += 1  # an id that repeats is added to once
                continue
            ids = np.frombuffer(b"".join(values), dtype)
            counts = np.bincount(ids.astype(np.int64), minlength=len(total))
            counts[: len(total)] += total
            total = counts
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counted = tokens.select("ids").mapInArrow(run, "id bigint, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))
