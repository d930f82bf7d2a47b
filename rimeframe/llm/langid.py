"""Language identification by compression with per-language raw-content dictionaries.

A text is cut into blocks of ``BLOCK_BYTES``, every block is compressed by itself with each
language's zstandard dictionary, and the language with the smallest total wins.  Blocks keep long
texts under the influence of the dictionaries: without them a text soon becomes its own dictionary.

The dictionaries hold a bounded sample of whole labelled texts: per language different ones of smallest
hash, up to ``TEXTS`` of them, as long as those before have less than ``CONTENT_CHARS`` characters; texts
of more than ``LONG`` characters are taken only where there are no others.  Everything is scored whole.

Case is folded on both sides.  Equal sizes go to the language with more labelled rows, then to the
alphabetically first; such a text is rejected.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected; without
any labelled row every text is ``und``; with one language every text with a letter gets it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4096
TEXTS = 256
CONTENT_CHARS = 120_000
LONG = 4000
#: Levels that search longer find the short matches that tell languages apart.
LEVEL = 9
#: Bytes by which a size may differ before odds change by a factor of e.
TEMPERATURE = 2.0
#: The best size must be this much smaller than the second, as a part of it.
LEAST_MARGIN = 0.002
UNKNOWN = "und"

SALTS = 64
LATIN = re.compile("[A-Za-z]")


def training_texts(labelled: DataFrame) -> DataFrame:
    """(lang, text, n) of the sample, n counting from 1 in order of hash.

    Texts are chosen by hash and size alone, copies as one, and ranked within salts first, so that one
    language with most rows is no single task.  Only the chosen ones are read again as texts.
    """
    rows = labelled.filter("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("h"),
    )
    sizes = rows.groupBy("lang", "h").agg(F.max(F.char_length("text")).alias("size"))
    order = [F.col("size") > LONG, F.col("h")]
    salted = Window.partitionBy("lang", F.pmod("h", F.lit(SALTS))).orderBy(*order)
    final = Window.partitionBy("lang").orderBy(*order)
    before = F.coalesce(F.sum("size").over(final.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    few = sizes.withColumn("n", F.row_number().over(salted)).filter(F.col("n") <= TEXTS)
    few = few.withColumns({"n": F.row_number().over(final), "before": before})
    chosen = few.filter((F.col("n") <= TEXTS) & (F.col("before") < CONTENT_CHARS)).select("lang", "h", "n")
    found = rows.join(F.broadcast(chosen), ["lang", "h"])  # TEXTS rows a language at most
    return found.groupBy("lang", "n").agg(F.min("text").alias("text"))


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionary content by language, most frequent first, from columns text and lang."""
    counts = labelled.filter("text is not null and lang is not null").groupBy("lang").count()
    ranked = counts.orderBy(F.desc("count"), "lang").collect()  # one row per language
    found: dict[str, list[str]] = {row["lang"]: [] for row in ranked}
    for row in training_texts(labelled).orderBy("lang", "n").collect():
        found[row["lang"]].append(row["text"].lower())
    return {lang: "\n".join(dict.fromkeys(texts)).encode() for lang, texts in found.items()}


class Classifier:
    """Compressors by language; made once in each task."""

    def __init__(self, contents: dict[str, bytes]):
        self.langs = list(contents)
        self.packers = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(
                contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(
                dict_data=content, write_content_size=False, write_dict_id=False
            ).compress)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(pack(block)) for block in blocks) for pack in self.packers]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        sizes = np.array(self.sizes(text), dtype=float)
        best = int(sizes.argmin())
        odds = np.exp(-(sizes - sizes[best]) / TEMPERATURE)
        second = float(np.delete(sizes, best).min()) if len(sizes) > 1 else float("inf")
        margin = 1.0 if second == float("inf") else (second - sizes[best]) / second
        return self.langs[best], float(1.0 / odds.sum()), float(margin)


def has_letter(text: str | None) -> bool:
    return bool(text) and (LATIN.search(text) is not None or any(map(str.isalpha, text)))


def identify(docs: DataFrame, contents: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``margin`` and ``rejected``; all rows are kept.

    Columns of those names are replaced.
    """
    added = ["lang_pred", "score", "margin", "rejected"]
    kept = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(contents)  # bounded by the sample
    schema = kept.select(
        "*",
        F.lit("").alias("lang_pred"),
        *[F.lit(0.0).alias(c) for c in ("score", "margin")],
        F.lit(True).alias("rejected"),
    ).schema
    for field in schema.fields:
        field.nullable = True

    def score(batches):
        classify = Classifier(shared.value)
        for batch in batches:
            found = [classify(x) for x in batch.column(text).to_pylist()]
            arrays = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.float64()),
                pa.array([x[0] == UNKNOWN or x[2] < LEAST_MARGIN for x in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, *added]
            )

    return kept.mapInArrow(score, schema)


def learnable(held_out: Column) -> Column:
    """Rows that may be learnt from: held_out is known and false."""
    return ~F.coalesce(held_out, F.lit(True))
