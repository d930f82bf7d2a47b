"""WARC archives: an index of byte ranges first, then coalesced range reads of what is selected.

Every record is its own gzip member, so ``[offset, offset + length)`` of a file is readable alone.
A task writes files under names of its own; only files named in the committed index count, so a
task that was lost or ran twice leaves nothing but an unused file.

Defined cases: null html is an empty payload; a null url gives a record without target; rows that
share the smallest page_id of a payload are all responses; a null page_id never is the response
that others refer to unless all are null; an empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimeframe.llm.shared import folder_uri, open_for_reading, open_for_writing, stage

CAPTURED = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:x-page:"
ROWS_AT_ONCE = 256

INDEX_SCHEMA = """file string, offset bigint, length bigint, page_id bigint, url string,
    record_type string, payload_digest string"""
INDEX_ARROW = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
    ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
])
RECORD_SCHEMA = """page_id bigint, url string, record_type string, refers_to bigint,
    payload_bytes bigint, payload_digest string, payload binary"""
RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()),
])


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, html, payload_digest and ``refers_to``: the page whose payload is equal.

    Digests are counted before anything is joined, and only repeated ones take part in the join.
    """
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        payload.alias("html"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    repeated = (
        rows.filter(F.octet_length("html") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first_page is not null")
        .drop("n")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_page"))
    return (
        rows.join(repeated, "payload_digest", "left")
        .withColumn("refers_to", F.when(later, F.col("first_page")))
        .drop("first_page")
    )


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers)]
    lines.append(f"Content-Length: {len(block)}")
    packed = zlib.compressobj(4, zlib.DEFLATED, 31)
    text = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packed.compress(text) + packed.flush()


def _page_record(page_id, url, html: bytes, digest: str, refers_to) -> tuple[str, bytes]:
    name = f"{PAGE_URN}{page_id}" if page_id is not None else f"urn:sha256:{digest}"
    headers = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", CAPTURED)]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(("WARC-Target-URI", safe))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(html)))]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
        return "revisit", _record("revisit", headers, b"")
    headers.append(("Content-Type", "application/http; msgtype=response"))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}"
    return "response", _record("response", headers, head.encode() + b"\r\n\r\n" + html)


def _slices(batches, rows: int = ROWS_AT_ONCE):
    """Batches in pieces, so that few payloads are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def write_archives(pages: DataFrame, least_bytes: int = 100, roll_bytes: int = 1 << 28) -> DataFrame:
    """Write one record per page to ``.warc.gz`` files in the shared folder; return their index."""
    folder = folder_uri(pages.sparkSession, "warc")

    def write(batches):
        part, out, held, path, offset = TaskContext.get().partitionId(), None, None, "", 0
        for batch in _slices(batches):
            columns = {k: [] for k in INDEX_ARROW.names}
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                page_id, url, html, digest, refers_to = row
                if out is None or offset >= roll_bytes:
                    if held is not None:
                        held.__exit__(None, None, None)
                    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    held = open_for_writing(path)
                    out = held.__enter__()
                    info = [("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", CAPTURED),
                            ("Content-Type", "application/warc-fields")]
                    first = _record("warcinfo", info, b"format: WARC File Format 1.1\r\n")
                    out.write(first)
                    offset = len(first)
                kind, packed = _page_record(page_id, url, html, digest, refers_to)
                out.write(packed)
                values = (path, offset, len(packed), page_id, url, kind, digest)
                for k, v in zip(INDEX_ARROW.names, values, strict=True):
                    columns[k].append(v)
                offset += len(packed)
            yield pa.RecordBatch.from_pydict(columns, INDEX_ARROW)
        if held is not None:
            held.__exit__(None, None, None)

    rows = with_revisits(pages, least_bytes).select(
        "page_id", "url", F.col("html").cast("binary"), "payload_digest", "refers_to"
    )
    return stage(rows.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _ranges(rows, gap: int, most: int):
    """Neighbouring (file, offset, length) rows as one range each."""
    held = []
    for file, offset, length in rows:
        if held:
            end = held[-1][1] + held[-1][2]
            if file != held[0][0] or offset - end > gap or offset + length - held[0][1] > most:
                yield held
                held = []
        held.append((file, offset, length))
    if held:
        yield held


def _page_of(urn: str | None):
    inner = (urn or "").strip("<>")
    return int(inner[len(PAGE_URN):]) if inner.startswith(PAGE_URN) else None


def _parsed(packed: bytes, with_payload: bool) -> tuple:
    text = zlib.decompress(packed, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size, payload = int(headers["X-Payload-Length"]), None
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return (
        _page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"],
        _page_of(headers.get("WARC-Refers-To")), size, digest, payload if with_payload else None,
    )


def read_records(
    index: DataFrame, with_payload: bool = True, gap: int = 1 << 16, most: int = 1 << 23
) -> DataFrame:
    """The records that the rows of ``index`` point to, in any selection.

    Rows are dealt by (file, region of ``most`` bytes) and sorted by offset; neighbours at most
    ``gap`` bytes apart are fetched by one read of at most ``most`` bytes (or one record).
    """

    def read(batches):
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        )
        for run in _ranges(rows, gap, most):
            file, begin, _ = run[0]
            with open_for_reading(file) as source:
                source.seek(begin)
                data = source.read(run[-1][1] + run[-1][2] - begin)
            found = [_parsed(data[o - begin : o - begin + n], with_payload) for _, o, n in run]
            yield pa.RecordBatch.from_pydict(
                dict(zip(RECORD_ARROW.names, map(list, zip(*found, strict=True)), strict=True)),
                RECORD_ARROW,
            )

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = (
        index.select("file", "offset", "length")
        .withColumn("region", F.floor(F.col("offset") / most))
        .repartition(parts, "file", "region")
        .sortWithinPartitions("file", "offset")
        .drop("region")
    )
    return places.mapInArrow(read, RECORD_SCHEMA)
