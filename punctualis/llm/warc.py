"""WARC archives: written as one gzip member per record, read back by byte ranges.

Writing. Each task packs its records into blobs of about a megabyte and Spark's text writer commits them, so files
reach any store Spark writes to and a lost executor leaves no half file. The writer needs a separator after each
blob; it gets an empty gzip member, which readers of the format skip.

Reading. Spark's text reader splits each file into byte ranges and each task scans its range for the gzip magic
(as the line separator, on raw bytes), so a candidate belongs to the range its magic lies in. A candidate is
accepted when its gzip header is valid and its first decoded bytes are a WARC version line. The magic can also
occur inside a member: such a piece is appended to the member before it. Only where a member and such a piece lie
in two ranges, both are handed on as loose pieces and joined per file.

Defined results: a NULL payload is empty; repeated rows are records of their own; a NULL id gives a record without
id; an empty table gives archives without records; further columns of the pages are not stored. For damaged members and names
that end in ``.gz`` see ``read_archives``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm.shared import new_folder, stored, table

DAMAGED = "damaged"
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
BLOB_BYTES = 1 << 20
REVISIT_BYTES = 100
RECORD_SCHEMA = "page_id bigint, target_uri string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Digest and length of each payload, and ``refers_to`` for later records with an equal payload.

    Copies are counted by a pre-aggregated group; only digests that occur twice or more are stored and joined back,
    by a merge join straight over two shuffles, whose large partitions Spark can split: a payload shared by a third of
    all pages is no single task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("n"), F.sha2(payload, 256).alias("digest"))
    copies = rows.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("records"))
    copies = stored(copies.where("records > 1").select("digest", "first_id"), "copies")
    joined = rows.join(copies, "digest", "left")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for batch in batches:
        columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
        for i in range(batch.num_rows):
            waiting.append(_record(*(c[i].as_py() for c in columns)))
            size += len(waiting[-1])
            if size >= BLOB_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(waiting)], pa.binary())], ["value"])
                waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(waiting)], pa.binary())], ["value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write pages (page_id, url, html) as archives into a new folder."""
    blobs = with_revisits(pages).mapInArrow(_blobs, "value binary").select(F.col("value").cast("string").alias("value"))
    blobs.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class Member:
    """A gzip member that may be cut into pieces at false magic numbers; each piece is decoded once."""

    def __init__(self):
        self.decoder, self.pieces, self.parts = zlib.decompressobj(31), [], []

    def feed(self, data: bytes) -> str:
        """``whole`` with the last piece, ``open`` before it, ``no`` where the bytes don't go on with the member (it stays as it was)."""
        decoder = self.decoder.copy()
        try:
            more = decoder.decompress(data)
        except zlib.error:
            return "no"
        head = b"".join(self.parts[:8])[:7] + more[:7]
        if not head[:7] == b"WARC/1."[: len(head)]:
            return "no"
        self.decoder = decoder
        self.pieces.append(data)
        if more:
            self.parts.append(more)
        return "whole" if decoder.eof else "open"

    @property
    def raw(self) -> bytes:
        return b"".join(self.pieces)

    @property
    def record(self) -> bytes:
        return b"".join(self.parts)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, bytes]]:
    """``record`` with decoded bytes, or ``loose`` with raw bytes, in file order; a range is one (path, start)."""
    place, member, first = None, None, False
    for batch in batches:
        paths, starts, values = batch.column("path"), batch.column("start"), batch.column("value")
        for i in range(batch.num_rows):
            here = (paths[i].as_py(), starts[i].as_py())
            if here != place:
                if member:
                    yield "loose", *place, member.raw
                place, member, first = here, None, here[1] == 0
            value = values[i].as_py()
            if first:  # what stands before the first magic of the file
                first = False
                continue
            data = MAGIC + value
            state = member.feed(data) if member else "no"
            if state == "no":
                if member:  # cut off or damaged: what follows may be a member of its own
                    yield "loose", *place, member.raw
                member = Member()
                state = member.feed(data)
            if state == "whole" and member.parts:  # else a separator
                yield "record", *place, member.record
            if state == "no":
                yield "loose", *place, data
            if state != "open":
                member = None
    if member:
        yield "loose", *place, member.raw


def _damaged(data: bytes, why: str, strict: bool) -> dict:
    if strict:
        raise ValueError(f"damaged archive: {why}")
    return dict.fromkeys(_ARROW.names) | {"record_type": DAMAGED, "payload": data}


def _parse(record: bytes, strict: bool) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        return _damaged(record, "a record without its content", strict)
    block = rest[: int(length)]
    kind = fields.get("warc-type")
    number = lambda text: int(text[10:-1]) if text and text.startswith("<urn:page:") else None
    http = fields.get("content-type", "").startswith("application/http")
    return {
        "page_id": number(fields.get("warc-record-id")),
        "target_uri": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number(fields.get("warc-refers-to")),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "payload_bytes": int(fields["payload-length"]) if fields.get("payload-length", "").isdigit() else None,
        "payload": None if kind == "revisit" else block.partition(b"\r\n\r\n")[2] if http else block,
    }


_ARROW = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _rows(records: Iterator[bytes], strict: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for record in records:
        rows.append(_parse(record, strict))
        size += len(record)
        if size >= 4 * BLOB_BYTES:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


def _decode(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    return _rows((data for kind, _, _, data in _pieces(batches) if kind == "record"), strict)


def _loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for n, (kind, path, start, data) in enumerate(_pieces(batches)):
        if kind == "loose":
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start]), pa.array([n], pa.int64()), pa.array([data], pa.binary())], ["path", "start", "n", "value"])


def _repair(pieces: pa.Table, strict: bool) -> pa.Table:
    """Join the loose pieces of one file in order: an open member takes the pieces after it until it is whole."""
    rows, member = [], None
    for data in pieces.sort_by([("start", "ascending"), ("n", "ascending")]).column("value").to_pylist():
        state = member.feed(data) if member else "no"
        if state == "no":
            if member:
                rows.append(_damaged(member.raw, "a member is cut off", strict))
            member = Member()
            state = member.feed(data)
        if state == "whole" and member.parts:
            rows.append(_parse(member.record, strict))
        if state == "no":
            rows.append(_damaged(data, "bytes that belong to no member", strict))
        if state != "open":
            member = None
    if member:
        rows.append(_damaged(member.raw, "the last member is cut off", strict))
    return pa.Table.from_pylist(rows, _ARROW)


def read_archives(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The records of all archives below a path (RECORD_SCHEMA); the payload of a revisit is NULL.

    A member that is cut off, undecodable, or a record without its whole content is an error; unless ``strict``, it is a row
    of its own with the record type ``damaged`` and its bytes as payload, and all other records are read. Names that end
    in ``.gz`` are an error at once: the text reader would unpack them as one stream and find no member.
    """
    text = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    if any(name.lower().endswith(".gz") for name in text.inputFiles()):
        raise ValueError(f"archives below {path} are named .gz; they are read by byte ranges only under another name")
    ranges = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    repaired = ranges.mapInArrow(_loose, "path string, start bigint, n bigint, value binary").groupBy("path").applyInArrow(lambda p: _repair(p, strict), RECORD_SCHEMA)
    return ranges.mapInArrow(lambda batches: _decode(batches, strict), RECORD_SCHEMA).unionByName(repaired)


def op1_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    records = read_archives(spark, folder)
    whole = F.col("payload").isNotNull()
    return records.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


QUERIES = {"op1_warc_roundtrip": op1_warc_roundtrip}
SQL = {
    "op1_warc_roundtrip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM m
"""
}
