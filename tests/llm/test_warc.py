import gzip
import hashlib

import pytest

from punctualis.llm import warc
from punctualis.llm.shared import new_folder

SCHEMA = "page_id bigint, url string, html string, extra string"


def _pages():
    long = "x" * 100
    rows = [(i, f"http://a/{i}\r\nX: y", t, "e") for i, t in enumerate([None, "", "short", "short", long, long, "é" * 50, "é" * 50, "<html>" + "word " * 300_000])]
    return [*rows, (None, None, long, "e"), (4, None, long, "e"), (9, "u", "WARC/1.1\r\n\r\n\x1f\u008b\x08" * 50, None)]


def _expected(rows):
    firsts = {}
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            firsts[data] = min(page_id, firsts.get(data, page_id))
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        first = firsts.get(data, page_id)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if first != page_id else "response", first if first != page_id else None))
    return sorted(out, key=repr)


def test_round_trip_with_small_ranges(spark):
    rows = _pages()
    path = new_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "64k", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = warc.read_archives(spark, path).collect()
            assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == _expected(rows)
            for r in got:
                assert r.payload is None if r.record_type == "revisit" else hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_table(spark):
    path = new_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0


def _member(text: bytes, name: bytes = b"") -> bytes:
    data = gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(text) + text + b"\r\n\r\n", mtime=0)
    return data[:3] + b"\x08" + data[4:10] + name + b"\x00" + data[10:] if name else data


def test_magic_inside_a_member_at_a_range_border(spark, tmp_path):
    # A file name field in the gzip header may hold the magic itself, so members can be told only by decoding.
    members = [_member(b"first %d" % i, b"n" * i + warc.MAGIC[:2] + b"\x08" + b"tail" * 5) for i in range(40)]
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc").write_bytes(b"".join(members))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in range(60, 140, 7):
            spark.conf.set("spark.sql.files.maxPartitionBytes", f"{size}b")
            got = sorted(r.payload for r in warc.read_archives(spark, f"file://{folder}").collect())
            assert got == sorted(b"first %d" % i for i in range(40))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("size", ["60b", "300b", "64m"])
def test_damaged_members(spark, tmp_path, size):
    """Cut off, overwritten, without a length, with too little content, foreign bytes: marked, or an error; the others are read."""
    good = [_member(b"good %d " % i + bytes(range(256)) * (i % 3)) for i in range(12)]
    short = gzip.compress(b"WARC/1.0\r\nContent-Length: 90\r\n\r\nfew", mtime=0)
    unsized = gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\n\r\nno length", mtime=0)
    broken = good[5][:30] + b"\x00" * 40 + good[5][70:]
    other = gzip.compress(b"no archive at all", mtime=0)
    data = [good[0], short, good[1], unsized, good[2], broken, good[3], other, good[4], good[6], good[7][:25]]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(b"".join(data))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = warc.read_archives(spark, f"file://{tmp_path}/w", strict=False).collect()
        kept = {r.payload for r in rows if r.record_type == "resource"}
        assert {k[:6] for k in kept} == {b"good %d" % i for i in (0, 1, 2, 3, 4, 6)}
        assert sum(r.record_type == warc.DAMAGED for r in rows) >= 5 and len(kept) + sum(r.record_type == warc.DAMAGED for r in rows) == len(rows)
        with pytest.raises(Exception, match="damaged archive"):
            warc.read_archives(spark, f"file://{tmp_path}/w").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_gzip_names_are_refused(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(_member(b"x"))
    with pytest.raises(ValueError, match="gz"):
        warc.read_archives(spark, f"file://{tmp_path}")


def test_every_piece_is_decoded_once():
    """A member full of false magic numbers, stored without compression."""
    text = (warc.MAGIC + b"x" * 50) * 4000
    data = gzip.compress(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % len(text) + text, 0, mtime=0)
    pieces, member = [warc.MAGIC + p for p in data.split(warc.MAGIC)[1:]], warc.Member()
    states = [member.feed(p) for p in pieces]
    assert len(pieces) > 3000 and states == ["open"] * (len(pieces) - 1) + ["whole"] and member.record.endswith(text) and member.raw == data
