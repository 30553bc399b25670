import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctualis.sources import realtime, wire

# Messages written down byte by byte, not by an encoder.
HEADER = bytes.fromhex("0a05 0a03 322e30")  # header { version "2.0" }
STOP_FULL = bytes.fromhex("08 ac02  12 06 10 80b4c9ac06  1a 0a 10 ffffffffffffffff7f 2203 533132 2801".replace(" ", ""))
STOP_NO_TIME = bytes.fromhex("12 02 08 1e  2200".replace(" ", ""))  # arrival { delay 30 }, stop_id ""


def framed(number, content):
    size = len(content)
    length = bytes([size]) if size < 128 else bytes([size & 127 | 128, size >> 7])
    return bytes([number << 3 | 2]) + length + content


def rows(spark, contents, decode, **options):
    df = spark.createDataFrame([(None if c is None else bytearray(c), "A", n) for n, c in enumerate(contents)], "content binary, mode string, n int")
    df = df.withColumn("load_timestamp", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs="n")).cast("timestamp_ntz"))
    return sorted(([r.asDict() | {"n": r.load_timestamp.second} for r in decode(df, **options).collect()]), key=lambda r: (r["n"], r["trip_id"] or ""))


def test_bytes_of_trip_updates(spark):
    trip = framed(1, framed(1, b"T1") + bytes.fromhex("2801"))
    unknown = bytes.fromhex("f80107" + "9a060301ff02" + "a106" + "00" * 8 + "ad06" + "00" * 4 + "b306" + "0801" + "b406")  # all wire types, a group too
    plain = HEADER + framed(2, framed(1, b"e") + framed(3, trip + framed(2, STOP_FULL) + framed(2, STOP_NO_TIME)))
    odd = unknown + framed(2, unknown + framed(3, framed(2, unknown + STOP_FULL + bytes.fromhex("0805")) + trip + unknown + framed(1, framed(5, b"R"))) + framed(1, b"e")) + HEADER
    wrong_type = framed(2, framed(3, framed(1, bytes.fromhex("0807")) + framed(2, bytes.fromhex("0a0131"))))  # trip_id as a number, stop_sequence as a text
    got = rows(spark, [plain, odd, wrong_type, b"", None], realtime.decode_trip_updates)
    facts = [(r["n"], r["trip_id"], r["stop_id"], r["stop_sequence"], r["arrival"], r["departure"], r["schedule_relationship"]) for r in got]
    departure = (1 << 63) - 1
    assert facts == [
        (0, "T1", "S12", 300, 1704090112, departure, 1), (0, "T1", "", None, None, None, None),
        (1, "T1", "S12", 5, 1704090112, departure, 1), (2, None, None, None, None, None, None),
    ]
    zero = rows(spark, [plain], realtime.decode_trip_updates, absent_time_as_zero=True)
    assert [(r["arrival"], r["departure"]) for r in zero] == [(1704090112, departure), (0, None)]


def test_bytes_of_vehicles(spark):
    place = framed(2, bytes.fromhex("0d00004a42 15 0000a041 21000000000000f83f".replace(" ", "")))  # 50.5, 20.0, odometer 1.5
    first = framed(2, framed(1, b"e") + framed(4, place + framed(8, framed(1, b"B7")) + bytes.fromhex("2001") + bytes.fromhex("48ffffffffffffffffff01")))
    twice = framed(2, framed(4, framed(2, bytes.fromhex("0d0000c842"))) + framed(4, framed(2, bytes.fromhex("1d0000803f")) + framed(1, framed(1, b"T"))))  # merged
    large = framed(2, framed(4, bytes.fromhex("18ffffffff0f") + bytes.fromhex("28ffffffffffffffffff01")))  # unsigned numbers beyond the columns
    got = rows(spark, [HEADER + first, twice, large, HEADER], realtime.decode_vehicle_positions)
    assert [r["n"] for r in got] == [0, 1, 2]
    assert (got[0]["latitude"], got[0]["longitude"], got[0]["odometer"], got[0]["id"], got[0]["current_status"], got[0]["occupancy_status"], got[0]["trip_id"]) == (50.5, 20.0, 1.5, "B7", 1, -1, None)
    assert (got[1]["latitude"], got[1]["bearing"], got[1]["trip_id"], got[1]["longitude"]) == (100.0, 1.0, "T", None)
    assert (got[2]["current_stop_sequence"], got[2]["timestamp"]) == (None, None)


def test_damaged_messages(spark):
    good = HEADER + framed(2, framed(1, b"e") + framed(3, framed(1, framed(1, b"T1")) + framed(2, STOP_FULL)))
    damaged = [good[:-1], good[:20], b"\x00", b"\x0f", b"\x80" * 11, framed(2, b"\x1a\x7f"), framed(2, framed(3, framed(2, b"\x0b"))), framed(2, framed(3, framed(1, framed(1, b"\xff")) + framed(2, b"")))]
    got = rows(spark, [good, *damaged, good], realtime.decode_trip_updates, on_error="skip")
    assert [r["n"] for r in got] == [0, len(damaged) + 1]
    for one in damaged:
        with pytest.raises(Exception, match="1 of 2 messages can't be parsed"):
            df = spark.createDataFrame([(bytearray(c), "A") for c in (good, one)], "content binary, mode string").coalesce(1)
            realtime.decode_trip_updates(df.withColumn("load_timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))).count()
    with pytest.raises(ValueError, match="on_error"):
        realtime.decode_trip_updates(spark.createDataFrame([], "content binary, mode string, load_timestamp timestamp_ntz"), on_error="drop")
    assert rows(spark, [], realtime.decode_trip_updates) == rows(spark, [], realtime.decode_vehicle_positions) == []


def _feed(pick, size):
    feed = realtime.message_factory()()()
    feed.header.gtfs_realtime_version = "2.0"
    for e in range(pick.randrange(size)):
        entity = feed.entity.add(id=str(e))
        if pick.random() < 0.9:
            update = entity.trip_update
            if pick.random() < 0.9:
                update.trip.trip_id = "trip" * pick.randrange(40) + "ł"
            for _ in range(pick.randrange(6)):
                stop = update.stop_time_update.add()
                for name, value in (("stop_id", f"S{pick.randrange(999)}"), ("stop_sequence", pick.randrange(1 << pick.randrange(1, 31))), ("schedule_relationship", pick.randrange(-3, 4))):
                    if pick.random() < 0.7:
                        setattr(stop, name, value)
                for event in (stop.arrival, stop.departure):
                    if pick.random() < 0.6:
                        event.time = pick.randrange(-(1 << 62), 1 << 62) >> pick.randrange(62)
                    elif pick.random() < 0.5:
                        event.delay = pick.randrange(-99, 99)
        if pick.random() < 0.3:
            entity.vehicle.position.latitude = 1.5
    return feed


def _plain(feed, zero):
    for entity in feed.entity:
        if entity.HasField("trip_update"):
            for s in entity.trip_update.stop_time_update:
                get = lambda m, f: getattr(m, f) if m.HasField(f) else None
                moment = lambda f: None if not s.HasField(f) else getattr(s, f).time if getattr(s, f).HasField("time") or zero else None
                yield get(entity.trip_update.trip, "trip_id"), get(s, "stop_id"), get(s, "stop_sequence"), moment("arrival"), moment("departure"), get(s, "schedule_relationship")


def _columns(contents, zero=False):
    data = np.frombuffer(b"".join(contents) + bytes(wire.PADDING), np.uint8)
    found, root, bad = realtime._trip_update_rows(data, np.cumsum([0, *map(len, contents)]), zero)
    names = ("trip_id", "stop_id", "stop_sequence", "arrival", "departure", "schedule_relationship")
    texts = {n: realtime._as_text(found[n], root, bad).to_pylist() for n in names[:2]}
    return list(zip(root.tolist(), *(texts.get(n) or found[n].to_pylist() for n in names))), bad


@pytest.mark.parametrize("count, size", [(1, 3), (5, 60), (80, 12)])  # few messages are stepped over one by one, many in step
def test_against_message_objects(count, size):
    pick = random.Random(count)
    feeds = [_feed(pick, size) for _ in range(count)]
    contents = [f.SerializePartialToString() for f in feeds]
    for zero in (False, True):
        got, bad = _columns(contents, zero)
        assert not bad.any()
        assert got == [(n, *r) for n, f in enumerate(feeds) for r in _plain(f, zero)]


def test_cut_bytes_never_pass_silently():
    """Whatever is cut off: rows equal those of the message library, or the message is marked."""
    pick = random.Random(3)
    whole = [_feed(pick, 5).SerializePartialToString() for _ in range(60)]
    contents = [c[: pick.randrange(len(c) + 1)] for c in whole]
    got, bad = _columns(contents)
    for n, content in enumerate(contents):
        feed = realtime.message_factory()()()
        try:
            feed.ParseFromString(content)
        except Exception:
            assert bad[n]
        else:
            assert not bad[n] and [r[1:] for r in got if r[0] == n] == list(_plain(feed, False))


def test_stepping_in_arrays_equals_single_steps():
    pick = np.random.default_rng(1)
    data = np.concatenate([pick.choice(np.array([0, 1, 2, 8, 10, 11, 12, 13, 18, 128, 255], np.uint8), 4000), np.zeros(wire.PADDING, np.uint8)])
    edges = np.sort(pick.integers(0, 4000, 1500))
    one, bad_one = wire.fields(data, edges[:-1], edges[1:], few=1 << 30)
    many, bad_many = wire.fields(data, edges[:-1], edges[1:], few=0)
    assert (bad_one == bad_many).all() and 0 < bad_one.sum() < len(bad_one)
    for name in wire.Fields.__dataclass_fields__:
        sides = []
        for found, bad in ((one, bad_one), (many, bad_many)):
            kept = np.flatnonzero(~bad[found.message])
            sides.append(getattr(found, name)[kept[np.argsort(found.start[kept])]])
        assert (sides[0] == sides[1]).all() and len(sides[0]), name
