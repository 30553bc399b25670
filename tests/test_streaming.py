import json

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from punctualis.operators.dedup import latest_per_key
from punctualis.plans import incremental
from punctualis.plans.delays import build_delays
from punctualis.schemas import TRIP_UPDATES
from punctualis.sources import committed
from punctualis.streaming import loads
from tests.test_sources import RECORD, feed_message

NOW = {"availableNow": True}


def test_landing_decodes_each_file_once(spark, tmp_path):
    land, out, cp = (str(tmp_path / d) for d in ("land", "out", "cp"))
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "trip_updates_A_20240101_100000.pb").write_bytes(feed_message())
    (tmp_path / "land" / "vehicle_positions_A_20240101_100000.pb").write_bytes(feed_message(vehicle=True))
    (tmp_path / "land" / "trip_updates_A_garbage.pb").write_bytes(feed_message())
    for _ in range(2):
        loads.stream_landing(spark, land, "trip_updates", out, cp, NOW).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    (tmp_path / "land" / "trip_updates_T_20240101_100100.pb").write_bytes(feed_message())
    loads.stream_landing(spark, land, "trip_updates", out, cp, NOW).awaitTermination()
    assert sorted((r["mode"], r["stop_sequence"]) for r in spark.read.parquet(out).collect()) == [("A", 1), ("A", 2), ("T", 1), ("T", 2)]
    loads.stream_landing(spark, land, "vehicle_positions", out + "_v", cp + "_v", NOW).awaitTermination()
    assert spark.read.parquet(out + "_v").count() == 2


def test_append_equals_batch(spark, tmp_path, sf_dir):
    src, out, cp = (str(tmp_path / d) for d in ("src", "out", "cp"))
    updates = Feed(spark, sf_dir).trip_updates()
    halves = updates.filter("mode = 'A'"), updates.filter("mode != 'A'")
    for half in halves:
        half.write.mode("append").parquet(src)
        loads.stream_append(spark, src, TRIP_UPDATES, out, cp, NOW).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() == updates.count() and streamed.exceptAll(updates).count() == 0


def test_traffic_drain(spark, tmp_path):
    land, out, cp = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "cp")
    land.mkdir()
    (land / "traffic_20260517_0715.json").write_text(json.dumps([RECORD]))
    (land / "traffic_20260517_0730.json").write_text("{ invalid json }")
    for _ in range(2):
        loads.stream_traffic(spark, str(land), out, cp, NOW).awaitTermination()
    (land / "traffic_20260517_0745.json").write_text(json.dumps([RECORD, RECORD]))
    loads.stream_traffic(spark, str(land), out, cp, NOW).awaitTermination()
    assert spark.read.parquet(out).count() == 3 and spark.read.parquet(out + "_bad").count() == 1


def _log(spark, sf_dir):
    return Feed(spark, sf_dir).trip_updates().select(
        "trip_id", "mode", "stop_id", "stop_sequence", "load_timestamp", "departure", F.to_date("load_timestamp").alias("day")
    )


KEYS, ORDER = ["trip_id", "mode", "stop_id", "day"], ["load_timestamp", "stop_sequence"]


def test_latest_table_equals_batch(spark, tmp_path, sf_dir):
    src = str(tmp_path / "src")
    updates = _log(spark, sf_dir)
    want = latest_per_key(updates, KEYS, [F.col(c).desc() for c in ORDER]).select(updates.columns)
    stream = lambda: spark.readStream.schema(updates.schema).parquet(src)
    path, cp = str(tmp_path / "table"), str(tmp_path / "cp")
    late_first = updates.filter("stop_sequence % 2 = 0 or hour(load_timestamp) > 12"), updates.filter("not (stop_sequence % 2 = 0 or hour(load_timestamp) > 12)")
    for part in late_first:
        part.write.mode("append").parquet(src)
        loads.stream_latest_table(stream(), KEYS, ORDER, path, cp).awaitTermination()
    kept = committed.read(spark, path).select(updates.columns)
    assert kept.count() == want.count() and kept.exceptAll(want).count() == 0

    state = loads.stream_latest(stream(), KEYS, ORDER)
    query = state.writeStream.format("memory").queryName("latest_state").outputMode("complete").trigger(**NOW).start()
    query.awaitTermination()
    got = spark.table("latest_state").select(updates.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_state_is_bounded_and_late_rows_win(spark, tmp_path):
    """Twelve days of 50 keys, a file per day; every third day also brings newer rows of the day before."""
    src, path = str(tmp_path / "src"), str(tmp_path / "t")
    schema = "k string, ev timestamp_ntz, poll int, v string"
    rows = []
    for day in range(12):
        batch = [(f"k{i}", day, 1, f"first {day}") for i in range(50)]
        batch += [(f"k{i}", day - 1, 2, f"late {day}") for i in range(0, 50, 5)] if day % 3 == 0 and day else []
        rows += batch
        df = spark.createDataFrame(batch, "k string, day int, poll int, v string").select(
            "k", F.expr("timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(day)").alias("ev"), "poll", "v").coalesce(1)
        df.write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    query = loads.stream_latest_state(stream, ["k"], ["poll"], "ev", path, str(tmp_path / "cp"), lateness="2 days")
    query.awaitTermination()
    sized = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    # The store counts a key more than once; what matters is that the count stops growing after the first days.
    assert len(sized) >= 12 and sized[3] > sized[0] and max(sized[6:]) <= max(sized[:6]) and dropped == 0
    table = committed.read(spark, path).select("k", F.datediff(F.to_date("ev"), F.lit("2024-01-01")).alias("day"), "poll", "v").collect()
    newest = {}
    for k, day, poll, v in rows:
        newest[k, day] = max(newest.get((k, day), (0, "")), (poll, v))
    assert {(r.k, r.day): (r.poll, r.v) for r in table} == newest and len(table) == len(newest)


def test_marts_after_any_split(spark, tmp_path, sf_dir):
    feed = Feed(spark, sf_dir)
    updates, plan, root, src = feed.trip_updates(), str(tmp_path / "plan"), str(tmp_path / "marts"), str(tmp_path / "src")
    feed.schedule().write.parquet(plan)
    schema = updates.schema
    start = lambda: loads.stream_marts(spark.readStream.schema(schema).parquet(src), lambda s: s.read.parquet(plan), root, str(tmp_path / "cp"))
    for part in ("abs(hash(trip_id, stop_sequence)) % 3 = 1", "abs(hash(trip_id, stop_sequence)) % 3 = 0 and hour(load_timestamp) < 12", "abs(hash(trip_id, stop_sequence)) % 3 = 2 or (abs(hash(trip_id, stop_sequence)) % 3 = 0 and hour(load_timestamp) >= 12)"):
        updates.filter(part).write.mode("append").parquet(src)
        start().awaitTermination()
    want = feed.delay_mart()
    got = committed.read(spark, f"{root}/mart").select(want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    sums = committed.read(spark, f"{root}/sums")
    assert sums.exceptAll(incremental.delay_sums(want).select(sums.columns)).isEmpty() and sums.count() == incremental.delay_sums(want).count()


def test_marts_after_a_crash(spark, tmp_path, sf_dir, monkeypatch):
    feed = Feed(spark, sf_dir)
    updates, plan, root = feed.trip_updates(), feed.schedule().where("trip_id like '%1'"), str(tmp_path / "marts")
    some = updates.where("trip_id like '%1'")
    halves = some.where("stop_sequence < 3"), some.where("stop_sequence >= 3")
    incremental.update_marts(halves[0], plan, root, ("m", 0))
    with monkeypatch.context() as m:
        m.setattr(committed, "replace_keys", lambda *a, **k: 1 / 0)
        try:
            incremental.update_marts(halves[1], plan, root, ("m", 1))
        except ZeroDivisionError:
            pass
    for _ in range(2):
        incremental.update_marts(halves[1], plan, root, ("m", 1))
    want = build_delays(some, plan)
    got, sums = committed.read(spark, f"{root}/mart").select(want.columns), committed.read(spark, f"{root}/sums")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert sums.exceptAll(incremental.delay_sums(want).select(sums.columns)).isEmpty() and sums.agg(F.sum("cnt")).first()[0] == want.count()


def test_files_go_after_they_are_read(spark, tmp_path):
    """Retention: with ``clean="delete"`` a processed file is removed, at the latest with the next batch; unread ones stay."""
    land, out, cp = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "cp")
    land.mkdir()
    for n in range(3):
        (land / f"trip_updates_A_20240101_10000{n}.pb").write_bytes(feed_message())
        loads.stream_landing(spark, str(land), "trip_updates", out, cp, NOW, clean="delete").awaitTermination()
    left = sorted(f.name for f in land.iterdir() if f.suffix == ".pb")
    assert len(left) < 3 and "trip_updates_A_20240101_100002.pb" in left
    assert spark.read.parquet(out).count() == 6
