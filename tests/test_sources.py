import csv
import datetime
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from punctualis.operators.stats import polygon_centroid
from punctualis.sources import gtfs_static, json_feeds, realtime, sinks, tables

RECORD = {
    "STOP_NAME": "Test Stop", "stop_lat": 50.0, "stop_lon": 20.0, "current_speed": 10.0, "free_flow_speed": 20.0,
    "current_travel_time": 50.0, "free_flow_travel_time": 25.0, "confidence": 0.9, "load_timestamp": "2026-05-17",
}


def feed_message(vehicle=False):
    feed = realtime.message_factory()()()
    feed.header.gtfs_realtime_version = "2.0"
    if vehicle:
        full = feed.entity.add(id="1").vehicle
        full.trip.trip_id, full.trip.route_id, full.vehicle.id = "T1", "R1", "B7"
        full.position.latitude, full.position.longitude, full.position.speed = 50.5, 19.5, 3.5
        full.current_status, full.timestamp = 1, 1704067200
        feed.entity.add(id="2").vehicle.stop_id = "S9"
    else:
        update = feed.entity.add(id="1").trip_update
        update.trip.trip_id = "T1"
        a = update.stop_time_update.add(stop_id="S1", stop_sequence=1)
        a.arrival.time = 1704067200
        b = update.stop_time_update.add(stop_sequence=2)
        b.arrival.delay = 30
        feed.entity.add(id="2").trip_update.trip.route_id = "no stops"
    return feed.SerializeToString()


def raw(spark, content):
    return spark.createDataFrame([(bytearray(content), "A")], "content binary, mode string").withColumn("load_timestamp", F.lit("2024-01-01 00:00:30").cast("timestamp_ntz"))


def test_trip_update_fields(spark):
    got = [r.asDict() for r in realtime.decode_trip_updates(raw(spark, feed_message())).orderBy("stop_sequence").collect()]
    assert [(r["trip_id"], r["stop_id"], r["stop_sequence"], r["arrival"], r["departure"], r["schedule_relationship"], r["mode"]) for r in got] == [
        ("T1", "S1", 1, 1704067200, None, None, "A"), ("T1", None, 2, None, None, None, "A")]
    assert str(got[0]["load_timestamp"]) == "2024-01-01 00:00:30"
    zero = realtime.decode_trip_updates(raw(spark, feed_message()), absent_time_as_zero=True).filter("stop_sequence = 2").first()
    assert zero["arrival"] == 0 and zero["departure"] is None


def test_vehicle_fields(spark):
    df = realtime.decode_vehicle_positions(raw(spark, feed_message(vehicle=True)))
    assert len(df.columns) == 27
    full, bare = sorted(df.collect(), key=lambda r: r["id"] or "~")
    assert (full["trip_id"], full["route_id"], full["latitude"], full["speed"], full["current_status"], full["bearing"]) == ("T1", "R1", 50.5, 3.5, 1, None)
    assert (bare["stop_id"], bare["latitude"], bare["trip_id"], bare["current_status"], bare["position"]) == ("S9", None, None, None, None)


def test_broken_message(spark):
    bad = raw(spark, b"\xff\xff\xff")
    assert realtime.decode_trip_updates(bad, on_error="skip").count() == 0
    with pytest.raises(Exception):
        realtime.decode_trip_updates(bad).count()


def write_feed(folder, stops, extra=None):
    folder.mkdir(parents=True)
    with open(folder / "stops.txt", "w", newline="") as f:
        csv.writer(f).writerows([["stop_lat", "stop_id", "stop_name", "stop_lon"], *stops])
    for name, text in (extra or {}).items():
        (folder / name).write_text(text)


def test_static_feeds_union_and_archives(spark, tmp_path):
    stops = [["50.1", "S1", 'Rondo "A", main', "19.9"], ["50.1", "S1", 'Rondo "A", main', "19.9"], ["bad", "S2", "", "20"]]
    write_feed(tmp_path / "A", stops, {"calendar.txt": "service_id,monday,start_date,end_date\nV,1,20240101,20240107\n", "agency.txt": "x\n1\n"})
    write_feed(tmp_path / "T", [["50.2", "S1", "Tram", "19.8"]])
    for mode in "AT":
        with zipfile.ZipFile(tmp_path / f"{mode}.zip", "w") as z:
            for file in (tmp_path / mode).iterdir():
                z.write(file, f"sub/{file.name}")
    folders = gtfs_static.read_gtfs_static(spark, {m: str(tmp_path / m) for m in "AT"}, "2024-01-01")
    zips = gtfs_static.read_gtfs_archives(spark, {m: str(tmp_path / f"{m}.zip") for m in "AT"}, "2024-01-01")
    assert set(folders) == {"stops", "calendar"}
    pick = lambda d: sorted(((r["stop_id"], r["stop_name"], r["stop_lat"], r["stop_lon"], r["mode"], r["stop_code"]) for r in d["stops"].collect()), key=str)
    assert pick(folders) == pick(zips) == [("S1", 'Rondo "A", main', 50.1, 19.9, "A", None), ("S1", "Tram", 50.2, 19.8, "T", None), ("S2", None, None, 20.0, "A", None)]
    assert [(r["monday"], r["tuesday"], r["start_date"]) for r in zips["calendar"].collect()] == [(1, None, "20240101")]
    assert zips["shapes"].count() == 0


def test_traffic_round_trip_and_corrupt_file(spark, tmp_path):
    (tmp_path / "traffic_20260517_0715.json").write_text(json.dumps([RECORD, {"STOP_NAME": "Valid Stop"}]))
    (tmp_path / "traffic_20260517_0730.json").write_text("{ invalid json }")
    (tmp_path / "traffic_20260517_0745.json").write_text("[]")
    (tmp_path / "other.json").write_text(json.dumps([RECORD]))
    good, bad = json_feeds.read_traffic(spark, str(tmp_path))
    rows = {r["STOP_NAME"]: r for r in good.collect()}
    assert set(rows) == {"Test Stop", "Valid Stop"} and rows["Valid Stop"]["current_speed"] is None
    assert {k: v for k, v in rows["Test Stop"].asDict().items() if k != "load_timestamp"} == {k: v for k, v in RECORD.items() if k != "load_timestamp"}
    assert [r["path"].endswith("0730.json") for r in bad.collect()] == [True]


def test_flow_segment(spark):
    answer = {"flowSegmentData": {"currentSpeed": 23.5, "freeFlowSpeed": 45.0, "currentTravelTime": 70.0, "freeFlowTravelTime": 40.0, "confidence": 0.98}}
    df = spark.createDataFrame([("S", json.dumps(answer)), ("T", "{}")], "stop string, payload string")
    rows = {r["stop"]: tuple(r)[1:] for r in json_feeds.flatten_flow_segment(df).collect()}
    assert rows == {"S": (23.5, 45.0, 70.0, 40.0, 0.98), "T": (None,) * 5}


def test_ragged_weather(spark):
    body = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5], "is_day": [0, 1], "visibility": [1.0, 2.0, 3.0]}}
    df = spark.createDataFrame([("d", 1.0, 2.0, json.dumps(body)), ("e", 1.0, 2.0, "{}")], "district_name string, latitude double, longitude double, payload string")
    rows = [(str(r["timestamp"]), r["temperature_2m"], r["is_day"], r["visibility"], r["cloud_cover"]) for r in json_feeds.explode_hourly(df).orderBy("timestamp").collect()]
    assert rows == [("2024-01-01 00:00:00", 1.5, False, 1.0, None), ("2024-01-01 01:00:00", None, True, 2.0, None)]
    assert json_feeds.explode_min15(df).count() == 0


def test_geojson_centroids(spark, tmp_path):
    sq = lambda x: [[x, 0], [x + 2, 0], [x + 2, 2], [x, 2], [x, 0]]
    features = [
        {"type": "Feature", "properties": {"name": "Bieńczyce (XVI)"}, "geometry": {"type": "Polygon", "coordinates": [sq(0)]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[sq(0)[:-1]], [sq(10)]]}},
    ]
    path = tmp_path / "d.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, ensure_ascii=False), encoding="utf-8")
    points = json_feeds.read_geojson(spark, str(path))
    assert {r["name"]: (r["longitude"], r["latitude"]) for r in polygon_centroid(points).collect()} == {"Bieńczyce (XVI)": (1.0, 1.0), "UNKNOWN": (6.0, 1.0)}


def stamped(spark, data):
    return spark.createDataFrame(data, "k int, ts string").select("k", F.col("ts").cast("timestamp_ntz").alias("load_timestamp"))


def test_snapshots_window(spark, tmp_path):
    for i, stamp in enumerate(["20240101_100000", "20240101_103000", "20240101_110000"]):
        assert sinks.write_snapshot(spark.range(i, i + 1), str(tmp_path), "trip_updates", stamp)
    assert not sinks.write_snapshot(spark.range(0), str(tmp_path), "trip_updates", "20240101_120000")
    spark.range(1).write.parquet(str(tmp_path / "trip_updates_oops.parquet"))
    got = tables.read_snapshots(spark, str(tmp_path), "trip_updates", "2024-01-01 10:30:00", "2024-01-01 11:00:00")
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


def test_daily_and_incremental_export(spark, tmp_path):
    path = str(tmp_path / "x")
    day1 = stamped(spark, [(1, "2024-01-01 05:00:00"), (2, "2024-01-02 06:00:00"), (0, None)])
    sinks.export(day1, path, "daily")
    more = stamped(spark, [(1, "2024-01-01 05:00:00"), (9, "2024-01-01 23:00:00"), (2, "2024-01-02 06:00:00"), (3, "2024-01-03 00:00:00"), (0, None)])
    keys = lambda: sorted(r["k"] for r in spark.read.parquet(path).collect())
    assert keys() == [0, 1, 2]
    for _ in range(2):  # a late row of an exported day is exported, once
        sinks.export(more, path, "daily")
        assert keys() == [0, 1, 2, 3, 9]
    grown = more.unionByName(stamped(spark, [(4, "2024-01-03 09:00:00"), (5, None)]))
    for _ in range(2):
        sinks.export(grown, path, "incremental", since="2024-01-03 00:00:00")
        assert keys() == [0, 1, 2, 3, 4, 5, 9]
    assert not sinks.export_full(day1.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    assert sinks.export_full(day1, str(tmp_path / "full"))


def test_export_layout_never_changes_as_a_table_grows(spark, tmp_path):
    assert sinks.export_strategy(False, None) == "full" == sinks.export_strategy(False, "2024-01-01")
    assert sinks.export_strategy(True, None) == "daily"
    assert sinks.export_strategy(True, "2024-01-01") == "incremental"
    path = str(tmp_path / "t")
    rows = [(i, f"2024-01-0{i % 3 + 1} 00:00:00") for i in range(10)]
    sinks.export(stamped(spark, rows), path, sinks.export_strategy(True, None))
    rows += [(10 + i, f"2024-01-0{i % 3 + 3} 01:00:00") for i in range(10)]
    for since in ("2024-01-03 00:00:00", None):
        sinks.export(stamped(spark, rows), path, sinks.export_strategy(True, since), since)
        assert spark.read.parquet(path).count() == 20


def test_missing_rows_of_loaded_days_are_loaded_once(spark):
    rows = [(1, "2024-01-01 05:00:00"), (2, "2024-01-02 06:00:00"), (3, None)]
    more = [*rows, (4, "2024-01-01 07:00:00"), (4, "2024-01-01 07:00:00"), (5, "2024-01-03 07:00:00"), (6, None)]
    missing = sinks.load_missing_dates(stamped(spark, more), stamped(spark, rows))
    assert sorted(r["k"] for r in missing.collect()) == [4, 4, 5, 6]
    assert sinks.load_missing_dates(stamped(spark, more), stamped(spark, more)).count() == 0


def test_load_by_name_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    target = stamped(spark, [(1, "2024-01-01 00:00:00")]).withColumn("note", F.lit("n"))
    sinks.overwrite_table(spark.createDataFrame([("7", "x")], "K string, other string"), path)
    loaded = sinks.load_parquet(spark, path, target.schema)
    assert loaded.columns == ["k", "load_timestamp", "note"] and tuple(loaded.first()) == (7, None, None)
    sinks.overwrite_table(spark.createDataFrame([("bad",)], "K string"), path)
    with pytest.raises(Exception):
        sinks.load_parquet(spark, path, target.schema).collect()
    sinks.overwrite_table(target, path)
    sinks.replace_table(spark.read.parquet(path).withColumn("k", F.col("k") + 1), path)
    assert [r["k"] for r in spark.read.parquet(path).collect()] == [2]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_append_creates_empty_table_and_dedup(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    sinks.append_table(rows.limit(0), path)
    assert spark.read.parquet(path).columns == ["k", "v"] and spark.read.parquet(path).count() == 0
    sinks.append_table(rows, path)
    before, after = sinks.dedup_table(spark, path)
    assert before == {"total_rows": 3, "distinct_rows": 2, "duplicate_rows": 1} and after["duplicate_rows"] == 0
    assert sinks.dedup_table(spark, path)[0] == after
    sinks.upsert_table(spark.createDataFrame([(2, "new"), (3, "c")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "new"), (3, "c")]


def test_load_static_twice_changes_nothing(spark, tmp_path):
    routes = lambda day, name: spark.createDataFrame([("R1", "A", name)], "route_id string, mode string, route_short_name string").withColumn("load_timestamp", F.lit(day).cast("timestamp_ntz"))
    staged = {"routes": routes("2024-01-01", "50"), "stops": stamped(spark, [(1, "2024-01-01 00:00:00"), (2, "2023-12-31 00:00:00")])}
    root = str(tmp_path)
    for _ in range(2):
        sinks.load_static(staged, root)
    assert [r["k"] for r in spark.read.parquet(f"{root}/stops").collect()] == [1]
    staged["routes"] = routes("2024-01-02", "52")
    for _ in range(2):
        sinks.load_static(staged, root)
    versions = sorted((r["route_short_name"], str(r["valid_from"])[:10], r["is_current"]) for r in spark.read.parquet(f"{root}/routes_scd2").collect())
    assert versions == [("50", "1900-01-01", False), ("52", "2024-01-02", True)]


def test_normalized_schema(spark):
    df = spark.createDataFrame([(1, 2.5, True, "2024-01-01 10:00:00", "x")], "a int, b double, c boolean, load_timestamp string, d string")
    out = sinks.normalize_schema(df)
    assert out.dtypes == [("A", "bigint"), ("B", "double"), ("C", "string"), ("LOAD_TIMESTAMP", "timestamp_ntz"), ("D", "string")]


def test_adhoc_guard_and_catalog(spark):
    spark.range(300).createOrReplaceTempView("numbers")
    assert tables.adhoc_select(spark, " select id, 'speed limit' from numbers; ").count() == 300
    assert tables.adhoc_select(spark, "SELECT id FROM numbers LIMIT 150", limit=100).count() == 100
    assert tables.adhoc_select(spark, "SELECT id FROM numbers", limit=7).count() == 7
    for text in ("DROP TABLE numbers", "selected", "WITH x AS (SELECT 1) SELECT * FROM x"):
        with pytest.raises(ValueError):
            tables.adhoc_select(spark, text)
    assert "numbers" in [r["table"] for r in tables.list_tables(spark).collect()]
    assert [tuple(r) for r in tables.describe(spark.table("numbers")).collect()] == [("id", "bigint", False)]


def test_delays_csv_round_trip(spark, tmp_path, sf_dir):
    from catalogue.adapter import Feed

    delays = Feed(spark, sf_dir).delays()
    sinks.write_csv(delays, str(tmp_path / "d"))
    back = tables.read_delays_csv(spark, str(tmp_path / "d"))
    assert back.dtypes == delays.dtypes and back.exceptAll(delays).count() == 0 and back.count() == delays.count()


def test_days_with_equal_counts_are_compared_by_content(spark, tmp_path):
    schema = "load_timestamp timestamp_ntz, a int, b int, tags array<string>"
    make = lambda *rows: spark.createDataFrame([(datetime.datetime(2024, 1, day), a, b, ["x"]) for day, a, b in rows], schema)
    old = make((1, 1, 1), (1, 2, 2), (2, 3, 3), (3, None, 5))
    new = make((1, 1, 1), (1, 9, 9), (2, 3, 3), (3, 5, None))
    rows = lambda df: sorted(((r.load_timestamp.day, r.a, r.b) for r in df.collect()), key=repr)
    assert rows(sinks.load_missing_dates(new, old)) == [(1, 9, 9), (3, 5, None)]
    path = str(tmp_path / "daily")
    sinks.export_daily(old, path)
    assert rows(sinks.changed_days(sinks.with_day(old), spark.read.parquet(path))) == []
    sinks.export_daily(new, path)
    assert rows(spark.read.parquet(path)) == rows(new)
