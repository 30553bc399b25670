import pytest
from pyspark.sql import functions as F

from catalogue.adapter import Feed
from punctualis.plans import calendar, delays, features, report, schedule, vehicles
from punctualis.sources import sinks

V1 = "timestamp_ntz'2024-01-01'"


def rows(df):
    return [tuple(r) for r in df.collect()]


def updates(spark, data):
    """(stop, seq, local arrival text, poll) of trip T mode A; January, so local is UTC + 1 h."""
    df = spark.createDataFrame(data, "stop_id string, stop_sequence int, local string, poll string")
    epoch = F.unix_timestamp(F.col("local").cast("timestamp_ntz")) - 3600
    return df.select(
        F.lit("T").alias("trip_id"), "stop_id", "stop_sequence", epoch.alias("arrival"), F.lit(None).cast("long").alias("departure"),
        F.lit(0).alias("schedule_relationship"), F.col("poll").cast("timestamp_ntz").alias("load_timestamp"), F.lit("A").alias("mode"),
    )


def planned(spark, data):
    df = spark.createDataFrame(data, "stop_id string, stop_sequence int, event_date string, arrival_time string")
    return df.select(
        F.lit("T").alias("trip_id"), F.lit("A").alias("mode"), F.lit("L1").alias("route_short_name"), "arrival_time", "stop_sequence",
        F.lit(1.0).alias("shape_dist_traveled"), F.lit("head").alias("trip_headsign"), F.lit("name").alias("stop_name"), "stop_id",
        F.lit(50.0).alias("stop_lat"), F.lit(20.0).alias("stop_lon"), "event_date", F.lit(False).alias("is_night_trip"), F.expr(V1).alias("load_timestamp"),
    )


def test_calendar_rules(spark):
    cal = spark.sql(f"""select * from values
        ('W', 1,1,1,1,1,0,0, '20231228', '20240110', 'A', {V1}), ('OLD', 1,1,1,1,1,1,1, '20231201', '20231215', 'A', {V1})
        t(service_id, monday, tuesday, wednesday, thursday, friday, saturday, sunday, start_date, end_date, mode, load_timestamp)""")
    ex = spark.sql(f"""select * from values ('W', '20240103', 2, 'A', {V1}), ('W', '20240106', 1, 'A', {V1}), ('W', '20240120', 1, 'A', {V1}), ('ONLY', '20240103', 1, 'A', {V1})
        t(service_id, date, exception_type, mode, load_timestamp)""")
    days = sorted(r["event_date"] for r in calendar.expand_calendar(cal, ex).collect())
    # starts at the first load, no Wednesday 3rd, added Saturday 6th, nothing outside the period
    assert days == ["20240101", "20240102", "20240104", "20240105", "20240106", "20240108", "20240109", "20240110"]


def test_midnight_in_both_directions(spark):
    upd = updates(spark, [
        ("S1", 1, "2024-01-05 23:58:00", "2024-01-05 20:00:00"),  # planned 00:03 on the 6th
        ("S2", 2, "2024-01-06 00:03:00", "2024-01-05 20:00:00"),  # planned 23:58 on the 5th
        ("S3", 3, "2024-01-05 23:58:00", "2024-01-05 20:00:00"),  # planned 00:03 on the 5th: other end of the day, no match
        ("S4", 4, "2024-01-05 10:00:00", "2024-01-05 20:00:00"),
    ])
    plan = planned(spark, [("S1", 1, "20240106", "00:03:00"), ("S2", 2, "20240105", "23:58:00"), ("S3", 3, "20240105", "00:03:00"), ("S4", 4, "20240105", "09:50:00")])
    got = {r["stop_id"]: (r["event_date"], r["delay"]) for r in delays.build_delays(upd, plan).collect()}
    assert got == {"S1": ("20240106", 0), "S2": ("20240105", 5), "S4": ("20240105", 10)}


def test_text_hour_misses_unpadded_night_times(spark):
    upd = updates(spark, [("S1", 1, "2024-01-05 23:50:00", "2024-01-05 20:00:00"), ("S2", 2, "2024-01-05 23:58:00", "2024-01-05 20:00:00")])
    plan = planned(spark, [("S1", 1, "20240106", "0:01:00"), ("S2", 2, "20240106", "0:03:00")])
    assert delays.build_delay_vectors(upd, plan).count() == 1
    assert delays.build_delay_vectors(upd, plan, strict_text_hour=True).count() == 0


def test_latest_update_wins_and_missing_times(spark):
    upd = updates(spark, [("S1", 1, "2024-01-05 10:09:00", "2024-01-05 08:00:00"), ("S1", 1, "2024-01-05 10:02:59", "2024-01-05 09:00:00"), ("S2", 2, None, "2024-01-05 09:00:00")])
    only_departure = updates(spark, [("S3", 3, "2024-01-05 10:30:00", "2024-01-05 09:00:00")])
    only_departure = only_departure.withColumn("departure", F.col("arrival")).withColumn("arrival", F.lit(None).cast("long"))
    plan = planned(spark, [("S1", 1, "20240105", "10:00:00"), ("S2", 2, "20240105", "10:10:00"), ("S3", 3, "20240105", "10:31:00"), ("TR", 9, "20240105", "10:31:00")])
    got = {r["stop_id"]: r["delay"] for r in delays.build_delays(upd.unionByName(only_departure), plan).collect()}
    assert got == {"S1": 2, "S3": 0}


def test_vectors_are_stops_minus_one(spark, sf_dir):
    feed = Feed(spark, sf_dir)
    served = delays._matched(feed.trip_updates(), feed.schedule()).groupBy("trip_id", "mode", "event_date").count()
    made = feed.vectors().groupBy("trip_id", "mode", "event_date").agg(F.count(F.lit(1)).alias("made"))
    off = served.join(made, ["trip_id", "mode", "event_date"], "left").filter(F.coalesce("made", F.lit(0)) != F.col("count") - 1)
    assert off.count() == 0


def test_schedule_shape(spark, sf_dir):
    df = Feed(spark, sf_dir).schedule()
    assert df.columns == schedule.COLUMNS
    key = ["trip_id", "mode", "stop_id", "event_date", "is_night_trip"]
    assert df.groupBy(*key).count().filter("count > 1").count() == 0
    assert df.filter("stop_name is null").count() == 0
    assert df.filter("is_night_trip").count() > 0


def test_double_load_does_not_multiply_the_schedule(spark, sf_dir):
    f = Feed(spark, sf_dir)
    twice = lambda df: df.unionByName(df)
    once = f.schedule()
    doubled = schedule.build_trips_schedule(
        twice(f.stop_times()), twice(f.trips()), twice(f.stops()), f.routes_scd2(), calendar.expand_calendar(twice(f.calendar()), f.calendar_dates())
    )
    assert doubled.count() == once.count() and doubled.exceptAll(once).count() == 0


def test_join_keys_hold_for_the_midnight_match(spark, sf_dir):
    feed = Feed(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = delays._matched(feed.trip_updates(), feed.schedule())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "planned_day" in joins[0] and joins[0].index("planned_day") < joins[0].index("Inner")
    assert "CartesianProduct" not in plan


def test_repeated_stop_and_sequence_gap_in_report(spark):
    base = "select * from values {} t(trip_id, stop_sequence, stop_id, mode, delay, load_timestamp)"
    ts = lambda m: f"timestamp_ntz'2024-01-05 10:{m:02d}:00'"
    data = [("T", 1, "S1", "A", 1, ts(0)), ("T", 2, "S2", "A", 2, ts(1)), ("T", 2, "S2", "A", 5, ts(2)), ("T", 4, "S4", "A", 3, ts(3)), ("T", 1, "S1", "A", 7, ts(30)), ("T", 2, "S2", "A", 9, ts(31))]
    d = spark.sql(base.format(", ".join(f"('{a}', {b}, '{c}', '{e}', {f}, {g})" for a, b, c, e, f, g in data)))
    pairs = report.stop_pairs(report.latest_in_session(report.sessionize_resets(d)))
    assert sorted((r["session_id"], r["stop_id"], r["next_stop_id"], r["delay"]) for r in pairs.collect()) == [(0, "S1", "S2", 1), (1, "S1", "S2", 7)]
    stops = spark.sql("select * from values ('S1', 1.0D, 2.0D, timestamp_ntz'2024-01-05 03:00:00'), ('S2', 3.0D, 4.0D, timestamp_ntz'2024-01-05 03:00:00') t(stop_id, stop_lat, stop_lon, load_timestamp)")
    out = rows(report.segment_report(d, stops, "2024-01-05", "2024-01-05"))
    assert [(r[0], r[1], r[2], r[5], r[6]) for r in out] == [(2, 4.0, "S1", "S2", 3.0)]
    assert rows(report.segment_report(d, stops, "2024-01-05", "2024-01-05", fix_next=False))[0][6] == 1.0
    assert rows(report.segment_report(d, stops, "2024-01-06", "2024-01-07")) == []


def test_vehicle_local_date(spark):
    pos = spark.sql("""select * from values ('B1', 1.0D, 2.0D, 0.0D, 0.0D, 1, 2, timestamp_ntz'2024-01-05 23:30:00', 'T', 'A'), ('B0', 1.0D, 2.0D, 0.0D, 0.0D, 0, 2, timestamp_ntz'2024-01-05 23:30:00', 'T', 'A')
        t(id, latitude, longitude, bearing, speed, current_status, current_stop_sequence, load_timestamp, trip_id, mode)""")
    vec = spark.sql("select * from values ('T', 'A', '20240105', 2, 'utc'), ('T', 'A', '20240106', 2, 'local') t(trip_id, mode, event_date, end_stop_sequence, vector_unique_id)")
    assert [(r["vehicle_id"], r["vector_unique_id"]) for r in vehicles.match_vehicles(pos, vec).collect()] == [("B1", "utc")]
    assert [r["vector_unique_id"] for r in vehicles.match_vehicles(pos, vec, local_date=True).collect()] == ["local"]


def test_reference_points(spark):
    many = spark.range(100).select(F.col("id").cast("int").alias("district_number"), F.concat(F.lit("d"), "id").alias("district_name"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"))
    assert len(features.reference_points(many)) == 100
    assert [n for n, _, _ in features.reference_points(Feed(spark, "").districts())] == ["Bienczyce", "Nowa_Huta", "Pradnik_Biały", "Stare_Miasto", "Swoszowice"]


def test_service_period_has_no_longest_length(spark):
    row = ("V", *[1] * 7, "20240101", "20600101", "A")
    df = spark.createDataFrame([row], "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string, mode string")
    days = calendar.service_days(df.withColumn("load_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")))
    assert days.count() == 13150 and str(days.agg(F.max("day")).first()[0]) == "2060-01-01"


def test_daily_builds_add_up_to_the_full_mart(spark, sf_dir, tmp_path):
    feed, path = Feed(spark, sf_dir), str(tmp_path / "delays")
    full = feed.delay_mart()
    found = sorted(r["event_date"] for r in full.select("event_date").distinct().collect())
    assert len(found) > 1
    for day in [*found, found[0]]:
        sinks.overwrite_partitions(delays.build_delays(feed.trip_updates(), feed.schedule(), (day, day)), path, ["event_date"])
    stored = spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("string")).select(full.columns)
    assert stored.count() == full.count() and stored.exceptAll(full).count() == 0
    vectors = feed.vectors()
    part = delays.build_delay_vectors(feed.trip_updates(), feed.schedule(), days=(found[0], found[0]))
    assert part.exceptAll(vectors.filter(F.col("event_date") == found[0])).count() == 0
    assert part.count() == vectors.filter(F.col("event_date") == found[0]).count()
