from pyspark.sql import functions as F

from catalogue.adapter import Feed
from punctualis.operators import prefix
from punctualis.plans import delays, features, incremental, schedule, sessions
from punctualis.sources import committed
from punctualis.streaming import loads
from tests.test_plans import updates
from tests.test_served_days import feed


def test_only_runs_that_updates_change_are_touched(spark):
    found = updates(spark, [("S3", 3, "2024-01-05 09:04:00", "2024-01-05 09:00:00"), ("S1", 1, "2024-01-06 23:59:00", "2024-01-06 23:00:00"), ("S1", 1, None, "2024-01-09 23:00:00")])
    got = sorted(r.event_date for r in incremental.touched_runs(found).collect())
    assert got == ["20240105", "20240106", "20240107"]


def test_an_update_takes_back_what_an_older_one_matched_across_midnight(spark, tmp_path):
    plan, root = schedule.build_trips_schedule(*feed(spark)), str(tmp_path / "marts")
    loads = [
        [("S1", 1, "2024-01-05 00:01:00", "2024-01-04 22:00:00"), ("S3", 3, "2024-01-06 09:04:00", "2024-01-04 22:00:00")],  # planned 23:58 of the 4th
        [("S1", 1, "2024-01-05 02:00:00", "2024-01-04 23:00:00")],  # no longer near midnight: goes with the plan of the 5th
    ]
    for number, rows in enumerate(loads):
        incremental.update_marts(updates(spark, rows), plan, root, ("m", number))
        want = delays.build_delays(updates(spark, sum(loads[: number + 1], [])), plan)
        got = committed.read(spark, f"{root}/mart").select(want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and got.count() == 2
    assert {r.event_date for r in got.collect()} == {"20240105", "20240106"}
    sums = committed.read(spark, f"{root}/sums")
    assert sums.exceptAll(incremental.delay_sums(want).select(sums.columns)).isEmpty() and sums.count() == 2


def test_streaming_state_lies_on_disk(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "t")
    spark.sql("select concat('k', id % 3) as k, timestamp_ntz'2024-01-01 08:00:00' as ev, cast(id as int) as poll from range(9)").write.parquet(src)
    stream = spark.readStream.schema("k string, ev timestamp_ntz, poll int").parquet(src)
    query = loads.stream_latest_state(stream, ["k"], ["poll"], "ev", path, str(tmp_path / "cp"))
    query.awaitTermination()
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert states and all(any(name.startswith("rocksdb") for name in s["customMetrics"]) for s in states) and max(s["numRowsTotal"] for s in states) == 3
    assert sorted((r.k, r.poll) for r in committed.read(spark, path).collect()) == [("k0", 6), ("k1", 7), ("k2", 8)]


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in text.splitlines() if "Exchange " in line and "Reused" not in line]


def test_tables_on_the_same_visits_share_their_shuffle(spark, sf_dir):
    f = Feed(spark, sf_dir)
    both = f.stop_times().groupBy("mode").agg(F.count("stop_id").alias("n")).join(f.trip_updates().groupBy("mode").agg(F.max("arrival").alias("t")), "mode")
    assert len([x for x in exchanges(both) if "hashpartitioning(l_orderkey" in x]) == 1
    assert f.visits().columns == ["l_orderkey", "l_linenumber", "supp", "part", "dist"]


def test_newest_updates_are_dealt_without_their_candidates(spark):
    found = updates(spark, [("S1", 1, "2024-01-05 00:01:00", "2024-01-04 22:00:00"), ("S3", 3, "2024-01-05 09:04:00", "2024-01-04 22:00:00"), ("S3", 3, None, "2024-01-04 23:00:00")])
    plan = schedule.build_trips_schedule(*feed(spark))
    got = delays.build_delays(found.withColumn("trip_id", F.when(F.col("stop_sequence") < 9, F.col("trip_id"))), plan)
    assert [x for x in exchanges(got) if "hashpartitioning(trip_id" in x and "REPARTITION_BY_COL" in x and "planned_day" not in x]
    assert sorted(r.event_date for r in got.collect()) == ["20240104", "20240105"]


def test_stop_times_are_dealt_once_for_starts_and_newest_rows(spark):
    times = spark.sql("""select if(id = 5, null, concat('T', id div 3)) as trip_id, concat('A', id div 3) as mode, concat('S', id) as stop_id, cast(id as int) as stop_sequence, '08:00:00' as arrival_time,
        concat('08:0', id, ':30') as departure_time, 1.0D as shape_dist_traveled, timestamp_ntz'2024-01-01' as load_timestamp from range(6)""")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = features.latest_stop_times(times)
        assert len(exchanges(latest)) == 1
        assert {(r.stop_id, r.trip_start_time) for r in latest.collect()} == {*((f"S{i}", "08:00:30") for i in range(3)), ("S3", "08:03:30"), ("S4", "08:03:30"), ("S5", None)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_finished_batch_of_sessions_is_not_computed_again(spark, tmp_path, monkeypatch):
    rows = spark.sql("""select 'T' as trip_id, 'A' as mode, cast(id * 7 % 5 as int) as stop_sequence, concat('S', id) as stop_id, cast(id as bigint) as delay,
        if(id = 9, null, timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id * 50 as int))) as load_timestamp from range(40)""")
    root = str(tmp_path / "log")
    sessions.add_rows(rows.where("stop_sequence <> 3"), root, ("s", 0))
    with monkeypatch.context() as m:
        m.setattr(committed, "replace_parts", lambda *a, **k: 1 / 0)
        try:
            sessions.add_rows(rows.where("stop_sequence = 3"), root, ("s", 1))
        except ZeroDivisionError:
            pass
    sessions.add_rows(rows.where("stop_sequence = 3"), root, ("s", 1))
    done = committed.current(spark, f"{root}/sessions").number
    sessions.add_rows(rows.where("stop_sequence = 3"), root, ("s", 1))
    assert committed.current(spark, f"{root}/sessions").number == done
    got = {(r.d, r["first"], r["last"], r.falls) for r in committed.read(spark, f"{root}/sessions").collect()}
    whole = prefix.sessionize_resets(rows.withColumn("d", F.to_date("load_timestamp")), ("trip_id", "mode", "d")).orderBy("load_timestamp", "stop_sequence").collect()
    want = {d: [r for r in whole if r.d == d] for d in {r.d for r in whole}}
    assert got == {(d, x[0].stop_sequence, x[-1].stop_sequence, max(r.session_id for r in x)) for d, x in want.items()} and len(got) == 3
