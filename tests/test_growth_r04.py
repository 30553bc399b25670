from pyspark.sql import functions as F

from punctualis.operators import dedup, prefix
from punctualis.plans import delays, features, schedule
from tests.test_plans import updates
from tests.test_served_days import feed


def counted(df, seen):
    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_sessions_compute_their_input_once(spark):
    rows = spark.sql("""select concat('T', id % 3) as trip_id, 'A' as mode, cast(id * 7 % 5 as int) as stop_sequence, concat('S', id) as stop_id,
        timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id * 10 as int)) as load_timestamp from range(60)""")
    seen = spark.sparkContext.accumulator(0)
    got = prefix.sessionize_resets(counted(rows, seen)).collect()
    assert len(got) == 60 and seen.value == 60
    for trip in ("T0", "T1", "T2"):
        mine = sorted((r for r in got if r.trip_id == trip), key=lambda r: r.load_timestamp)
        falls = [int(i > 0 and r.stop_sequence < mine[i - 1].stop_sequence) for i, r in enumerate(mine)]
        assert [r.change_indicator for r in mine] == falls and [r.session_id for r in mine] == [sum(falls[: i + 1]) for i in range(len(mine))]


def test_sessions_keep_columns_without_an_order_and_null_keys(spark):
    rows = spark.sql("""select cast(null as string) as trip_id, 'A' as mode, cast(2 - id as int) as stop_sequence, map('k', id) as extra,
        timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int)) as load_timestamp from range(2)""")
    got = prefix.sessionize_resets(rows).orderBy("load_timestamp").collect()
    assert [(r.extra, r.change_indicator, r.session_id) for r in got] == [({"k": 0}, 0, 0), ({"k": 1}, 1, 1)]
    assert prefix.sessionize_resets(rows).columns == [*rows.columns, "change_indicator", "session_id"]


def test_a_planned_row_is_not_dealt_again_for_each_date(spark):
    plan = schedule.build_trips_schedule(*feed(spark))
    found = updates(spark, [("S3", 3, "2024-01-05 09:04:00", "2024-01-05 09:00:00")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = delays.build_delays(found, plan)
        text = plan_of(mart)
        assert mart.count() == 1
        assert "hashpartitioning(trip_id" in text and not [x for x in text.splitlines() if "hashpartitioning(trip_id" in x and "planned_day" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_starts_and_newest_stop_times_share_their_deal(spark):
    times = spark.sql("""select concat('T', id div 3) as trip_id, concat('A', id div 3) as mode, concat('S', id) as stop_id, cast(id as int) as stop_sequence, '08:00:00' as arrival_time,
        concat('08:0', id, ':30') as departure_time, 1.0D as shape_dist_traveled, timestamp_ntz'2024-01-01' as load_timestamp from range(3)""")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = features.latest_stop_times(times)
        text = plan_of(latest)
        assert {(r.stop_id, r.trip_start_time) for r in latest.collect()} == {(f"S{i}", "08:00:30") for i in range(3)}
        dealt = [x for x in text.splitlines() if "hashpartitioning(" in x]
        assert dealt and all("hashpartitioning(trip_id" in x and "arrival_time" not in x.split("hashpartitioning(")[1].split(")")[0] for x in dealt)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_samples_are_cut_before_the_shuffle(spark):
    rows = spark.range(0, 8000, 1, 4).select("id", (F.col("id") % 2).alias("g"))
    sample = dedup.sample_per_group(rows, F.col("g"), 1500, ["id"], seed=3)
    assert "WindowGroupLimit" in plan_of(sample)
    want = {r.id for g in (0, 1) for r in rows.where(F.col("g") == g).orderBy(dedup.shuffle_rank(["id"], 3)).limit(1500).collect()}
    assert {r.id for r in sample.collect()} == want
