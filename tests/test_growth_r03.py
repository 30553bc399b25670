from pyspark.sql import functions as F

from catalogue import versioned
from catalogue.adapter import Feed
from punctualis.plans import incremental, schedule, weather
from punctualis.schemas import HOURLY_FIELDS
from punctualis.sources import committed, sinks
from punctualis.streaming import loads
from tests.test_plans import updates
from tests.test_served_days import feed


def test_latest_load_is_not_dealt_by_its_time(spark):
    staged = spark.sql("select id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 2 as int)) as load_timestamp from range(10)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = sinks.latest_not_loaded(staged, staged.where("id % 2 = 0"))
        assert "hashpartitioning(load_timestamp" not in new._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in new.collect()) == [1, 3, 5, 7, 9]
        assert sinks.latest_not_loaded(staged, staged.where("id = 1")).isEmpty()
        assert sinks.latest_not_loaded(staged, staged.limit(0)).count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_weather_join_runs_over_all_partitions(spark):
    stops = spark.sql("""select concat('S', id) as stop_id, 'name' as stop_name, 'A' as mode, timestamp_ntz'2024-01-01' as load_timestamp,
        50.0D as stop_lat, 20.0D as stop_lon from range(40)""")
    districts = spark.sql("select 'D' as district_name, 50.0D as latitude, 20.0D as longitude")
    hours = spark.sql("select 'D' as district_name, timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int)) as timestamp from range(30)")
    hours = hours.withColumns({name: F.lit(None).cast(kind) for name, kind in HOURLY_FIELDS.items()})
    met = weather.stops_weather(stops, districts, hours)
    assert met.count() == met.select("stop_id", "weather_timestamp").distinct().count() == 1200
    assert met.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_stream_source_has_a_file_per_partition(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "source")
    monkeypatch.setattr(versioned, "folder", lambda f, name: path)
    rows = spark.sql("select timestamp_ntz'2024-01-01' as load_timestamp, concat('T', id) as trip_id from range(600)")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        versioned._source(Feed(spark, "unused"), rows, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    kept = spark.read.parquet(path)
    assert len(kept.inputFiles()) == 6 and kept.exceptAll(rows).isEmpty() and kept.count() == 600


def test_state_is_computed_once_a_batch(spark, tmp_path, monkeypatch):
    src, seen, merge = str(tmp_path / "src"), [], committed.merge_latest
    monkeypatch.setattr(committed, "merge_latest", lambda source, *a, **k: (seen.append(source.inputFiles()), merge(source, *a, **k))[1])
    spark.sql("select 'k' as k, timestamp_ntz'2024-01-01 08:00:00' as ev, cast(id as int) as poll from range(3)").write.parquet(src)
    stream = spark.readStream.schema("k string, ev timestamp_ntz, poll int").parquet(src)
    loads.stream_latest_state(stream, ["k"], ["poll"], "ev", str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    assert seen and all("-batch/" in name for files in seen for name in files)
    assert [r.poll for r in committed.read(spark, str(tmp_path / "t")).collect()] == [2]


def test_new_rows_of_a_batch_are_computed_once(spark, tmp_path, monkeypatch):
    counted, build = spark.sparkContext.accumulator(0), incremental.build_delays

    def spied(*args):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        found = build(*args)
        return found.mapInArrow(count, found.schema)

    monkeypatch.setattr(incremental, "build_delays", spied)
    found = updates(spark, [("S3", 3, "2024-01-05 09:04:00", "2024-01-05 09:00:00"), ("S1", 1, "2024-01-05 23:59:00", "2024-01-05 23:00:00")])
    incremental.update_marts(found, schedule.build_trips_schedule(*feed(spark)), str(tmp_path / "marts"), ("m", 0))
    assert committed.read(spark, str(tmp_path / "marts/mart")).count() == 2 and counted.value == 2
