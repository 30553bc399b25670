from pyspark.sql import functions as F

from punctualis.plans import delays, schedule
from tests.test_plans import V1, updates

V2 = "timestamp_ntz'2024-01-15'"


def feed(spark):
    both = f"(select * from values ({V1}), ({V2}) v(load_timestamp)) v"
    times = spark.sql(f"""select 'T' as trip_id, 'A' as mode, stop_id, seq as stop_sequence, at as arrival_time, 1.0D as shape_dist_traveled, load_timestamp
        from values ('S1', 1, '23:58:00'), ('S2', 2, '24:03:00'), ('S3', 3, '09:00:00') t(stop_id, seq, at), {both}""")
    trips = spark.sql(f"select 'T' as trip_id, 'R' as route_id, 'V' as service_id, 'head' as trip_headsign, 'A' as mode, load_timestamp from {both}")
    stops = spark.sql(f"select stop_id, 'name' as stop_name, 50D as stop_lat, 20D as stop_lon, 'A' as mode, load_timestamp from values ('S1'), ('S2'), ('S3') s(stop_id), {both}")
    routes = spark.sql("select 'R' as route_id, 'A' as mode, 'L' as route_short_name, timestamp_ntz'1900-01-01' as valid_from, cast(null as timestamp_ntz) as valid_to")
    days = spark.sql(f"""select date_format(day, 'yyyyMMdd') as event_date, 'V' as service_id, 'A' as mode, if(day < '2024-01-15', {V1}, {V2}) as load_timestamp
        from (select explode(sequence(date'2024-01-01', date'2024-01-21')) as day)""")
    return times, trips, stops, routes, days


def test_only_dates_that_updates_reach_are_planned(spark):
    found = updates(spark, [
        ("S1", 1, "2024-01-05 00:01:00", "2024-01-05 00:00:00"),  # planned 23:58 of the 4th
        ("S2", 2, "2024-01-05 00:05:00", "2024-01-05 00:00:00"),  # planned 24:03 of the service of the 4th
        ("S3", 3, "2024-01-05 09:04:00", "2024-01-05 09:00:00"),
        ("S3", 3, None, "2024-01-05 09:00:00"),
    ])
    reached = delays.planned_days(found)
    assert sorted(str(r.planned_day) for r in reached.collect()) == ["2024-01-04", "2024-01-05"]
    whole, cut = schedule.build_trips_schedule(*feed(spark)), schedule.build_trips_schedule(*feed(spark), planned_days=reached)
    assert whole.count() == 63
    wanted = whole.where(F.col("event_date").isin("20240104", "20240105"))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, wanted.collect())) and cut.count() == 6
    of = [sorted(map(tuple, delays.build_delays(found, plan).collect()), key=str) for plan in (whole, cut)]
    assert of[0] == of[1] and len(of[0]) == 3
    assert schedule.build_trips_schedule(*feed(spark), planned_days=reached.limit(0)).count() == 0
