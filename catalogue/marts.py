"""Calendar, schedule, delay, vector, vehicle, weather and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.tables_sql import sql
from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import join_scd2, only_in
from punctualis.operators.prefix import sessionize_resets
from punctualis.plans import calendar as cal
from punctualis.plans import delays as dl
from punctualis.plans import report as rp
from punctualis.plans import schedule as sch
from punctualis.plans import vehicles as vh
from punctualis.plans import weather as wx

QUERIES: dict = {}
SQL: dict = {}


def add(name, query, text=None):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    if text is not None:
        SQL[name] = sql(text)


def top_delayed_routes(feed: Feed):
    """Flagship: mean delay per route over the whole chain, ten worst."""
    by_route = feed.delay_mart().groupBy("route_short_name").agg(F.round(F.avg("delay"), 6).alias("avg_delay"), F.count(F.lit(1)).alias("cnt"))
    return by_route.orderBy(F.col("avg_delay").desc(), "route_short_name").limit(10)


add(
    "flagship_top_delayed_routes",
    top_delayed_routes,
    "SELECT route_short_name, round(avg(delay), 6) AS avg_delay, count(*) AS cnt FROM delay_mart GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)

_WIDE = """
    SELECT strftime(day, '%Y%m%d') AS event_date, c.service_id, c.mode, c.load_timestamp
    FROM customer_calendar c
    JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-03-31', INTERVAL 1 DAY)) AS DATE) AS day) g
      ON day BETWEEN strptime(c.start_date, '%Y%m%d')::DATE AND strptime(c.end_date, '%Y%m%d')::DATE
    LEFT JOIN customer_exceptions x ON x.service_id = c.service_id AND x.mode = c.mode AND x.load_timestamp = c.load_timestamp
                                   AND x.date = strftime(day, '%Y%m%d')"""
_RUNS = """
    WHERE x.exception_type = 1 OR (x.exception_type IS DISTINCT FROM 2
          AND CASE dayofweek(day) WHEN 0 THEN sunday WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday
                                  WHEN 4 THEN thursday WHEN 5 THEN friday ELSE saturday END = 1)"""

add("m1_expand_calendar", lambda f: cal.expand_calendar(f.customer_calendar(), f.customer_exceptions()), _WIDE + _RUNS)
add("m1_expand_calendar_feed", lambda f: f.expanded_calendar(), "SELECT * FROM expanded_calendar")
add(
    "j4_service_day_range",
    lambda f: cal.service_days(f.customer_calendar()).select("day", "service_id", "mode", "load_timestamp"),
    _WIDE.split("LEFT JOIN")[0].replace("strftime(day, '%Y%m%d') AS event_date", "day"),
)
add(
    "j5_calendar_exceptions",
    lambda f: cal.with_exceptions(cal.service_days(f.customer_calendar()), f.customer_exceptions()).select(
        "day", "service_id", "mode", "load_timestamp", "exception_type"
    ),
    _WIDE.replace("strftime(day, '%Y%m%d') AS event_date", "day, x.exception_type"),
)
add(
    "pf6_weekday_predicate",
    lambda f: cal.with_exceptions(cal.service_days(f.customer_calendar()), f.customer_exceptions())
    .withColumn("runs", F.coalesce(cal.service_runs_on(F.col("day"), F.col("exception_type")), F.lit(False)))
    .groupBy("day", "runs")
    .agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT day, runs, count(*) AS cnt FROM ("
    + _WIDE.replace(
        "strftime(day, '%Y%m%d') AS event_date",
        "day, (" + _RUNS.replace("WHERE", "").strip() + ") IS TRUE AS runs",
    )
    + ") GROUP BY ALL",
)
add("w3_latest_calendar", lambda f: cal.latest_calendar(f.expanded_calendar(), f.stop_times()), "SELECT * FROM picked_calendar")
add(
    "w3_latest_calendar_all_services",
    lambda f: cal.latest_calendar(f.expanded_calendar(), f.stop_times(), all_services=True),
    "SELECT * FROM picked_all",
)
add(
    "j13_loaded_versions_semi",
    lambda f: only_in(f.trips(), f.stop_times().filter("stop_sequence = 2").select("load_timestamp", "trip_id").distinct(), ["load_timestamp", "trip_id"]),
    "SELECT * FROM trips WHERE (load_timestamp, trip_id) IN (SELECT (load_timestamp, trip_id) FROM stop_times WHERE stop_sequence = 2)",
)
add(
    "j2_scd2_route_version",
    lambda f: join_scd2(f.trips(), f.routes_scd2(), ["route_id", "mode"], "load_timestamp").select(
        "trip_id", "mode", "load_timestamp", "route_short_name", "valid_from", "valid_to"
    ),
    """SELECT t.trip_id, t.mode, t.load_timestamp, route_short_name, valid_from, valid_to FROM trips t JOIN routes_scd2 r
       ON r.route_id = t.route_id AND r.mode = t.mode AND t.load_timestamp >= valid_from
       AND (valid_to IS NULL OR valid_to > t.load_timestamp)""",
)
add(
    "j1_version_matched_join",
    lambda f: f.stop_times()
    .join(f.trips(), ["trip_id", "mode", "load_timestamp"])
    .join(f.stops(), ["stop_id", "mode", "load_timestamp"])
    .select("trip_id", "mode", "load_timestamp", "stop_id", "stop_sequence", "service_id", "stop_name", "stop_lat", "stop_lon"),
    """SELECT trip_id, mode, load_timestamp, stop_id, stop_sequence, service_id, stop_name, stop_lat, stop_lon
       FROM stop_times JOIN trips USING (trip_id, mode, load_timestamp) JOIN stops USING (stop_id, mode, load_timestamp)""",
)
add(
    "j3_trip_service_days",
    lambda f: sch.trip_days(f.trips(), f.routes_scd2(), cal.latest_calendar(f.expanded_calendar(), f.stop_times())).select(
        "trip_id", "mode", "load_timestamp", "route_short_name", F.explode("days").alias("event_date")
    ),
    """SELECT t.trip_id, t.mode, t.load_timestamp, r.route_short_name, c.event_date FROM trips t
       JOIN picked_calendar c ON c.service_id = t.service_id AND c.mode = t.mode AND c.load_timestamp = t.load_timestamp
       JOIN routes_scd2 r ON r.route_id = t.route_id AND r.mode = t.mode AND t.load_timestamp BETWEEN r.valid_from
                          AND coalesce(r.valid_to - INTERVAL 1 MICROSECOND, TIMESTAMP '9999-01-01')""",
)
add("m2_trips_schedule", lambda f: f.schedule(), "SELECT * FROM schedule")
add("m2_trips_schedule_all_services", lambda f: f.schedule(all_services=True), "SELECT * FROM schedule_all")
add(
    "w2_latest_schedule_row",
    lambda f: latest_per_key(
        f.schedule(), ["trip_id", "stop_id", "mode", "event_date"],
        [F.col("load_timestamp").desc(), F.col("stop_sequence"), F.col("arrival_time"), F.col("is_night_trip")],
    ).select("trip_id", "stop_id", "mode", "event_date", "stop_sequence", "arrival_time", "load_timestamp"),
    """SELECT trip_id, stop_id, mode, event_date, stop_sequence, arrival_time, load_timestamp FROM schedule
       QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, mode, event_date
                                  ORDER BY load_timestamp DESC, stop_sequence, arrival_time, is_night_trip) = 1""",
)
add(
    "w1_latest_update",
    lambda f: dl.latest_updates(f.trip_updates()),
    "SELECT trip_id, mode, stop_id, stop_sequence, load_timestamp, actual AS actual_arrival, actual::DATE AS actual_day FROM updates",
)
add(
    "j6_midnight_match",
    lambda f: dl._matched(f.trip_updates(), f.served_schedule()).select(
        "trip_id", "mode", "stop_id", "event_date", "arrival_time", "planned_arrival", "actual_arrival", "update_timestamp"
    ),
    """SELECT trip_id, mode, stop_id, event_date, arrival_time, planned AS planned_arrival, actual AS actual_arrival, update_timestamp FROM matched""",
)


def delay_sessions(feed: Feed):
    return sessionize_resets(feed.delay_mart().select("event_date", *rp.REPORT_COLUMNS))


add("m3_delays", lambda f: f.delay_mart(), "SELECT * FROM delay_mart")
add("m4_delay_vectors", lambda f: f.vectors(), "SELECT * FROM vectors")
add(
    "m4_delay_vectors_text_hour",
    lambda f: f.vectors(strict_text_hour=True),
    "SELECT * FROM vectors",
)
SQL["m4_delay_vectors_text_hour"] = SQL["m4_delay_vectors"].replace(
    "hour(u.actual) = 23 AND plan_hour = 0", "hour(u.actual) = 23 AND arrival_time LIKE '00:%'"
)
add(
    "w6_next_stop_lead",
    lambda f: f.vectors().groupBy("mode", "event_date", "start_stop_sequence", "end_stop_sequence").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT mode, event_date, start_stop_sequence, end_stop_sequence, count(*) AS cnt FROM vectors GROUP BY ALL",
)
add(
    "w7_vectors_per_run",
    lambda f: f.vectors().groupBy("trip_id", "mode", "event_date").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT trip_id, mode, event_date, count(*) - 1 AS cnt FROM matched GROUP BY ALL HAVING count(*) > 1",
)
add(
    "j7_served_stops_inner",
    lambda f: dl._matched(f.trip_updates(), f.served_schedule()).groupBy("trip_id", "mode", "event_date").agg(F.count("actual_arrival").alias("served")),
    "SELECT trip_id, mode, event_date, count(actual) AS served FROM matched GROUP BY ALL",
)
add(
    "f13_vector_id",
    lambda f: f.vectors().select("trip_id", "event_date", "start_stop_sequence", "vector_unique_id"),
    "SELECT trip_id, event_date, start_stop_sequence, vector_unique_id FROM vectors",
)
add(
    "j8_vehicle_vector",
    lambda f: vh.on_vector(f.vehicle_positions(), f.vectors()).select(
        "id", "trip_id", "mode", "load_timestamp", "current_status", "current_stop_sequence", "vector_unique_id"
    ),
    "SELECT id, trip_id, mode, load_timestamp, current_status, current_stop_sequence, vector_unique_id FROM tagged_vehicles",
)
_VEHICLE = """SELECT id AS vehicle_id, latitude, longitude, bearing, speed, current_status, current_stop_sequence, load_timestamp, trip_id, vector_unique_id
       FROM tagged_vehicles QUALIFY row_number() OVER (PARTITION BY trip_id, load_timestamp
       ORDER BY id, current_stop_sequence, vector_unique_id, latitude, longitude) = 1"""
add("m5_vehicle_positions", lambda f: vh.match_vehicles(f.vehicle_positions(), f.vectors()), _VEHICLE)
add(
    "m5_vehicle_positions_local_date",
    lambda f: vh.match_vehicles(f.vehicle_positions(), f.vectors(), local_date=True),
    _VEHICLE,
)
SQL["m5_vehicle_positions_local_date"] = SQL["m5_vehicle_positions"].replace(
    "strftime(p.load_timestamp, '%Y%m%d')", "strftime(timezone('Europe/Warsaw', timezone('UTC', p.load_timestamp)), '%Y%m%d')"
)
add(
    "w4_first_vehicle",
    lambda f: latest_per_key(
        f.vehicle_positions(), ["trip_id", "load_timestamp"], [F.col(c) for c in ("id", "current_stop_sequence", "latitude", "longitude")]
    ).select("trip_id", "load_timestamp", "id", "current_stop_sequence"),
    """SELECT trip_id, load_timestamp, id, current_stop_sequence FROM vehicle_positions
       QUALIFY row_number() OVER (PARTITION BY trip_id, load_timestamp ORDER BY id, current_stop_sequence, latitude, longitude) = 1""",
)
add(
    "pf4_moving_vehicles",
    lambda f: f.vehicle_positions().filter(F.col("current_status").isin(1, 2)).groupBy("current_status", "mode").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT current_status, mode, count(*) AS cnt FROM vehicle_positions WHERE current_status IN (1, 2) GROUP BY ALL",
)
add(
    "j9_w5_nearest_district",
    lambda f: wx.assign_districts(f.stops(), f.districts()).select("stop_id", "stop_name", "district_name", F.round("distance_m", 3).alias("distance_m")),
    "SELECT stop_id, stop_name, district_name, round(2 * 6371008.8::DOUBLE * d, 3) AS distance_m FROM nearest_district",
)
add(
    "w5_nearest_by_tree",
    lambda f: wx.assign_districts(f.stops(), f.districts(), leaf_centres=2).select("stop_id", "stop_name", "district_name", F.round("distance_m", 3).alias("distance_m")),
    "SELECT stop_id, stop_name, district_name, round(2 * 6371008.8::DOUBLE * d, 3) AS distance_m FROM nearest_district",
)
_WX = """SELECT stop_id, stop_name, n.district_name, h.timestamp AS weather_timestamp, temperature_2m, wind_speed_10m, relative_humidity_2m,
       precipitation, weather_code, pressure_msl, cloud_cover, visibility, is_day FROM nearest_district n JOIN hourly_weather h USING (district_name)"""
add("m6_stops_weather", lambda f: wx.stops_weather(f.stops(), f.districts(), f.hourly_weather()), _WX)
add(
    "j10_weather_fanout",
    lambda f: wx.stops_weather(f.stops(), f.districts(), f.hourly_weather()).groupBy("district_name", "weather_timestamp").agg(
        F.countDistinct("stop_id").alias("stops"), F.max("temperature_2m").alias("temperature_2m")
    ),
    f"SELECT district_name, weather_timestamp, count(DISTINCT stop_id) AS stops, max(temperature_2m) AS temperature_2m FROM ({_WX}) GROUP BY ALL",
)
add(
    "w8_reset_flag",
    lambda f: delay_sessions(f).select("trip_id", "mode", "load_timestamp", "stop_sequence", "stop_id", "event_date", "change_indicator"),
    "SELECT trip_id, mode, load_timestamp, stop_sequence, stop_id, event_date, change_indicator FROM flagged",
)
add(
    "w9_session_id",
    lambda f: delay_sessions(f).select("trip_id", "mode", "load_timestamp", "stop_sequence", "stop_id", "event_date", "session_id"),
    "SELECT trip_id, mode, load_timestamp, stop_sequence, stop_id, event_date, session_id FROM sessions",
)
add(
    "w9_session_id_events",
    lambda f: sessionize_resets(f.delays().select("trip_id", "mode", "load_timestamp", "stop_sequence")).select("trip_id", "mode", "load_timestamp", "stop_sequence", "change_indicator", "session_id"),
    """SELECT trip_id, mode, load_timestamp, stop_sequence, c AS change_indicator,
              sum(c) OVER (PARTITION BY trip_id, mode ORDER BY load_timestamp, stop_sequence ROWS UNBOUNDED PRECEDING)::BIGINT AS session_id
       FROM (SELECT *, CASE WHEN stop_sequence < lag(stop_sequence) OVER (PARTITION BY trip_id, mode ORDER BY load_timestamp, stop_sequence)
                            THEN 1 ELSE 0 END AS c FROM delays)""",
)
add(
    "w10_latest_in_session",
    lambda f: rp.latest_in_session(delay_sessions(f)).select("trip_id", "session_id", "stop_sequence", "mode", "stop_id", "delay", "load_timestamp"),
    "SELECT trip_id, session_id, stop_sequence, mode, stop_id, delay, load_timestamp FROM session_latest",
)
add(
    "w11_consecutive_pairs",
    lambda f: rp.stop_pairs(rp.latest_in_session(delay_sessions(f))).select("trip_id", "session_id", "mode", "stop_sequence", "stop_id", "next_stop_id", "delay"),
    "SELECT trip_id, session_id, mode, stop_sequence, stop_id, next_stop_id, delay FROM session_pairs",
)
add(
    "a1_pair_averages",
    lambda f: rp.pair_averages(rp.stop_pairs(rp.latest_in_session(delay_sessions(f)))).withColumn("avg_delay", F.round("avg_delay", 6)),
    "SELECT cnt, round(avg_delay, 6) AS avg_delay, stop_id, next_stop_id, delay_hour, delay_date FROM pair_averages",
)


def stop_days(feed: Feed):
    """Stop versions of the served days, since the report wants the stop of the load day."""
    day = F.explode(F.array(*[F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-06")]))
    return feed.stops().filter(F.col("mode") == "A").drop("load_timestamp").distinct().select("*", day.alias("load_timestamp"))


def _report(feed: Feed, fix_next: bool):
    out = rp.segment_report(feed.delay_mart(), stop_days(feed), "2024-01-05", "2024-01-06", fix_next)
    return out.withColumn("avg_delay", F.round("avg_delay", 6))


def report_sql(other: str) -> str:
    return f"""SELECT cnt, round(avg_delay, 6) AS avg_delay, a.stop_id, b.stop_lat, b.stop_lon, a.next_stop_id,
               c.stop_lat AS next_stop_lat, c.stop_lon AS next_stop_lon, delay_hour, delay_date
        FROM pair_averages a
        LEFT JOIN (SELECT DISTINCT stop_id, stop_lat, stop_lon FROM stops WHERE mode = 'A') b ON b.stop_id = a.stop_id
        LEFT JOIN (SELECT DISTINCT stop_id, stop_lat, stop_lon FROM stops WHERE mode = 'A') c ON c.stop_id = {other}
        WHERE delay_date IN (DATE '2024-01-05', DATE '2024-01-06') ORDER BY a.stop_id DESC, delay_hour"""


add("m7_segment_report", lambda f: _report(f, True), report_sql("a.next_stop_id"))
add("j12_segment_report_same_stop", lambda f: _report(f, False), report_sql("a.stop_id"))
