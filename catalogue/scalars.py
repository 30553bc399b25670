"""Column functions, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.tables_sql import sql
from punctualis.functions import geo, text, times
from punctualis.operators import stats as st
from punctualis.operators.joins import only_in, with_scalar
from punctualis.plans import features as ft
from punctualis.schemas import DISTRICTS

QUERIES: dict = {}
SQL: dict = {}


def add(name, query, text_=None):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    if text_ is not None:
        SQL[name] = sql(text_)


def times_of(feed: Feed):
    return feed.stop_times().filter(F.col("load_timestamp") == F.lit("2024-01-01").cast("timestamp_ntz")).select("trip_id", "stop_sequence", "arrival_time")


_TIMES = "(SELECT trip_id, stop_sequence, arrival_time FROM stop_times WHERE load_timestamp = TIMESTAMP '2024-01-01')"
_H = "split_part(arrival_time, ':', 1)::INTEGER"

add(
    "f1_hour_part",
    lambda f: times_of(f).select("trip_id", "stop_sequence", times.gtfs_hour("arrival_time").alias("hour")),
    f"SELECT trip_id, stop_sequence, substr(arrival_time, 1, 2)::INTEGER AS hour FROM {_TIMES}",
)
add(
    "f2_normalize_time",
    lambda f: times_of(f).select(
        "trip_id", "stop_sequence", times.normalize_time("arrival_time").alias("arrival_time"), times.is_night("arrival_time").alias("is_night"),
        times.date_text(times.shift_date(F.lit("2024-01-31").cast("date"), "arrival_time")).alias("event_date"),
        times.gtfs_seconds("arrival_time").alias("seconds"),
    ),
    f"""SELECT trip_id, stop_sequence, CASE WHEN {_H} < 24 THEN arrival_time ELSE ({_H} % 24) || substr(arrival_time, 3) END AS arrival_time,
        {_H} >= 24 AS is_night, CASE WHEN {_H} < 24 THEN '20240131' ELSE '20240201' END AS event_date,
        {_H} * 3600 + substr(arrival_time, 4, 2)::INTEGER * 60 + substr(arrival_time, 7, 2)::INTEGER AS seconds FROM {_TIMES}""",
)
add(
    "f3_normalize_time_padded",
    lambda f: times_of(f).select("trip_id", "stop_sequence", times.normalize_time("arrival_time", pad=True).alias("arrival_time")),
    f"SELECT trip_id, stop_sequence, printf('%02d', {_H} % 24) || substr(arrival_time, 3) AS arrival_time FROM {_TIMES}",
)
add(
    "f4_text_helpers",
    lambda f: times_of(f).select(
        "trip_id", "stop_sequence", F.concat("trip_id", F.lit("-"), F.lpad(F.col("stop_sequence").cast("string"), 3, "0")).alias("label"),
        F.right("arrival_time", F.lit(6)).alias("tail"), F.substring("arrival_time", 4, 2).alias("minute"),
        F.floor(times.gtfs_seconds("arrival_time") / 1800).cast("int").alias("slot"),
    ),
    f"""SELECT trip_id, stop_sequence, trip_id || '-' || lpad(stop_sequence::VARCHAR, 3, '0') AS label, right(arrival_time, 6) AS tail,
        substr(arrival_time, 4, 2) AS minute, (({_H} * 60 + substr(arrival_time, 4, 2)::INTEGER) // 30)::INTEGER AS slot FROM {_TIMES}""",
)
add(
    "f5_f6_date_text",
    lambda f: f.customer_calendar().select(
        "service_id", "load_timestamp", times.parse_date("start_date").alias("start"), times.date_text(F.date_add(times.parse_date("end_date"), 1)).alias("after_end")
    ),
    """SELECT service_id, load_timestamp, strptime(start_date, '%Y%m%d')::DATE AS start,
       strftime(strptime(end_date, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS after_end FROM customer_calendar""",
)
add(
    "f7_date_series",
    lambda f: f.customer_calendar().filter(F.col("load_timestamp") == F.lit("2024-01-01").cast("timestamp_ntz")).select(
        "service_id", F.explode(F.sequence(times.parse_date("start_date"), times.parse_date("end_date"))).alias("day")
    ),
    """SELECT 'V' || c_custkey AS service_id, DATE '2023-12-20' + c_nationkey + i::INTEGER AS day
       FROM (SELECT c_custkey, c_nationkey, unnest(range(c_custkey % 30 + 1)) AS i FROM customer)""",
)
add(
    "f8_minute_boundaries",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id", times.minutes_between("schedule_timestamp", "actual_arrival").alias("minutes"),
        times.at_least_zero(times.minutes_between("actual_arrival", "planned_arrival")).alias("early"),
    ),
    """SELECT actual_arrival, trip_id, date_diff('minute', schedule_timestamp, actual_arrival) AS minutes,
       greatest(0, date_diff('minute', actual_arrival, planned_arrival)) AS early FROM delays""",
)
add(
    "f9_elapsed_wrap",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id", times.seconds_between("planned_arrival", "actual_arrival").alias("signed_seconds"),
        times.elapsed_wrap(times.seconds_of_day("planned_arrival"), times.seconds_of_day("actual_arrival")).alias("elapsed"),
    ),
    """SELECT actual_arrival, trip_id, date_diff('second', planned_arrival, actual_arrival) AS signed_seconds,
       ((epoch(date_trunc('second', actual_arrival))::BIGINT - epoch(date_trunc('second', planned_arrival))::BIGINT + 864000) % 86400)::INTEGER AS elapsed FROM delays""",
)
add(
    "f10_date_parts",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id", F.hour("actual_arrival").alias("hour"), (F.dayofweek("actual_arrival") - 1).alias("dow"),
        F.date_trunc("day", "actual_arrival").cast("timestamp_ntz").alias("day"),
    ),
    """SELECT actual_arrival, trip_id, hour(actual_arrival)::INTEGER AS hour, dayofweek(actual_arrival)::INTEGER AS dow,
       date_trunc('day', actual_arrival)::TIMESTAMP AS day FROM delays""",
)
add(
    "f11_f12_local_time",
    lambda f: f.trip_updates().select(
        "trip_id", "stop_sequence", "load_timestamp", times.epoch_to_local(F.coalesce("arrival", "departure")).alias("local"),
        times.epoch_to_local(F.coalesce("arrival", "departure") + 15_552_000).alias("summer"),
    ),
    """SELECT trip_id, stop_sequence, load_timestamp, timezone('Europe/Warsaw', to_timestamp(ifnull(arrival, departure))) AS local,
       timezone('Europe/Warsaw', to_timestamp(ifnull(arrival, departure) + 15552000)) AS summer FROM trip_updates""",
)
add(
    "f14_null_safe_change",
    lambda f: f.delays().alias("a").withColumn("changed", ~F.struct("delay", "mode").eqNullSafe(F.struct(F.when(F.col("delay") > 0, F.col("delay")).alias("delay"), F.col("mode"))))
    .select("actual_arrival", "trip_id", "changed"),
    """SELECT actual_arrival, trip_id, delay IS DISTINCT FROM (CASE WHEN delay > 0 THEN delay END) AS changed FROM delays""",
)
add(
    "f15_f16_haversine",
    lambda f: f.stops().select(
        "stop_id", "mode", "load_timestamp", F.round(geo.haversine_km("stop_lat", "stop_lon", 50.061389, 19.937222), 6).alias("km"),
        F.round(geo.haversine_m("stop_lat", "stop_lon", 50.061389, 19.937222), 3).alias("m"),
    ),
    """SELECT stop_id, mode, load_timestamp, round(6371 * c, 6) AS km, round(6371008.8::DOUBLE * c, 3) AS m FROM
       (SELECT *, 2 * asin(sqrt(pow(sin(radians(50.061389::DOUBLE - stop_lat) / 2), 2)
               + cos(radians(stop_lat)) * cos(radians(50.061389::DOUBLE)) * pow(sin(radians(19.937222::DOUBLE - stop_lon) / 2), 2))) AS c FROM stops)""",
)
add(
    "f17_day_cycle",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id",
        *[(F.round(c, 6) if n != "seconds_since_midnight" else c).alias(n) for n, c in times.day_cycle("actual_arrival").items()],
    ).withColumn("time_cos", F.col("time_cos") + 0.0),
    """SELECT actual_arrival, trip_id, s::INTEGER AS seconds_since_midnight, round(2 * pi() * s / 86400, 6) AS theta,
       round(sin(2 * pi() * s / 86400), 6) + 0.0::DOUBLE AS time_sin, round(cos(2 * pi() * s / 86400), 6) + 0.0::DOUBLE AS time_cos
       FROM (SELECT *, epoch(date_trunc('second', actual_arrival))::BIGINT % 86400 AS s FROM delays)""",
)
add(
    "f18_weekday",
    lambda f: f.delays().select("actual_arrival", "trip_id", times.weekday_name("actual_arrival").alias("weekday"), times.weekday_number("actual_arrival").alias("no")),
    "SELECT actual_arrival, trip_id, dayname(actual_arrival) AS weekday, (isodow(actual_arrival) - 1)::INTEGER AS no FROM delays",
)
add(
    "f19_round_half_hour",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id", times.round_half_hour("actual_arrival").alias("slot"),
        times.round_half_hour(F.date_trunc("hour", "actual_arrival").cast("timestamp_ntz") + F.expr("interval 15 minutes")).alias("tie_even"),
        times.round_half_hour(F.date_trunc("hour", "actual_arrival").cast("timestamp_ntz") + F.expr("interval 45 minutes")).alias("tie_odd"),
    ),
    """SELECT actual_arrival, trip_id, strftime(time_bucket(INTERVAL 30 MINUTE, actual_arrival + INTERVAL 15 MINUTE), '%H:%M') AS slot,
       strftime(date_trunc('hour', actual_arrival), '%H:00') AS tie_even,
       strftime(date_trunc('hour', actual_arrival) + INTERVAL 1 HOUR, '%H:00') AS tie_odd FROM delays""",
)
_NAMED = "(SELECT s_suppkey, district_name AS name, district_number AS num FROM supplier JOIN districts ON district_number = s_suppkey % 18 + 1)"


def named(feed: Feed):
    return feed.raw("supplier").select("s_suppkey", feed._district_of(F.col("s_suppkey")).alias("name"))


add(
    "f20_slug",
    lambda f: named(f).select("s_suppkey", text.slug("name").alias("slug")),
    f"SELECT s_suppkey, replace(split_part(name, ' (', 1), ' ', '_') AS slug FROM {_NAMED}",
)
_PLAIN = "name"
for _a, _b in zip(text.ACCENTED, text.PLAIN):
    _PLAIN = f"replace({_PLAIN}, '{_a}', '{_b}')"
add("f21_strip_diacritics", lambda f: named(f).select("s_suppkey", text.strip_diacritics("name").alias("plain")), f"SELECT s_suppkey, {_PLAIN} AS plain FROM {_NAMED}")
add("f21_strip_diacritics_nfkd", lambda f: named(f).select("s_suppkey", text.strip_diacritics_nfkd("name").alias("plain")), f"SELECT s_suppkey, {_PLAIN} AS plain FROM {_NAMED}")
add(
    "f22_roman_number",
    lambda f: named(f).select(
        "s_suppkey", text.roman_in_parens("name").alias("num"), text.roman_in_parens(F.regexp_replace("name", r"[()]", "")).alias("none")
    ),
    f"SELECT s_suppkey, num, NULL::INTEGER AS none FROM {_NAMED}",
)
add(
    "f23_trip_key",
    lambda f: f.delays().select(
        "actual_arrival", text.trip_key(F.col("trip_id"), F.when(F.col("mode") != "view", F.col("trip_headsign")), times.parse_date("event_date"), F.col("mode")).alias("trip_key")
    ),
    """SELECT actual_arrival, trip_id || '_' || CASE WHEN mode = 'view' THEN 'nan' ELSE trip_headsign END || '_' || actual_arrival::DATE || '_' || mode AS trip_key FROM delays""",
)
add(
    "f24_safe_casts",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id", F.col("trip_id").try_cast("bigint").alias("bad"), F.substring("trip_id", 2, 10).try_cast("bigint").alias("number"),
        F.col("actual_arrival").cast("date").alias("day"), F.to_timestamp(F.concat("event_date", F.lit(" 9:05:00")), "yyyyMMdd H:mm:ss").cast("timestamp_ntz").alias("nine"),
    ),
    """SELECT actual_arrival, trip_id, TRY_CAST(trip_id AS BIGINT) AS bad, TRY_CAST(substr(trip_id, 2) AS BIGINT) AS number, actual_arrival::DATE AS day,
       (date_trunc('day', actual_arrival) + INTERVAL 545 MINUTE)::TIMESTAMP AS nine FROM delays""",
)
add(
    "f25_round6",
    lambda f: f.stops().select("stop_id", "mode", "load_timestamp", F.round(F.col("stop_lat") * F.col("stop_lon") / 7, 6).alias("r")),
    "SELECT stop_id, mode, load_timestamp, round(stop_lat * stop_lon / 7, 6) AS r FROM stops",
)
add(
    "f26_json_fields",
    lambda f: f.raw("events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.to_json(F.struct(F.col("user_id").alias("u"), F.col("event_type").alias("t"))).alias("doc"),
    ),
    """SELECT event_id, (props->>'$.k')::INTEGER AS k, '{"u":' || user_id || ',"t":"' || event_type || '"}' AS doc FROM events""",
)
add(
    "f27_null_logic",
    lambda f: f.delays().filter((F.col("delay") > 5) | (F.col("delay").isNull() & (F.col("mode") != "view"))).groupBy("mode").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT mode, count(*) AS cnt FROM delays WHERE delay > 5 OR (delay IS NULL AND mode <> 'view') GROUP BY mode",
)

# projections and filters
add(
    "pf1_projection",
    lambda f: f.hourly_weather().select("district_name", F.col("timestamp").alias("weather_timestamp"), "temperature_2m"),
    "SELECT district_name, timestamp AS weather_timestamp, temperature_2m FROM hourly_weather",
)
add("pf2_not_null", lambda f: f.stops().filter(F.col("stop_name").isNotNull()).select("stop_id", "mode", "load_timestamp"), "SELECT stop_id, mode, load_timestamp FROM stops WHERE stop_name IS NOT NULL")
add(
    "pf3_mode_filter",
    lambda f: f.delays().filter(F.when(F.col("delay") > 0, F.col("mode")) != "click").select("actual_arrival", "mode"),
    "SELECT actual_arrival, mode FROM delays WHERE delay > 0 AND mode <> 'click'",
)
add(
    "pf5_between_loads",
    lambda f: ft.between_loads(f.delays(), "2024-01-05", "2024-01-10").groupBy("mode").agg(F.count(F.lit(1)).alias("cnt"), F.max("load_timestamp").alias("last")),
    "SELECT mode, count(*) AS cnt, max(load_timestamp) AS last FROM delays WHERE load_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-10' GROUP BY mode",
)
add(
    "pf9_trim_quantiles",
    lambda f: st.trim_quantiles(f.delays(), "delay", 0.01, 0.99).select("actual_arrival", "trip_id", "delay"),
    "SELECT actual_arrival, trip_id, delay FROM delays WHERE delay BETWEEN (SELECT quantile_cont(delay, 0.01) FROM delays) AND (SELECT quantile_cont(delay, 0.99) FROM delays)",
)
add(
    "pf10_top_routes_semi",
    lambda f: only_in(f.delays(), st.rank_groups(f.delays(), "route_short_name", "max", 5), ["route_short_name"]).select("actual_arrival", "route_short_name", "delay"),
    """SELECT actual_arrival, route_short_name, delay FROM delays WHERE route_short_name IN
       (SELECT route_short_name FROM delays GROUP BY 1 ORDER BY max(delay) DESC, 1 LIMIT 5)""",
)
add(
    "pf11_drop_nulls",
    lambda f: f.stops().dropna(subset=["stop_desc"]).drop("stop_code", "stop_lat", "stop_lon"),
    "SELECT stop_id, stop_name, stop_desc, mode, load_timestamp FROM stops WHERE stop_desc IS NOT NULL",
)


def supplier_districts(feed: Feed):
    """Suppliers as places, so the work grows with the data."""
    s = feed.stops().filter((F.col("mode") == "A") & (F.col("load_timestamp") == F.lit("2024-01-01").cast("timestamp_ntz")))
    number = F.substring("stop_id", 2, 12).cast("int") + 1
    return s.select(number.alias("district_number"), F.col("stop_id").alias("district_name"), F.col("stop_lat").alias("latitude"), F.col("stop_lon").alias("longitude"))


_PLACES = """(SELECT substr(stop_id, 2)::INTEGER + 1 AS district_number, stop_id AS district_name, stop_lat AS latitude, stop_lon AS longitude
              FROM stops WHERE mode = 'A' AND load_timestamp = TIMESTAMP '2024-01-01')"""
_CASES = " UNION ALL ".join(
    f"SELECT *, '{role}' AS role FROM {_PLACES} WHERE {test}"
    for role, test in (
        ("west", f"longitude = (SELECT min(longitude) FROM {_PLACES})"),
        ("east", f"longitude = (SELECT max(longitude) FROM {_PLACES})"),
        ("south", f"latitude = (SELECT min(latitude) FROM {_PLACES})"),
        ("north", f"latitude = (SELECT max(latitude) FROM {_PLACES})"),
        ("centre", "district_number = 1"),
    )
)
add("pf12_reference_districts", lambda f: st.reference_districts(supplier_districts(f)), _CASES)
QUERIES["u5_concat_extreme_rows"], SQL["u5_concat_extreme_rows"] = QUERIES["pf12_reference_districts"], SQL["pf12_reference_districts"]
add(
    "pf13_conditionals",
    lambda f: f.delays().select(
        "actual_arrival", "trip_id",
        F.when(F.col("delay").isNull(), "unknown").when(F.col("delay") > 2, "late").when(F.col("delay") >= -1, "on time").otherwise("early").alias("state"),
        F.coalesce("delay", F.lit(0)).alias("delay0"),
    ),
    """SELECT actual_arrival, trip_id, CASE WHEN delay > 2 THEN 'late' WHEN delay >= -1 THEN 'on time' WHEN delay < -1 THEN 'early' ELSE 'unknown' END AS state,
       ifnull(delay, 0) AS delay0 FROM delays""",
)
add(
    "pf14_scalar_subquery",
    lambda f: with_scalar(f.delays(), f.delays().agg(F.max("event_date").alias("last"))).filter(F.col("event_date") == F.col("last")).select("actual_arrival", "trip_id", "delay"),
    "SELECT actual_arrival, trip_id, delay FROM delays WHERE event_date = (SELECT max(event_date) FROM delays)",
)
add(
    "src8_inline_relation",
    lambda f: f.raw("events").withColumn("district_number", (F.col("user_id") % 18 + 1).cast("int")).join(f.districts(), "district_number")
    .groupBy("district_name", "latitude", "longitude").agg(F.count(F.lit(1)).alias("cnt")),
    """SELECT district_name, latitude, longitude, count(*) AS cnt FROM events JOIN districts ON district_number = user_id % 18 + 1 GROUP BY ALL""",
)
QUERIES["u4_union_literals"], SQL["u4_union_literals"] = QUERIES["src8_inline_relation"], SQL["src8_inline_relation"]
