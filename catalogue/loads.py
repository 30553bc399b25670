"""Feature tables, versioned loads, exports and nested inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.tables_sql import sql
from punctualis.operators import scd2
from punctualis.operators import stats as st
from punctualis.functions import text
from punctualis.plans import features as ft
from punctualis.schemas import HOURLY_FIELDS, MIN15_FIELDS
from punctualis.sources import json_feeds as jf
from punctualis.sources import realtime as rt
from punctualis.sources import sinks as sk
from punctualis.sources import tables as tb

QUERIES: dict = {}
SQL: dict = {}


def add(name, query, text_=None):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    if text_ is not None:
        SQL[name] = sql(text_)


# features

_DIST = {
    "Bienczyce": (50.108333, 20.081389), "Nowa_Huta": (50.085556, 20.190556), "Pradnik_Biały": (50.085278, 19.884444),
    "Stare_Miasto": (50.061389, 19.937222), "Swoszowice": (49.972778, 19.937778),
}
_KM = """2 * 6371::DOUBLE * asin(sqrt(pow(sin(radians({lat}::DOUBLE - stop_lat) / 2), 2)
         + cos(radians(stop_lat)) * cos(radians({lat}::DOUBLE)) * pow(sin(radians({lon}::DOUBLE - stop_lon) / 2), 2)))"""
_STARTS = "(SELECT trip_id, mode, arg_min(departure_time, stop_sequence) AS start FROM stop_times WHERE load_timestamp = TIMESTAMP '2024-01-15' GROUP BY 1, 2)"
_CONTENT = """(SELECT * FROM stop_times QUALIFY row_number() OVER (PARTITION BY trip_id, arrival_time, departure_time, stop_id, shape_dist_traveled, mode
               ORDER BY load_timestamp DESC, stop_sequence) = 1)"""
_BASE = f"""
    SELECT d.trip_id, trip_headsign, route_short_name, d.mode, d.stop_id, d.stop_name, stop_code, stop_desc, stop_lat, stop_lon, d.stop_sequence,
           actual_arrival, planned_arrival, date_diff('second', planned_arrival, actual_arrival) AS delay_calc, shape_dist_traveled,
           CASE WHEN h > 23 THEN lpad((h - 24)::VARCHAR, 2, '0') || substr(start, 3) ELSE start END AS trip_start_time_cleaned,
           strptime(d.event_date, '%Y%m%d')::DATE AS event_date, epoch(actual_arrival)::BIGINT % 86400 AS s,
           (h % 24) * 3600 + substr(start, 4, 2)::INTEGER * 60 + substr(start, 7, 2)::INTEGER AS s0
    FROM delay_mart d
    LEFT JOIN {_CONTENT} st ON st.trip_id = d.trip_id AND st.mode = d.mode AND st.stop_sequence = d.stop_sequence
    LEFT JOIN (SELECT *, split_part(start, ':', 1)::INTEGER AS h FROM {_STARTS}) b ON b.trip_id = st.trip_id AND b.mode = st.mode
    LEFT JOIN (SELECT DISTINCT stop_id, mode, stop_code, stop_desc, stop_lat, stop_lon FROM stops) p ON p.stop_id = d.stop_id AND p.mode = d.mode"""
_TIMED = f"""
    SELECT *, ((s - s0 + 86400) % 86400)::INTEGER AS time_elapsed_seconds, delay_calc - delay_lag_1 AS delay_delta, dayname(actual_arrival) AS weekday
    FROM (SELECT *, lag(delay_calc) OVER (PARTITION BY unique_trip_key ORDER BY stop_sequence, actual_arrival, planned_arrival, stop_id) AS delay_lag_1
          FROM (SELECT *, trip_id || '_' || trip_headsign || '_' || event_date || '_' || mode AS unique_trip_key FROM ({_BASE})))"""
_WITH_DIST = "SELECT *, " + ", ".join(f"{_KM.format(lat=a, lon=b)} AS \"dist_{n}\"" for n, (a, b) in _DIST.items()) + f" FROM ({_TIMED})"
_COLS = """unique_trip_key, trip_id, trip_headsign, route_short_name, mode, stop_id, stop_name, stop_lat, stop_lon, stop_sequence, actual_arrival,
    planned_arrival, delay_calc, delay_lag_1, delay_delta, shape_dist_traveled, trip_start_time_cleaned, time_elapsed_seconds, event_date, weekday,
    s::INTEGER AS seconds_since_midnight, round(2 * pi() * s / 86400, 6) AS theta, round(sin(2 * pi() * s / 86400), 6) + 0.0::DOUBLE AS time_sin,
    round(cos(2 * pi() * s / 86400), 6) + 0.0::DOUBLE AS time_cos, """ + ", ".join(f'round("dist_{n}", 6) AS "dist_{n}"' for n in _DIST)


def features(feed: Feed):
    return ft.delay_features(feed.delay_mart(), feed.stop_times(), feed.stops(), ft.reference_points(feed.districts()))


def tidy(df):
    floats = [c for c in df.columns if c.startswith("dist_") or c in ("theta", "time_sin", "time_cos")]
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in floats})


add("m8_delay_features", lambda f: tidy(features(f)), f"SELECT {_COLS}, stop_code, stop_desc FROM ({_WITH_DIST})")
_BAND = """time_elapsed_seconds < 7200 AND delay_calc BETWEEN -600 AND 3600 AND delay_lag_1 BETWEEN -600 AND 3600 AND "dist_Stare_Miasto" < 50"""
add("m9_clean_features", lambda f: tidy(ft.clean_features(features(f))),
    f"SELECT DISTINCT {_COLS} FROM ({_WITH_DIST}) WHERE {_BAND} AND shape_dist_traveled IS NOT NULL")
add("pf7_outlier_band", lambda f: ft.clean_outliers(features(f)).groupBy("mode", "weekday").agg(F.count(F.lit(1)).alias("cnt"), F.max("delay_calc").alias("worst")),
    f"SELECT mode, weekday, count(*) AS cnt, max(delay_calc) AS worst FROM ({_WITH_DIST}) WHERE {_BAND} GROUP BY ALL")
add("j11_delay_stop_joins",
    lambda f: ft.delay_base(f.delay_mart(), f.stop_times(), f.stops()).select("trip_id", "mode", "event_date", "stop_id", "stop_sequence", "shape_dist_traveled", "stop_code", "trip_start_time_cleaned"),
    f"SELECT trip_id, mode, event_date, stop_id, stop_sequence, shape_dist_traveled, stop_code, trip_start_time_cleaned FROM ({_BASE})")
add("w12_trip_start", lambda f: ft.trip_start(f.stop_times()), f"SELECT trip_id, mode, start AS trip_start_time FROM {_STARTS}")
add("w13_latest_stop_times", lambda f: ft.latest_stop_times(f.stop_times()).select("trip_id", "mode", "stop_sequence", "stop_id", "arrival_time", "load_timestamp"),
    f"SELECT trip_id, mode, stop_sequence, stop_id, arrival_time, load_timestamp FROM {_CONTENT}")
add("w13_first_stops", lambda f: ft.first_stops(f.stops()).select("stop_id", "stop_name", "mode", "load_timestamp"),
    "SELECT stop_id, any_value(stop_name) AS stop_name, mode, min(load_timestamp) AS load_timestamp FROM stops GROUP BY stop_id, mode")
add("w14_delay_delta",
    lambda f: ft.delay_delta(f.delay_mart().withColumn("unique_trip_key", text.trip_key(F.col("trip_id"), F.col("trip_headsign"), F.col("event_date"), F.col("mode")))
        .withColumns({"shape_dist_traveled": F.lit(0), "stop_lat": F.lit(0), "stop_lon": F.lit(0)}), value="delay")
    .select("trip_id", "mode", "event_date", "stop_id", "delay_lag_1", "delay_delta"),
    """SELECT trip_id, mode, event_date, stop_id, lag(delay) OVER w AS delay_lag_1, delay - lag(delay) OVER w AS delay_delta FROM delay_mart
       WINDOW w AS (PARTITION BY trip_id, mode, event_date, trip_headsign ORDER BY stop_sequence, actual_arrival, planned_arrival, stop_id)""")
add("pf8_near_and_punctual",
    lambda f: ft.near_and_punctual(
        ft.with_distances(f.delay_mart().join(f.stops().filter("load_timestamp = timestamp_ntz'2024-01-01'").select("stop_id", "mode", "stop_lat", "stop_lon"), ["stop_id", "mode"]),
                          [("Nowa_Huta", 50.085556, 20.190556), ("Swoszowice", 49.972778, 19.937778)]),
        ["dist_Nowa_Huta", "dist_Swoszowice"], km=20).select("trip_id", "stop_id", "mode", "event_date", "delay"),
    f"""SELECT trip_id, stop_id, mode, event_date, delay FROM (SELECT d.*, stop_lat, stop_lon FROM delay_mart d JOIN stops s
        ON s.stop_id = d.stop_id AND s.mode = d.mode AND s.load_timestamp = TIMESTAMP '2024-01-01')
        WHERE delay <= 10 AND {_KM.format(lat=50.085556, lon=20.190556)} <= 20 AND {_KM.format(lat=49.972778, lon=19.937778)} <= 20""")
add("m10_sample_delays", lambda f: ft.sample_delays(f.delay_mart(), f.stops(), f.stop_times(), n=1500, seed=3),
    """SELECT d.*, stop_lat, stop_lon, shape_dist_traveled
       FROM (SELECT * FROM delay_mart QUALIFY row_number() OVER (PARTITION BY schedule_timestamp::DATE ORDER BY md5('3|' || trip_id || '|' || stop_id || '|' || mode || '|' || event_date)) <= 1500) d
       LEFT JOIN stops s ON s.stop_id = d.stop_id AND s.mode = d.mode AND s.stop_name = d.stop_name
       LEFT JOIN stop_times t ON t.stop_id = d.stop_id AND t.trip_id = d.trip_id AND t.stop_sequence = d.stop_sequence AND t.mode = d.mode
       QUALIFY row_number() OVER (PARTITION BY d.trip_id, d.stop_id, d.stop_name, d.trip_headsign, d.planned_arrival
                                  ORDER BY d.load_timestamp DESC, d.mode, d.event_date, stop_lat, stop_lon, shape_dist_traveled) = 1""")

# versioned and incremental loads


def customers(f: Feed, version: int):
    """Customer dimension as two loads: some keys appear late, some change, some vanish."""
    k = F.col("c_custkey")
    ts = F.lit("2024-01-01" if version == 1 else "2024-02-01").cast("timestamp_ntz")
    segment = F.when((F.lit(version) == 2) & (k % 5 == 0), F.lit("MOVED")).when((k % 11 == 0) & (F.lit(version) == 1), None).otherwise(F.col("c_mktsegment"))
    keep = k % 7 != 0 if version == 1 else k % 13 != 0
    return f.raw("customer").filter(keep).select(k.alias("route_id"), F.lit("A").alias("mode"), segment.alias("segment"), F.col("c_acctbal").alias("bal"), ts.alias("load_timestamp"))


def merged(f: Feed):
    first = scd2.scd2_merge(scd2.scd2_empty(customers(f, 1)), customers(f, 1), ["route_id", "mode"])
    return scd2.scd2_merge(first, customers(f, 2), ["route_id", "mode"])


_CUST = """WITH a AS (SELECT c_custkey AS route_id, 'A' AS mode, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS bal
                      FROM customer WHERE c_custkey % 7 <> 0),
     b AS (SELECT c_custkey AS route_id, 'A' AS mode, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, c_acctbal AS bal
           FROM customer WHERE c_custkey % 13 <> 0)
"""
_SCD2 = _CUST + """SELECT a.*, TIMESTAMP '2024-01-01' AS load_timestamp, TIMESTAMP '1900-01-01' AS valid_from,
        CASE WHEN b.route_id IS NOT NULL AND (a.segment, a.bal) IS DISTINCT FROM (b.segment, b.bal) THEN TIMESTAMP '2024-02-01' END AS valid_to,
        NOT (b.route_id IS NOT NULL AND (a.segment, a.bal) IS DISTINCT FROM (b.segment, b.bal)) AS is_current
 FROM a LEFT JOIN b ON a.route_id = b.route_id
 UNION ALL
 SELECT b.*, TIMESTAMP '2024-02-01', CASE WHEN a.route_id IS NULL THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '2024-02-01' END, NULL, true
 FROM b LEFT JOIN a ON a.route_id = b.route_id WHERE a.route_id IS NULL OR (a.segment, a.bal) IS DISTINCT FROM (b.segment, b.bal)"""
QUERIES["m11_scd2_merge"], SQL["m11_scd2_merge"] = (lambda spark, d: merged(Feed(spark, d))), _SCD2
QUERIES["m11_scd2_merge_again"] = lambda spark, d: (lambda f: scd2.scd2_merge(merged(f), customers(f, 2), ["route_id", "mode"]))(Feed(spark, d))
SQL["m11_scd2_merge_again"] = _SCD2
QUERIES["j16_closed_versions"] = lambda spark, d: merged(Feed(spark, d)).filter(~F.col("is_current")).select("route_id", "valid_to")
SQL["j16_closed_versions"] = f"SELECT route_id, valid_to FROM ({_SCD2}) WHERE NOT is_current"
QUERIES["j14_changed_keys_anti"] = lambda spark, d: (lambda f: customers(f, 2).alias("n").join(
    customers(f, 1).alias("o"), (F.col("n.route_id") == F.col("o.route_id")) & text.same_row("n", "o", ["segment", "bal"]), "left_anti").select("route_id"))(Feed(spark, d))
SQL["j14_changed_keys_anti"] = _CUST + "SELECT route_id FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.route_id = b.route_id AND a.bal = b.bal AND a.segment IS NOT DISTINCT FROM b.segment)"
QUERIES["j15_key_seen_before"] = lambda spark, d: (lambda f: customers(f, 2).select("route_id").join(
    customers(f, 1).select("route_id").distinct().withColumn("seen", F.lit(True)), "route_id", "left").select("route_id", F.coalesce("seen", F.lit(False)).alias("seen")))(Feed(spark, d))
SQL["j15_key_seen_before"] = _CUST + "SELECT route_id, EXISTS (SELECT 1 FROM a WHERE a.route_id = b.route_id) AS seen FROM b"
QUERIES["snk12_upsert"] = lambda spark, d: (lambda f: scd2.upsert(customers(f, 1), customers(f, 2), ["route_id"]).drop("load_timestamp"))(Feed(spark, d))
SQL["snk12_upsert"] = _CUST + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE route_id NOT IN (SELECT route_id FROM b)"
add("snk11_latest_load", lambda f: sk.latest_not_loaded(f.stop_times(), f.stop_times().filter("load_timestamp = timestamp_ntz'2024-01-01'")),
    "SELECT * FROM stop_times WHERE load_timestamp = (SELECT max(load_timestamp) FROM stop_times)")
add("snk5_daily_chunks", lambda f: sk.changed_days(sk.with_day(f.delays()), sk.with_day(f.delays().filter("load_timestamp < timestamp_ntz'2024-01-10 12:00:00'")))
    .groupBy("d").agg(F.count(F.lit(1)).alias("cnt"), F.max("load_timestamp").alias("last")),
    "SELECT load_timestamp::DATE AS d, count(*) AS cnt, max(load_timestamp) AS last FROM delays WHERE load_timestamp >= TIMESTAMP '2024-01-10' GROUP BY 1")
add("snk6_incremental_rows", lambda f: sk.from_day_of(f.delays(), "2024-01-12 06:00:00").select("trip_id", "load_timestamp", "delay"),
    "SELECT trip_id, load_timestamp, delay FROM delays WHERE load_timestamp >= TIMESTAMP '2024-01-12'")
add("snk9_missing_dates", lambda f: sk.load_missing_dates(f.delays(), f.delays().filter("mode = 'error' and event_date % 3 = 0")).select("trip_id", "load_timestamp"),
    "SELECT trip_id, load_timestamp FROM delays WHERE NOT (mode = 'error' AND event_date::BIGINT % 3 = 0)")
add("snk1_normalized_schema", lambda f: sk.normalize_schema(f.delays().select("trip_id", "stop_sequence", "delay", "load_timestamp", F.to_date("load_timestamp").alias("day"))),
    """SELECT trip_id AS "TRIP_ID", stop_sequence::BIGINT AS "STOP_SEQUENCE", delay AS "DELAY", load_timestamp AS "LOAD_TIMESTAMP", load_timestamp::DATE::VARCHAR AS "DAY" FROM delays""")
add("m13_incremental_window",
    lambda f: sk.incremental_window(f.delays().select(F.col("stop_name").alias("k")), st.high_water(
        f.delays().filter("mode = 'error'").select(F.col("stop_name").alias("k"), "load_timestamp"), "k", "load_timestamp"), "k", "2024-03-05"),
    """SELECT k, start, DATE '2024-03-04' AS "end" FROM (
         SELECT stop_name AS k, greatest(DATE '2024-03-05' - 60, coalesce(max(load_timestamp::DATE) FILTER (mode = 'error') + 1, DATE '1970-01-01'))::DATE AS start
         FROM delays GROUP BY 1) WHERE start <= DATE '2024-03-04'""")
add("m14_dedup_counts", lambda f: sk.duplicate_report(f.trips().select("route_id", "service_id", "mode")),
    """SELECT count(*) AS total_rows, count(DISTINCT (route_id, service_id, mode)) AS distinct_rows,
       count(*) - count(DISTINCT (route_id, service_id, mode)) AS duplicate_rows FROM trips""")
add("src10_file_table_date",
    lambda f: (lambda p: f.raw("orders").select("o_orderkey", p.alias("p")).select("o_orderkey", text.table_of("p").alias("tbl"), text.date_of("p").alias("day")))(
        F.concat(F.lit("/exports/TRIP_UPDATES_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 3 == 0, "_1").otherwise(""), F.lit(".parquet"))),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'TRIP_UPDATES_' || o_orderdate::DATE || '_1' ELSE 'TRIP_UPDATES' END AS tbl,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::DATE END AS day FROM orders""")


def views(f: Feed):
    f.delays().createOrReplaceTempView("delays_view")
    return f.spark


QUERIES["src12_table_scan"] = lambda spark, d: tb.table(views(Feed(spark, d)), "delays_view").groupBy("mode").agg(F.count(F.lit(1)).alias("cnt"))
SQL["src12_table_scan"] = sql("SELECT mode, count(*) AS cnt FROM delays GROUP BY 1")
QUERIES["src13_adhoc_select"] = lambda spark, d: tb.adhoc_select(views(Feed(spark, d)), "SELECT mode, max(delay) AS worst FROM delays_view GROUP BY mode;")
SQL["src13_adhoc_select"] = sql("SELECT mode, max(delay) AS worst FROM delays GROUP BY 1")

# nested inputs

_V = "({0} || '')"


def weather_payload(f: Feed):
    """One forecast answer per event: three hours, a short wind array and no other field."""
    t = lambda h: F.concat(F.lit('"'), F.date_format(F.timestamp_add("HOUR", F.lit(h), F.date_trunc("hour", "ts").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm"), F.lit('"'))
    n = lambda i: (F.col("event_id") % 40 + i).cast("string")
    join = lambda items: F.concat_ws(",", *items)
    block = lambda name: F.concat(F.lit(f'"{name}":{{"time":['), join([t(0), t(1), t(2)]), F.lit('],"temperature_2m":['), join([n(0), n(1), n(2)]),
                                  F.lit('],"wind_speed_10m":['), join([n(5), n(6)]), F.lit('],"is_day":['), join([n(0)]), F.lit("]}"))
    return f.raw("events").select(
        F.col("event_id").cast("string").alias("district_name"), F.lit(50.5).alias("latitude"), F.lit(19.5).alias("longitude"),
        F.concat(F.lit("{"), block("hourly"), F.lit(","), block("minutely_15"), F.lit("}")).alias("payload"))


def _weather_sql(fields):
    known = {
        "temperature_2m": "(event_id % 40 + i)::DOUBLE", "wind_speed_10m": "CASE WHEN i < 2 THEN (event_id % 40 + 5 + i)::DOUBLE END",
        "is_day": "CASE WHEN i = 0 THEN event_id % 40 <> 0 END",
    }
    kinds = {"double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    cols = ", ".join(f"{known.get(n, f'NULL::{kinds[k]}')} AS {n}" for n, k in fields.items())
    return f"""SELECT event_id::VARCHAR AS district_name, 50.5::DOUBLE AS latitude, 19.5::DOUBLE AS longitude,
        (date_trunc('hour', ts) + to_hours(i::INTEGER))::TIMESTAMP AS timestamp, {cols} FROM events, range(3) r(i)"""


add("src6_explode_hourly", lambda f: jf.explode_hourly(weather_payload(f)), _weather_sql(HOURLY_FIELDS))
add("src6_explode_min15", lambda f: jf.explode_min15(weather_payload(f)), _weather_sql(MIN15_FIELDS))


def flow_payload(f: Feed):
    n = lambda k: (F.col("event_id") % k).cast("string")
    return f.raw("events").select("event_id", F.concat(
        F.lit('{"flowSegmentData":{"frc":"FRC0","currentSpeed":'), n(50), F.lit(',"freeFlowSpeed":'), n(70), F.lit(',"currentTravelTime":'), n(90),
        F.lit(',"freeFlowTravelTime":'), n(60), F.lit(',"confidence":0.'), n(9), F.lit("}}")).alias("payload"))


add("src5_flow_segment", lambda f: jf.flatten_flow_segment(flow_payload(f)),
    """SELECT event_id, (event_id % 50)::DOUBLE AS current_speed, (event_id % 70)::DOUBLE AS free_flow_speed, (event_id % 90)::DOUBLE AS current_travel_time,
       (event_id % 60)::DOUBLE AS free_flow_travel_time, ('0.' || (event_id % 9))::DOUBLE AS confidence FROM events""")


def traffic_files(f: Feed):
    """One traffic file text per event, every tenth of them broken."""
    record = F.concat(F.lit('{"STOP_NAME":"Stop '), F.col("event_id").cast("string"), F.lit('","stop_lat":50.0,"stop_lon":20.0,"current_speed":'),
                      (F.col("event_id") % 50).cast("string"), F.lit(',"load_timestamp":"2026-05-17"}'))
    text_ = F.when(F.col("event_id") % 10 == 3, F.lit("{ invalid json }")).otherwise(F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")))
    return f.raw("events").select(text_.alias("value"))


add("src4_traffic_records", lambda f: jf.traffic_records(traffic_files(f))[0].select("STOP_NAME", "stop_lat", "current_speed", "confidence", "load_timestamp"),
    """SELECT 'Stop ' || event_id AS "STOP_NAME", 50.0::DOUBLE AS stop_lat, (event_id % 50)::DOUBLE AS current_speed, NULL::DOUBLE AS confidence,
       TIMESTAMP '2026-05-17' AS load_timestamp FROM events, range(2) WHERE event_id % 10 <> 3""")
add("src4_traffic_quarantine", lambda f: jf.traffic_records(traffic_files(f))[1].groupBy("value").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT '{ invalid json }' AS value, count(*) AS cnt FROM events WHERE event_id % 10 = 3")


def encoded(f: Feed, kind: str):
    """Feed messages built from the derived rows of a batch: one per mode and poll, as landed files hold them."""
    build = rt.message_factory()
    rows = f.trip_updates() if kind == "trip_update" else f.vehicle_positions()

    def encode(batches):
        import pyarrow as pa

        feed_class = build()
        schema = pa.schema([("content", pa.binary()), ("mode", pa.string()), ("load_timestamp", pa.timestamp("us"))])
        for batch in batches:
            polls = {}
            for r in batch.to_pylist():
                feed = polls.setdefault((r["mode"], r["load_timestamp"]), feed_class())
                feed.header.gtfs_realtime_version = "2.0"
                entity = feed.entity.add(id="e")
                if kind == "trip_update":
                    entity.trip_update.trip.trip_id = r["trip_id"]
                    stop = entity.trip_update.stop_time_update.add(stop_id=r["stop_id"], stop_sequence=r["stop_sequence"])
                    if r["arrival"] is not None:
                        stop.arrival.time = r["arrival"]
                    if r["departure"] is not None:
                        stop.departure.time = r["departure"]
                    stop.schedule_relationship = r["schedule_relationship"]
                else:
                    v = entity.vehicle
                    v.trip.trip_id, v.vehicle.id = r["trip_id"], r["id"]
                    v.position.latitude, v.position.longitude, v.position.bearing = r["bearing"], r["speed"], r["bearing"]
                    v.current_status, v.current_stop_sequence = r["current_status"], r["current_stop_sequence"]
            out = [{"content": m.SerializeToString(), "mode": k[0], "load_timestamp": k[1]} for k, m in polls.items()]
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(encode, "content binary, mode string, load_timestamp timestamp_ntz")


add("src2_decode_trip_updates", lambda f: rt.decode_trip_updates(encoded(f, "trip_update")), "SELECT * FROM trip_updates")
add("src3_decode_vehicles",
    lambda f: rt.decode_vehicle_positions(encoded(f, "vehicle")).select(
        "id", "trip_id", "bearing", "latitude", "current_status", "current_stop_sequence", "route_id", "odometer", "mode", "load_timestamp"),
    """SELECT id, trip_id, bearing, bearing AS latitude, current_status, current_stop_sequence, NULL::VARCHAR AS route_id, NULL::DOUBLE AS odometer, mode, load_timestamp
       FROM vehicle_positions""")
