"""Queries over committed tables and the streams that write them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.loads import _CUST, _SCD2, customers
from catalogue.marts import delay_sessions, report_sql, stop_days
from catalogue.stored import _KEPT, folder
from catalogue.tables_sql import sql
from punctualis.functions.geo import wkt_point
from punctualis.functions.times import epoch_to_local
from punctualis.operators.joins import join_asof
from punctualis.operators.nearest import nearest_of_many
from punctualis.operators.stats import polygon_centroid
from punctualis.plans import report as rp
from punctualis.plans import sessions as ss
from punctualis.plans.delays import build_delays
from punctualis.plans.incremental import mean_delay
from punctualis.plans.schedule import build_trips_schedule
from punctualis.sources import committed as ct
from punctualis.sources import tables as tb
from punctualis.sources.gtfs_static import read_gtfs_static
from punctualis.sources.json_feeds import read_geojson
from punctualis.streaming import loads as st

QUERIES = {}
SQL = {}


def add(name, query, text, derived=True):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    SQL[name] = sql(text) if derived else text


def _undated(f: Feed):
    return f.delays().select(*_KEPT).withColumn("load_timestamp", F.when(~F.col("stop_id").endswith("7"), F.col("load_timestamp")))


_UNDATED = "SELECT trip_id, stop_id, CASE WHEN stop_id NOT LIKE '%7' THEN load_timestamp END AS load_timestamp, delay FROM delays"


def exported(f: Feed):
    """Half of the early rows, then all, then all again, by the stored summaries; a second table follows by the manifests."""
    path, copy, rows = folder(f, "days"), folder(f, "copy"), _undated(f)
    ct.export_days(rows.filter("load_timestamp < timestamp_ntz'2024-01-15' AND delay % 2 = 0"), path)
    ct.copy_days(f.spark, path, copy)
    ct.export_days(rows, path)
    ct.export_days(rows, path)
    ct.copy_days(f.spark, path, copy)
    return ct.read(f.spark, copy).select(*_KEPT)


add("snk5_export_by_summary", exported, _UNDATED)


def exported_from_mark(f: Feed):
    """All rows before a day, then what the stored mark leaves to do."""
    path, rows = folder(f, "mark"), _undated(f)
    ct.export_new(rows.filter("load_timestamp < timestamp_ntz'2024-01-15' OR load_timestamp IS NULL"), path)
    ct.export_new(rows, path)
    return ct.read(f.spark, path).select(*_KEPT)


add("snk6_stored_mark", exported_from_mark, _UNDATED)


def loaded(f: Feed):
    """Rows that are missing on some days, with copies, loaded twice."""
    path, rows = folder(f, "missing"), _undated(f)
    ct.load_missing(rows.filter("trip_id NOT LIKE '%3'"), path)
    for _ in range(2):
        ct.load_missing(rows, path)
    return ct.read(f.spark, path).select(*_KEPT)


add("snk9_missing_by_summary", loaded, _UNDATED)


def merged_by_file(f: Feed):
    path = folder(f, "merge")
    ct.append(customers(f, 1).repartitionByRange(16, "route_id"), path, key="route_id")
    ct.merge(customers(f, 2), path, ["route_id"])
    return ct.read(f.spark, path).drop("load_timestamp")


add("snk12_merge_by_file", merged_by_file, _CUST + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE route_id NOT IN (SELECT route_id FROM b)", derived=False)


def versions_by_file(f: Feed):
    path = folder(f, "versions")
    for load in (1, 2, 2):
        ct.merge_versions(customers(f, load), path, ["route_id", "mode"])
    return ct.read(f.spark, path)


add("m11_versions_by_file", versions_by_file, _SCD2, derived=False)


def static_load(f: Feed):
    """Both loads of the static tables, the first one twice, into their targets; rows by table and load."""
    root = folder(f, "static")
    staged = {"trips": f.trips(), "stops": f.stops(), "calendar": f.calendar(), "stop_times": f.stop_times()}
    first = {name: df.filter("load_timestamp = timestamp_ntz'2024-01-01'") for name, df in staged.items()}
    for load, routes in ((first, 1), (first, 1), (staged, 2)):
        ct.load_static({**load, "routes": customers(f, routes)}, root)
    counts = [ct.read(f.spark, f"{root}/{name}").groupBy("load_timestamp").agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "*") for name in (*staged, "routes")]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


add("m12_static_load", static_load, " UNION ALL ".join(f"SELECT '{t}' AS tbl, load_timestamp, count(*) AS cnt FROM {t} GROUP BY 2" for t in ("trips", "stops", "calendar", "stop_times"))
    + " UNION ALL SELECT 'routes', load_timestamp, count(*) FROM (" + _SCD2 + ") GROUP BY 2")


def listed(f: Feed):
    """Names, rows, newest load of committed tables, from their manifests."""
    paths = {name: folder(f, name) for name in ("delays", "stops", "nothing")}
    ct.append(f.delays(), paths["delays"], ts="load_timestamp")
    ct.append(f.stops(), paths["stops"], ts="load_timestamp")
    return ct.list_tables(f.spark, paths).filter("table = 'nothing' OR (files > 0 AND bytes > 0)").select(F.col("table").alias("tbl"), "rows", "newest")


add("src14_table_list", listed, """SELECT 'delays' AS tbl, count(*) AS rows, max(load_timestamp) AS newest FROM delays
    UNION ALL SELECT 'stops', count(*), max(load_timestamp) FROM stops UNION ALL SELECT 'nothing', 0, NULL""")
add("src14_columns", lambda f: tb.describe(f.raw("events")).select(F.col("column").alias("col")), "SELECT column_name AS col FROM (DESCRIBE events)", derived=False)
add("f15_wkt_point", lambda f: f.stops().select("stop_id", wkt_point("stop_lon", "stop_lat").alias("wkt")).distinct(),
    "SELECT DISTINCT stop_id, 'POINT(' || stop_lon || ' ' || stop_lat || ')' AS wkt FROM stops")
add("u4_union_of_literals", lambda f: tb.literal_rows(f.spark, "d int, name string", [(1, "Monday"), (2, "Tuesday"), (3, "Wednesday"), (4, "Thursday"), (5, "Friday"), (6, "Saturday"), (0, "Sunday")])
    .join(f.raw("orders").groupBy((F.dayofweek("o_orderdate") - 1).alias("d")).agg(F.count(F.lit(1)).alias("cnt")), "d", "left").select("name", F.coalesce("cnt", F.lit(0)).alias("cnt")),
    """SELECT name, coalesce(cnt, 0) AS cnt FROM (SELECT 1 AS d, 'Monday' AS name UNION ALL SELECT 2, 'Tuesday' UNION ALL SELECT 3, 'Wednesday' UNION ALL SELECT 4, 'Thursday'
       UNION ALL SELECT 5, 'Friday' UNION ALL SELECT 6, 'Saturday' UNION ALL SELECT 0, 'Sunday') LEFT JOIN (SELECT dayofweek(o_orderdate) AS d, count(*) AS cnt FROM orders GROUP BY 1) USING (d)""", derived=False)


# operators over rows that they have to remove, and histories of many versions


def _repeated_stops(f: Feed):
    """Stop times in which every second stop is visited again, later in the trip."""
    again = f.stop_times().filter("stop_sequence % 2 = 0").withColumns({"stop_sequence": F.col("stop_sequence") + 100, "arrival_time": F.lit("27:59:00")})
    return f.stop_times().unionByName(again)


add("w2_first_visit_stays", lambda f: build_trips_schedule(_repeated_stops(f), f.trips(), f.stops(), f.routes_scd2(), f.expanded_calendar()), "SELECT * FROM schedule")


def _with_older(f: Feed):
    """Session rows, each with an older one that has more delay, and with one of the same time that has less."""
    found = delay_sessions(f)
    older = found.withColumns({"load_timestamp": F.col("load_timestamp") - F.expr("INTERVAL 1 SECOND"), "delay": F.col("delay") + 5})
    return found.unionByName(older).unionByName(found.withColumn("delay", F.col("delay") - 1))


add("w10_newest_then_most_delayed", lambda f: rp.latest_in_session(_with_older(f)).select("trip_id", "session_id", "stop_sequence", "mode", "stop_id", "delay", "load_timestamp"),
    "SELECT trip_id, session_id, stop_sequence, mode, stop_id, delay, load_timestamp FROM session_latest")
add("pf3_left_out_mode", lambda f: build_delays(*(df.unionByName(df.withColumn("mode", F.lit("TR"))) for df in (f.trip_updates(), f.served_schedule()))), "SELECT * FROM delay_mart")


def _history(f: Feed):
    """A version per line and moment of an event, which holds for at most an hour."""
    starts = f.delays().groupBy("route_short_name", F.col("actual_arrival").alias("valid_from")).agg(F.max("stop_name").alias("held_by"))
    return starts.withColumn("valid_to", F.col("valid_from") + F.expr("INTERVAL 1 HOUR"))


add("j2_asof_history", lambda f: join_asof(f.delays().select("trip_id", "route_short_name", (F.col("actual_arrival") + F.expr("INTERVAL 55 MINUTE")).alias("asked")), _history(f), ["route_short_name"], "asked")
    .select("trip_id", "route_short_name", "asked", "valid_from", "held_by"),
    """SELECT f.trip_id, f.route_short_name, f.asked, h.valid_from, h.held_by FROM (SELECT trip_id, route_short_name, actual_arrival + INTERVAL 55 MINUTE AS asked FROM delays) f
       ASOF JOIN (SELECT route_short_name, actual_arrival AS valid_from, max(stop_name) AS held_by FROM delays GROUP BY 1, 2) h
       ON f.route_short_name = h.route_short_name AND f.asked >= h.valid_from WHERE f.asked < h.valid_from + INTERVAL 1 HOUR""")


def _shops(f: Feed):
    """A centre per customer, scattered around the stops."""
    k = F.col("c_custkey")
    return f.raw("customer").select(F.concat(F.lit("C"), k.cast("string")).alias("centre"), (F.lit(49.9) + (k * 7919 % 30011) / F.lit(100000.0)).alias("lat"), (F.lit(19.7) + (k * 104729 % 60013) / F.lit(100000.0)).alias("lon"))


add("w5_nearest_of_many", lambda f: nearest_of_many(f.stops().select("stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon")).distinct(), _shops(f), 16)
    .select("stop_id", "centre", F.round("distance_m", 3).alias("distance_m")),
    """SELECT stop_id, centre, round(2 * 6371008.8::DOUBLE * d, 3) AS distance_m FROM (SELECT DISTINCT stop_id, stop_lat AS lat, stop_lon AS lon FROM stops) s,
       LATERAL (SELECT centre, asin(sqrt(pow(sin(radians(c.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - s.lon) / 2), 2))) AS d
                FROM (SELECT 'C' || c_custkey AS centre, 49.9 + (c_custkey * 7919 % 30011) / 100000.0 AS lat, 19.7 + (c_custkey * 104729 % 60013) / 100000.0 AS lon FROM customer) c
                ORDER BY d, centre LIMIT 1)""")


def static_folders(f: Feed):
    """Stops of each feed written as a text folder and read back as one table."""
    root = folder(f, "feeds")
    stops = f.stops().filter("load_timestamp = timestamp_ntz'2024-01-01'")
    for mode in "AMT":
        stops.filter(F.col("mode") == mode).drop("mode", "load_timestamp").write.option("header", True).csv(f"{root}/{mode}/stops.txt")
    return read_gtfs_static(f.spark, {mode: f"{root}/{mode}" for mode in "AMT"}, "2024-01-01")["stops"].select("stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "mode", "load_timestamp")


add("src1_static_folders", static_folders,
    "SELECT DISTINCT stop_id, stop_code, stop_name, stop_desc, stop_lat, stop_lon, mode, load_timestamp FROM stops WHERE load_timestamp = TIMESTAMP '2024-01-01'")


def geojson_centroids(f: Feed):
    """A square around every stop, without its last point, written as feature collections and read back; centroids of the rings."""
    path, x, y = folder(f, "geojson"), F.col("stop_lon"), F.col("stop_lat")
    ring = F.array(*[F.array(x + a, y + b) for a, b in ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5))])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("stop_id").alias("name")).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    stops = f.stops().select("stop_id", "stop_lon", "stop_lat").distinct()
    files = stops.groupBy(F.pmod(F.xxhash64("stop_id"), F.lit(4)).alias("file")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    files.repartition(4, "file").write.partitionBy("file").text(path)
    return polygon_centroid(read_geojson(f.spark, path))


add("src7_geojson_centroids", geojson_centroids, "SELECT DISTINCT stop_id AS name, round(stop_lat, 6) AS latitude, round(stop_lon, 6) AS longitude FROM stops")


# streams over rows written in several files


def _source(f: Feed, df, files: int):
    """A stream over rows in at least ``files`` files, more with the shuffle partitions, in two micro-batches."""
    path = folder(f, "source")
    files = max(files, int(f.spark.conf.get("spark.sql.shuffle.partitions")))
    df.repartitionByRange(files, "load_timestamp", "trip_id").write.parquet(path)
    return f.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(path)


def appended_stream(f: Feed):
    path, updates = folder(f, "stream"), f.trip_updates()
    st.stream_to_table(_source(f, updates, 4), path, folder(f, "progress"), "updates", ts="load_timestamp").awaitTermination()
    return ct.read(f.spark, path).select("trip_id", "stop_id", "stop_sequence", "arrival", "load_timestamp", "mode")


add("t2_append_stream", appended_stream, "SELECT trip_id, stop_id, stop_sequence, arrival, load_timestamp, mode FROM trip_updates")


def latest_state(f: Feed):
    """The newest update of every key, kept as state that ends three days after a key's own day."""
    actual = epoch_to_local(F.coalesce("arrival", "departure"))
    rows = f.trip_updates().select("trip_id", "mode", "stop_id", "stop_sequence", "load_timestamp", actual.alias("actual_arrival")).withColumn("actual_day", F.to_date("actual_arrival"))
    keys, path = ["trip_id", "mode", "stop_id", "actual_day"], folder(f, "state")
    st.stream_latest_state(_source(f, rows, 4), keys, ["load_timestamp", "stop_sequence", "actual_arrival"], "actual_arrival", path, folder(f, "progress"), "3 days").awaitTermination()
    return ct.read(f.spark, path).select(*rows.columns)


add("t5_latest_state", latest_state, "SELECT trip_id, mode, stop_id, stop_sequence, load_timestamp, actual AS actual_arrival, actual::DATE AS actual_day FROM updates WHERE actual IS NOT NULL")


def _marts(f: Feed) -> str:
    root, plan = folder(f, "marts"), folder(f, "plan")
    f.schedule().write.parquet(plan)
    st.stream_marts(_source(f, f.trip_updates(), 4), lambda spark: spark.read.parquet(plan), root, folder(f, "progress")).awaitTermination()
    return root


add("m3_incremental_mart", lambda f: ct.read(f.spark, f"{_marts(f)}/mart"), "SELECT * FROM delay_mart")
add("a7_incremental_sums", lambda f: mean_delay(ct.read(f.spark, f"{_marts(f)}/sums"), "mode").withColumn("mean", F.round("mean", 6)),
    "SELECT mode, count(*) AS cnt, round(avg(delay), 6) AS mean FROM delay_mart GROUP BY 1")


def _session_log(f: Feed) -> str:
    """The delays in three batches, of which each brings rows of all days; the second one comes twice."""
    root, kept = folder(f, "sessions"), folder(f, "delays")
    f.delay_mart().write.parquet(kept)
    rows = f.spark.read.parquet(kept)
    third = F.pmod(F.xxhash64("trip_id", "stop_sequence", "load_timestamp"), F.lit(3))
    for number, part in ((0, 0), (1, 1), (1, 1), (2, 2)):
        ss.add_rows(rows.where(third == part), root, ("delays", number))
    return root


add("m7_report_from_summaries",
    lambda f: ss.stored_report(f.spark, _session_log(f), stop_days(f), "2024-01-05", "2024-01-06").withColumn("avg_delay", F.round("avg_delay", 6)),
    report_sql("a.next_stop_id"))
add("w9_sessions_of_days",
    lambda f: ss.sessions_between(f.spark, _session_log(f), "2024-01-06", "2024-01-08").select("trip_id", "mode", "load_timestamp", "stop_sequence", "stop_id", "event_date", "session_id"),
    """SELECT trip_id, mode, load_timestamp, stop_sequence, stop_id, event_date, session_id FROM sessions
       SEMI JOIN (SELECT DISTINCT trip_id AS t, mode AS m, session_id AS s FROM sessions WHERE load_timestamp::DATE BETWEEN DATE '2024-01-06' AND DATE '2024-01-08') w
       ON trip_id IS NOT DISTINCT FROM t AND mode IS NOT DISTINCT FROM m AND session_id = s""")
