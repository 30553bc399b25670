"""Aggregates, ranks, set operations and statistics over the delay rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.tables_sql import sql
from punctualis.functions.times import round_half_hour, weekday_name
from punctualis.operators import dedup as dd
from punctualis.operators import stats as st
from punctualis.operators.prefix import cumulative_counts, exact_quantiles
from punctualis.sources.gtfs_static import union_feeds

QUERIES: dict = {}
SQL: dict = {}


def add(name, query, text=None):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    if text is not None:
        SQL[name] = sql(text)


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


add("a2_global_min_max", lambda f: f.delays().agg(F.min("load_timestamp").alias("first"), F.max("load_timestamp").alias("last"), F.max("event_date").alias("day")),
    "SELECT min(load_timestamp) AS first, max(load_timestamp) AS last, max(event_date) AS day FROM delays")
add("a3_high_water", lambda f: st.high_water(f.hourly_weather(), "district_name", "timestamp"),
    "SELECT district_name, max(timestamp)::DATE AS last_day FROM hourly_weather GROUP BY 1")
add("a4_distinct_dates", lambda f: f.delays().select("event_date", "mode").distinct(), "SELECT DISTINCT event_date, mode FROM delays")
add("a5_dedup_exact", lambda f: dd.dedup_exact(f.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")),
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem GROUP BY ALL")
add("a5_duplicate_report", lambda f: dd.duplicate_report(f.raw("lineitem").select("l_orderkey", "l_linenumber")),
    """SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""")
for _stat, _agg in {"mean": "round(avg(delay), 6)", "max": "max(delay)", "median": "median(delay)"}.items():
    add(
        f"a6_top_routes_{_stat}",
        lambda f, s=_stat: (lambda df: rounded(df, "mean") if s == "mean" else df)(st.rank_groups(f.delays(), "route_short_name", s, 10)),
        f"SELECT route_short_name, {_agg} AS {_stat} FROM delays GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    )
add("a7_delay_by_mode", lambda f: rounded(st.delay_by(f.delays(), "mode", ["mean", "median"]), "mean"),
    "SELECT mode AS grp, round(avg(delay), 6) AS mean, median(delay) AS median FROM delays GROUP BY 1")
_GROUPS = {
    "hour": (lambda: F.hour("actual_arrival"), "hour(actual_arrival)::INTEGER"),
    "weekday": (lambda: weekday_name("actual_arrival"), "dayname(actual_arrival)"),
    "date": (lambda: F.to_date("actual_arrival"), "actual_arrival::DATE"),
    "stop_sequence": (lambda: F.col("stop_sequence"), "stop_sequence"),
}
for _name, (_make, _key) in _GROUPS.items():
    add(f"a8_delay_by_{_name}", lambda f, m=_make: rounded(st.delay_by(f.delays(), m()), "mean"),
        f"SELECT {_key} AS grp, round(avg(delay), 6) AS mean FROM delays GROUP BY 1")
_NINE = "round(avg(delay), 6) AS mean, max(delay) AS max, round(stddev_samp(delay), 6) AS std FROM delays GROUP BY 1"
add("a9_spread_by_weekday", lambda f: rounded(st.delay_by(f.delays(), weekday_name("actual_arrival"), ["mean", "max", "std"]), "mean", "std"),
    f"SELECT dayname(actual_arrival) AS grp, {_NINE}")
add("a9_spread_by_half_hour", lambda f: rounded(st.delay_by(f.delays(), round_half_hour("actual_arrival"), ["mean", "max", "std"]), "mean", "std"),
    f"SELECT strftime(time_bucket(INTERVAL 30 MINUTE, actual_arrival + INTERVAL 15 MINUTE), '%H:%M') AS grp, {_NINE}")
add("a10_weekday_hour_matrix", lambda f: rounded(st.weekday_hour_matrix(f.delays()), *[f"h{h}" for h in range(24)]),
    "SELECT dayname(actual_arrival) AS weekday, "
    + ", ".join(f"round(avg(delay) FILTER (hour(actual_arrival) = {h}), 6) AS h{h}" for h in range(24)) + " FROM delays GROUP BY 1")
add("a11_on_time_rate", lambda f: rounded(st.on_time_rate(f.delays()), "on_time", "late"),
    """SELECT round(count(*) FILTER (delay BETWEEN -1 AND 2) / count(*), 6) AS on_time, round(count(*) FILTER (delay > 2) / count(*), 6) AS late FROM delays""")
_DESC = "SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, " \
        "quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM {t}"
add("a12_describe", lambda f: rounded(st.describe_numeric(f.delays(), ["delay", "stop_sequence"]), "mean", "std"),
    " UNION ALL ".join(_DESC.format(c=c, t="delays") for c in ("delay", "stop_sequence")))
add("a12_describe_continuous", lambda f: rounded(st.describe_numeric(f.raw("lineitem"), ["l_extendedprice", "l_quantity"]), "mean", "std", "q25", "q50", "q75", digits=4),
    "SELECT * REPLACE (round(mean, 4) AS mean, round(std, 4) AS std, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75) FROM ("
    + " UNION ALL ".join(_DESC.format(c=c, t="lineitem") for c in ("l_extendedprice", "l_quantity")) + ")")
add("a12_quantiles_by_group", lambda f: rounded(exact_quantiles(f.raw("events"), "value", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, ["event_type"]), "p10", "p50", "p99"),
    "SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
add("a13_missing_report", lambda f: rounded(st.missing_report(f.delays(), ["delay", "stop_name", "mode"]), "percent"),
    " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100 / count(*), 6) AS percent FROM delays" for c in ("delay", "stop_name", "mode")))
add("a14_value_counts", lambda f: st.value_counts(f.delays(), "route_short_name"), "SELECT route_short_name, count(*) AS cnt FROM delays GROUP BY 1")


def _hist_sql(col: str, table: str, n: int) -> str:
    return f"""SELECT bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end,
        (SELECT count(*) FROM {table} WHERE {col} IS NOT NULL AND least(floor(({col} - lo) / w), {n - 1}) = bin) AS cnt
        FROM (SELECT min({col})::DOUBLE AS lo, (max({col}) - min({col}))::DOUBLE / {n} AS w, unnest(range({n}))::INTEGER AS bin FROM {table})"""


add("a15_histogram", lambda f: rounded(st.histogram(f.delays(), "delay", 10), "bin_start", "bin_end"), _hist_sql("delay", "delays", 10))
add("a15_hour_histogram", lambda f: rounded(st.histogram(f.delays().select(F.hour("actual_arrival").alias("h")), "h", 24), "bin_start", "bin_end"),
    _hist_sql("h", "(SELECT hour(actual_arrival) AS h FROM delays)", 24))


def _box_sql(low: str, high: str) -> str:
    return f"""SELECT g.mode, q1, g.median, q3, min(delay) FILTER (delay BETWEEN lo AND hi)::DOUBLE AS whisker_low,
        max(delay) FILTER (delay BETWEEN lo AND hi)::DOUBLE AS whisker_high, count(*) FILTER (delay < lo OR delay > hi) AS outliers
        FROM delays d JOIN (SELECT *, {low} AS lo, {high} AS hi FROM (
             SELECT mode, quantile_cont(delay, 0.25)::DOUBLE AS q1, quantile_cont(delay, 0.5)::DOUBLE AS median, quantile_cont(delay, 0.75)::DOUBLE AS q3,
                    quantile_cont(delay, 0.01) AS p1, quantile_cont(delay, 0.99) AS p99 FROM delays GROUP BY 1)) g ON g.mode = d.mode GROUP BY ALL"""


add("a16_box_stats", lambda f: st.box_stats(f.delays(), "delay", ["mode"]), _box_sql("q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"))
add("a16_box_stats_percentile_whiskers", lambda f: st.box_stats(f.delays(), "delay", ["mode"], (0.01, 0.99)), _box_sql("p1", "p99"))
_CORR = ["delay", "stop_sequence", "hour"]
_CD = "(SELECT delay, stop_sequence, hour(actual_arrival) AS hour FROM delays)"


def _numeric(f: Feed):
    return f.delays().select("delay", "stop_sequence", F.hour("actual_arrival").alias("hour"))


add("a17_corr_matrix", lambda f: rounded(st.corr_matrix(_numeric(f), _CORR), "corr"),
    " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS corr FROM {_CD}" for a in _CORR for b in _CORR))
add("a17_corr_with_delay", lambda f: rounded(st.corr_with(_numeric(f), "delay", _CORR), "corr"),
    " UNION ALL ".join(f"SELECT '{a}' AS feature, round(corr(delay, {a}), 6) AS corr FROM {_CD}" for a in _CORR))


def _kruskal_sql(features, digits=4):
    parts = []
    for f in features:
        parts.append(f"""SELECT '{f}' AS feature, count(DISTINCT lvl) AS groups, max(n) AS rows,
            round((12 / (max(n)::DOUBLE * (max(n) + 1)) * sum(r * r / c) - 3 * (max(n) + 1)) / (1 - max(ties) / (max(n)::DOUBLE ** 3 - max(n))), {digits}) AS h
            FROM (SELECT lvl, sum(rk) AS r, count(*) AS c, max(n) AS n, max(t) AS ties FROM (
                  SELECT lvl, rk, n, (SELECT sum(c::DOUBLE ** 3 - c) FROM (SELECT count(*) AS c FROM delays WHERE {f} IS NOT NULL AND delay IS NOT NULL GROUP BY delay)) AS t
                  FROM (SELECT {f}::VARCHAR AS lvl, rank() OVER (ORDER BY delay) + (count(*) OVER (PARTITION BY delay) - 1) / 2 AS rk, count(*) OVER () AS n
                        FROM delays WHERE {f} IS NOT NULL AND delay IS NOT NULL)) GROUP BY lvl)""")
    return " UNION ALL ".join(parts)


_KF = ["mode", "route_short_name", "stop_sequence"]
add("a18_kruskal", lambda f: rounded(st.kruskal_by(f.delays(), "delay", _KF).drop("p"), "h", digits=4), _kruskal_sql(_KF))
# For an even number of degrees of freedom the tail is a finite sum: modes (5 levels) and stop positions (25).
add("a18_kruskal_p", lambda f: rounded(st.kruskal_by(f.delays(), "delay", ["mode", "stop_sequence"]).select("feature", "groups", "p"), "p", digits=8),
    f"""SELECT feature, groups, round(exp(-h / 2) * (SELECT sum((h / 2) ** k / gamma(k + 1)) FROM range(((groups - 1) // 2)::BIGINT) t(k)), 8) AS p
        FROM ({_kruskal_sql(["mode", "stop_sequence"], 12)})""")
# All features, also routes with an odd number of degrees of freedom; no finite sum in SQL, a test integrates the tail.
add("a18_kruskal_p_all", lambda f: rounded(st.kruskal_by(f.delays(), "delay", _KF).select("feature", "groups", "p"), "p", digits=8))
add("a19_density", lambda f: rounded(st.kde(f.delays(), "delay", 50), "x", "density", digits=8),
    """SELECT point::INTEGER AS point, round(x, 8) AS x, round(sum(exp(-0.5 * ((x - delay) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
       FROM (SELECT unnest(range(50)) AS point, min(delay) + unnest(range(50)) * (max(delay) - min(delay))::DOUBLE / 49 AS x, count(delay) AS n,
                    stddev_samp(delay) * count(delay) ** (-0.2) AS h FROM delays), delays
       WHERE delay IS NOT NULL GROUP BY point, x""")


def rings(f: Feed):
    """One closed ring per supplier: a square around the stop with one corner cut by its key."""
    s = f.stops().filter((F.col("mode") == "A") & (F.col("load_timestamp") == F.lit("2024-01-01").cast("timestamp_ntz")))
    r = (F.substring("stop_id", 2, 12).cast("int") % 7 + 1) / 1000.0
    corner = lambda dx, dy: F.struct((F.col("stop_lon") + dx * r).alias("lon"), (F.col("stop_lat") + dy * r).alias("lat"))
    ring = F.array(corner(-1, -1), corner(1, -1), corner(1, 0), corner(0, 1), corner(-1, 1), corner(-1, -1))
    return s.select(F.col("stop_id").alias("name"), F.lit(0).alias("part"), F.lit(0).alias("ring"), F.posexplode(ring).alias("pos", "p")).select(
        "name", "part", "ring", "pos", "p.lon", "p.lat")


# a 2r square without a corner triangle of area r*r/2 whose centroid is r*2/3 up and right
add("a20_polygon_centroid", lambda f: st.polygon_centroid(rings(f)),
    """SELECT stop_id AS name, round(stop_lat - (2::DOUBLE / 3 * 0.5 / 3.5) * (substr(stop_id, 2)::INTEGER % 7 + 1) / 1000, 6) AS latitude,
       round(stop_lon - (2::DOUBLE / 3 * 0.5 / 3.5) * (substr(stop_id, 2)::INTEGER % 7 + 1) / 1000, 6) AS longitude
       FROM stops WHERE mode = 'A' AND load_timestamp = TIMESTAMP '2024-01-01'""")
add("a18_average_ranks", lambda f: cumulative_counts(f.delays(), "delay", ["mode"]),
    """SELECT mode, delay, count(*) AS cnt, (sum(count(*)) OVER (PARTITION BY mode ORDER BY delay) - count(*))::BIGINT AS below,
       (sum(count(*)) OVER (PARTITION BY mode))::BIGINT AS total FROM delays WHERE delay IS NOT NULL GROUP BY mode, delay""")

# order and top-k
add("o1_sorted_layout", lambda f: f.hourly_weather().select("district_name", "timestamp", "temperature_2m").repartitionByRange("district_name", "timestamp").sortWithinPartitions("district_name", "timestamp"),
    "SELECT district_name, timestamp, temperature_2m FROM hourly_weather")
add("o2_report_order", lambda f: st.delay_by(f.delays(), "route_short_name", ["count", "max"]).orderBy(F.col("max").desc(), "grp"),
    "SELECT route_short_name AS grp, count(delay) AS count, max(delay) AS max FROM delays GROUP BY 1")
add("o3_top_k", lambda f: st.top_k(f.delays(), "route_short_name", 10), "SELECT route_short_name, count(*) AS cnt FROM delays GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
add("o3_worst_stops", lambda f: rounded(st.rank_groups(f.delays(), "stop_name", "mean", 10), "mean"),
    "SELECT stop_name, round(avg(delay), 6) AS mean FROM delays GROUP BY 1 ORDER BY avg(delay) DESC, 1 LIMIT 10")
add("o4_top_k_per_group", lambda f: st.top_k_per_group(f.delays(), "mode", "route_short_name", 3, 5),
    """SELECT mode, route_short_name, count(*) AS cnt, row_number() OVER (PARTITION BY mode ORDER BY count(*) DESC, route_short_name)::INTEGER AS rank FROM delays
       WHERE mode IN (SELECT mode FROM delays GROUP BY 1 ORDER BY count(*) DESC, mode LIMIT 3) GROUP BY 1, 2 QUALIFY rank <= 5""")
add("o5_head", lambda f: f.delays().orderBy("actual_arrival", "trip_id", "stop_id").limit(5).select("trip_id", "stop_id", "delay"),
    "SELECT trip_id, stop_id, delay FROM delays ORDER BY actual_arrival, trip_id, stop_id LIMIT 5")
add("o6_chronological", lambda f: f.delays().orderBy("trip_id", "actual_arrival").select("trip_id", "actual_arrival", "stop_sequence"),
    "SELECT trip_id, actual_arrival, stop_sequence FROM delays ORDER BY 1, 2")

# windows on delays
add("w15_sample_per_day", lambda f: dd.sample_per_group(f.delays(), F.to_date("schedule_timestamp"), 100, ["trip_id", "stop_id", "stop_sequence"], seed=7)
    .select("trip_id", "actual_arrival", "schedule_timestamp").groupBy("schedule_timestamp").agg(F.count(F.lit(1)).alias("cnt")),
    "SELECT schedule_timestamp, least(count(*), 100) AS cnt FROM delays GROUP BY 1")
add("w15_sample_rows", lambda f: dd.sample_per_group(f.raw("events"), F.to_date("ts"), 50, ["event_id"], seed=7).select("event_id", "ts"),
    "SELECT event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY ts::DATE ORDER BY md5('7|' || event_id)) <= 50")
add("w16_latest_identity", lambda f: dd.latest_per_key(f.delays(), ["trip_id", "stop_id", "stop_name", "trip_headsign"], [F.col("load_timestamp").desc()])
    .select("trip_id", "stop_id", "stop_name", "trip_headsign", "load_timestamp", "delay"),
    """SELECT trip_id, stop_id, stop_name, trip_headsign, max(load_timestamp) AS load_timestamp, arg_max(struct_pack(d := delay), load_timestamp).d AS delay
       FROM delays GROUP BY 1, 2, 3, 4""")

# set operations
def _feeds(f: Feed):
    parts = {m: f.trips().filter(F.col("mode") == m).select("route_id", "service_id", "trip_headsign") for m in "AMT"}
    parts["T"] = parts["T"].withColumn("extra", F.lit("x"))
    return union_feeds(parts, "2024-02-01")


add("u1_union_feeds", _feeds,
    """SELECT DISTINCT route_id, service_id, trip_headsign, mode, CASE WHEN mode = 'T' THEN 'x' END AS extra, TIMESTAMP '2024-02-01' AS load_timestamp FROM trips""")
add("u2_union_realtime", lambda f: f.trip_updates().filter("mode = 'A'").unionByName(f.trip_updates().filter("mode = 'M'")).unionByName(f.trip_updates().filter("mode = 'T'"))
    .groupBy("mode").agg(F.count(F.lit(1)).alias("cnt"), F.count("arrival").alias("with_arrival")),
    "SELECT mode, count(*) AS cnt, count(arrival) AS with_arrival FROM trip_updates GROUP BY 1")
