import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctualis.operators import dedup, joins, nearest, prefix, scd2, stats


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = dedup.latest_per_key(df, ["k"], [F.col("v").desc()])
    assert plan_of(out).count("WindowGroupLimit") == 2
    assert sorted(rows(out)) == [(k, max(v for v in range(1000) if v % 7 == k)) for k in range(7)]


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert rows(dedup.duplicate_report(df)) == [(3, 2, 1)]
    assert dedup.dedup_exact(df).count() == 2
    assert rows(dedup.duplicate_report(df.limit(0))) == [(0, 0, 0)]


def test_sample_is_whole_bounded_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") < 4990, 0).otherwise(1).alias("g"))
    sample = lambda: dedup.sample_per_group(df, F.col("g"), 100, ["id"], seed=5)
    counts = dict(rows(sample().groupBy("g").count()))
    assert counts == {0: 100, 1: 10}
    assert sorted(rows(sample())) == sorted(rows(sample()))
    other = dedup.sample_per_group(df, F.col("g"), 100, ["id"], seed=6)
    assert sorted(rows(other)) != sorted(rows(sample()))


def test_scd2_join_bounds(spark):
    fact = spark.sql("select * from values ('r', timestamp_ntz'2024-01-10'), ('r', timestamp_ntz'2024-01-09 23:59:59'), ('x', timestamp_ntz'2024-01-01') t(k, ts)")
    dim = spark.sql(
        "select * from values ('r', 1, timestamp_ntz'1900-01-01', timestamp_ntz'2024-01-10'), ('r', 2, timestamp_ntz'2024-01-10', null) t(k, v, valid_from, valid_to)"
    )
    out = joins.join_scd2(fact, dim, ["k"], "ts")
    assert sorted((str(r["ts"]), r["v"]) for r in out.collect()) == [("2024-01-09 23:59:59", 1), ("2024-01-10 00:00:00", 2)]


@pytest.mark.parametrize("chunk", ["minute", "hour", "year"])
def test_sessions_equal_plain_loop(spark, chunk):
    rng = random.Random(4)
    data = [(rng.choice("ab") if rng.random() < 0.7 else None, "A", rng.randrange(20), 1704067200 + rng.randrange(40000)) for _ in range(600)]
    df = spark.createDataFrame(data, "trip_id string, mode string, stop_sequence int, e long").withColumn("load_timestamp", F.timestamp_seconds("e").cast("timestamp_ntz"))
    got = prefix.sessionize_resets(df, chunk=chunk).select("trip_id", "e", "stop_sequence", "change_indicator", "session_id")
    want, state = [], {}
    for trip, _, seq, e in sorted(data, key=lambda r: (r[0] or "", r[3], r[2])):
        last, session = state.get(trip, (None, 0))
        fell = int(last is not None and seq < last)
        state[trip] = (seq, session + fell)
        want.append((trip, e, seq, fell, session + fell))
    key = lambda r: (r[0] or "", *r[1:])
    assert sorted(rows(got), key=key) == sorted(want, key=key)


def test_asof_join_over_a_long_history(spark):
    """Ten thousand versions of one route, gaps and open ends, against a binary search; overlaps against the definition."""
    import bisect
    from datetime import datetime, timedelta

    pick, zero = random.Random(4), datetime(2024, 1, 1)
    starts = sorted(pick.sample(range(3_000_000), 10_000))
    versions = [("hot", zero + timedelta(seconds=s), zero + timedelta(seconds=e if pick.random() < 0.9 else (s + e) / 2) if e else None, n) for n, (s, e) in enumerate(zip(starts, [*starts[1:], None]))]
    versions += [("over", zero, None, -1), ("over", zero + timedelta(days=1), zero + timedelta(days=3), -2), ("over", zero + timedelta(days=1), zero + timedelta(days=2), -3), (None, zero, None, -4)]
    facts = [("hot", zero + timedelta(seconds=pick.randrange(-1000, 3_100_000)), i) for i in range(3000)] + [("over", zero + timedelta(hours=12 * h), 5000 + h) for h in range(8)]
    facts += [(None, zero, 1), ("hot", None, 2), ("none", zero, 3), facts[0]] + [("hot", versions[7][1], 4)]
    v = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, n int")
    f = spark.createDataFrame(facts, "k string, ts timestamp_ntz, id int")
    want, hot = [], [x[1] for x in versions[:10_000]]
    for k, t, i in facts:
        if k == "hot" and t is not None and (at := bisect.bisect_right(hot, t) - 1) >= 0 and (versions[at][2] is None or t < versions[at][2]):
            want.append((i, versions[at][3]))
        if k == "over":
            want += [(i, -1)] if t < zero + timedelta(days=1) else [(i, -2)] if t < zero + timedelta(days=3) else []
    got = joins.join_asof(f, v, ["k"], "ts")
    assert got.columns == ["k", "ts", "id", "valid_from", "valid_to", "n"]
    assert sorted((r.id, r.n) for r in got.collect()) == sorted(want)
    single = v.filter("k = 'hot' AND n >= 9000")
    late = f.filter("k = 'hot'")
    assert sorted(rows(joins.join_asof(late, single, ["k"], "ts", "hour", 2)), key=str) == sorted(rows(joins.join_scd2(late, single, ["k"], "ts")), key=str)


@pytest.mark.parametrize("shape", ["even", "crowded", "far apart"])
def test_chunks_follow_the_data(spark, monkeypatch, shape):
    """Chunks stay near their size at ten times the data, keep the order, and NaN and infinity come last."""
    monkeypatch.setattr(prefix, "CHUNK_VALUES", 50)
    pick = np.random.default_rng(8)
    for n in (400, 4000):
        values = {"even": pick.permutation(n) - n / 2, "crowded": pick.lognormal(0, 2, n), "far apart": np.r_[pick.permutation(n) * 1e-3, 1e300, -1e308]}[shape]
        values = [*values.tolist(), float("nan"), float("inf"), float("-inf")]
        df = spark.createDataFrame([(x,) for x in values], "v double")
        got = prefix.cumulative_counts(df, "v").collect()
        order = sorted(values, key=lambda x: (x != x, x))
        assert sorted((r.below for r in got)) == list(range(len(values)))
        assert all(order[r.below] == r.v or r.v != r.v and r.below == len(values) - 1 for r in got) and {r.total for r in got} == {len(values)}
        cut = prefix.cut_evenly(df.select("v", F.struct(F.lit(0)).alias("_chunk")), "v").groupBy("_chunk").count()
        assert cut.agg(F.max("count")).first()[0] <= 50 * 4 and cut.count() >= n / 50 / 2


def test_cumulative_counts_and_quantiles_against_numpy(spark):
    rng = random.Random(1)
    data = [("hot", rng.gauss(0, 5)) for _ in range(3000)] + [("few", float(v)) for v in (1, 1, 2)] + [(None, 7.0), ("few", None)]
    df = spark.createDataFrame(data, "g string, v double")
    counts = {(r["g"], r["v"]): (r["cnt"], r["below"], r["total"]) for r in prefix.cumulative_counts(df, "v", ["g"]).collect()}
    hot = sorted(v for g, v in data if g == "hot")
    assert all(counts["hot", v][1] == sum(x < v for x in hot) for v in hot[::97])
    assert counts["few", 1.0] == (2, 0, 3) and counts["few", 2.0] == (1, 2, 3) and counts[None, 7.0] == (1, 0, 1)
    q = {r["g"]: (r["a"], r["b"]) for r in prefix.exact_quantiles(df, "v", {"a": 0.25, "b": 0.99}, ["g"]).collect()}
    assert np.allclose(q["hot"], np.quantile(hot, [0.25, 0.99]))
    assert np.allclose(q["few"], np.quantile([1, 1, 2], [0.25, 0.99])) and q[None] == (7.0, 7.0)


def test_scd2_versions(spark):
    load = lambda day, data: spark.createDataFrame(data, "k string, a string, b int").withColumn("load_timestamp", F.lit(day).cast("timestamp_ntz"))
    first = load("2024-01-01", [("same", "x", 1), ("null", None, 1), ("gone", "z", 1), ("chg", "p", 1)])
    second = load("2024-02-01", [("same", "x", 1), ("null", "now", 1), ("chg", "q", 1), ("new", "n", 1)])
    t1 = scd2.scd2_merge(scd2.scd2_empty(first), first, ["k"])
    t2 = scd2.scd2_merge(t1, first.unionByName(second), ["k"])
    short = lambda df: sorted((r["k"], r["a"] or "", str(r["valid_from"])[:10], str(r["valid_to"])[:10], r["is_current"]) for r in df.collect())
    want = [
        ("chg", "p", "1900-01-01", "2024-02-01", False), ("chg", "q", "2024-02-01", "None", True), ("gone", "z", "1900-01-01", "None", True),
        ("new", "n", "1900-01-01", "None", True), ("null", "", "1900-01-01", "2024-02-01", False), ("null", "now", "2024-02-01", "None", True),
        ("same", "x", "1900-01-01", "None", True),
    ]
    assert short(t2) == want
    assert short(scd2.scd2_merge(t2, second, ["k"])) == want
    current = t2.filter("is_current").groupBy("k").count().agg(F.max("count")).first()[0]
    assert current == 1
    with pytest.raises(ValueError):
        scd2.scd2_merge(t2.select("k", "load_timestamp", "valid_from", "valid_to", "is_current"), first.select("k", "load_timestamp"), ["k"])


def test_nearest_tree_equals_brute_force(spark):
    from math import asin, cos, radians, sin, sqrt

    rng = random.Random(9)
    spot = lambda: (rng.uniform(-80, 80), rng.uniform(-180, 180)) if rng.random() < 0.5 else (50 + rng.random() / 10, 19.9 + rng.random() / 10)
    centres = [(f"c{i:04d}", *spot()) for i in range(900)]
    points = [(i, *spot()) for i in range(150)] + [(999, None, 1.0)]
    cdf = spark.createDataFrame(centres, "centre string, lat double, lon double")
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")

    def dist(a, b, c, d):
        a, b, c, d = map(radians, (a, b, c, d))
        return 2 * asin(min(1.0, sqrt(sin((c - a) / 2) ** 2 + cos(a) * cos(c) * sin((d - b) / 2) ** 2)))

    want = {i: min((dist(a, b, c, d), n) for n, c, d in centres)[1] if a is not None else None for i, a, b in points}
    tree = nearest.nearest(pdf, cdf, leaf_centres=8)
    assert {r["id"]: r["centre"] for r in tree.collect()} == want


def test_kruskal_known_values(spark):
    # a classic textbook example without ties and one with ties
    data = [("a", v) for v in (1, 3, 5, 7, 9)] + [("b", v) for v in (2, 4, 6, 8, 10)]
    df = spark.createDataFrame([(g, g, v) for g, v in data], "f string, same string, v int").withColumn("same", F.lit("one"))
    out = {r["feature"]: r for r in stats.kruskal_by(df, "v", ["f"]).collect()}["f"]
    assert abs(out["h"] - 0.27272727) < 1e-6 and abs(out["p"] - 0.60150814) < 1e-6
    tied = spark.createDataFrame([("x", 1), ("x", 1), ("x", 1), ("y", 2), ("y", 2), ("y", 2), ("z", 2), ("z", 2)], "f string, v int")
    out = stats.kruskal_by(tied, "v", ["f"]).first()
    assert abs(out["h"] - 7.0) < 1e-9 and abs(out["p"] - 0.0301973834) < 1e-8


def test_chi_square_tail(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (18.307038053275146, 10), (0.0, 3), (200.0, 4)], "x double, k int")
    got = [r[0] for r in df.select(stats.chi_square_tail(F.col("x"), F.col("k"))).collect()]
    assert abs(got[0] - 0.05) < 1e-10 and abs(got[1] - 0.05) < 1e-10 and got[2] == 1.0 and 0 < got[3] < 1e-40


def test_centroid_with_hole_and_parts(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    shapes = [("hole", 0, 0, square(0, 0, 4)), ("hole", 0, 1, square(2, 2, 2)), ("two", 0, 0, square(0, 0, 2)), ("two", 1, 0, square(10, 0, 2)), ("flat", 0, 0, [(0, 0), (1, 1), (0, 0)])]
    data = [(n, p, r, i, float(x), float(y)) for n, p, r, pts in shapes for i, (x, y) in enumerate(pts)]
    out = stats.polygon_centroid(spark.createDataFrame(data, "name string, part int, ring int, pos int, lon double, lat double"))
    got = {r["name"]: (r["longitude"], r["latitude"]) for r in out.collect()}
    assert got == {"hole": (1.666667, 1.666667), "two": (6.0, 1.0), "flat": (None, None)}


def test_small_statistics(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (5, "b"), (None, "b")], "delay int, mode string")
    assert rows(stats.on_time_rate(df)) == [(0.5, 0.25)]
    assert sorted(rows(stats.missing_report(df))) == [("delay", 1, 25.0), ("mode", 0, 0.0)]
    assert [r["cnt"] for r in stats.histogram(df, "delay", 5).orderBy("bin").collect()] == [1, 1, 0, 0, 1]
    same = spark.createDataFrame([(3,), (3,)], "v int")
    assert [r["cnt"] for r in stats.histogram(same, "v", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_scd2_null_keys_and_older_loads(spark):
    from punctualis.operators import scd2

    load = lambda day, rows: spark.createDataFrame(rows, "k string, m string, v string").withColumn("load_timestamp", F.lit(day).cast("timestamp_ntz"))
    first = load("2024-01-02", [(None, "A", "x"), ("a", None, "y"), ("b", "B", "z")])
    target = scd2.scd2_merge(scd2.scd2_empty(first), first, ["k", "m"])
    assert target.count() == 3
    assert scd2.scd2_merge(target, first, ["k", "m"]).count() == 3
    changed = scd2.scd2_merge(target, load("2024-01-05", [(None, "A", "new"), ("b", "B", "z")]), ["k", "m"])
    assert changed.count() == 4 and changed.filter("is_current").count() == 3
    assert changed.filter("valid_to IS NOT NULL AND valid_to < valid_from").count() == 0
    older = scd2.scd2_merge(changed, load("2024-01-03", [(None, "A", "old")]), ["k", "m"])
    assert sorted(map(str, older.collect())) == sorted(map(str, changed.collect()))
    up = scd2.upsert(first, load("2024-01-06", [(None, "A", "u")]), ["k", "m"])
    assert sorted(r.v for r in up.collect()) == ["u", "y", "z"]


def test_kruskal_p_of_every_feature(spark, sf_dir):
    import math

    from catalogue import statistics

    def tail(h, dof, steps=40_000):
        """Simpson's rule over the density of the chi-square distribution."""
        a, low = dof / 2, h / 2
        width = (200 + 20 * a) / steps
        density = lambda z: math.exp((a - 1) * math.log(z) - z - math.lgamma(a)) if z > 0 else 0.0
        return width / 3 * sum((1 if i in (0, steps) else 4 if i % 2 else 2) * density(low + i * width) for i in range(steps + 1))

    h = {r.feature: (r.groups, r.h) for r in statistics.QUERIES["a18_kruskal"](spark, sf_dir).collect()}
    p = {r.feature: (r.groups, r.p) for r in statistics.QUERIES["a18_kruskal_p_all"](spark, sf_dir).collect()}
    assert set(p) == {"mode", "route_short_name", "stop_sequence"}
    for feature, (groups, value) in p.items():
        assert groups == h[feature][0]
        assert abs(value - tail(h[feature][1], groups - 1)) < 2e-5


@pytest.mark.parametrize("count, leaf", [(0, 8), (1, 8), (50, 4), (30_000, 64)])
def test_nearest_of_many_equals_brute_force(spark, count, leaf):
    """Crowded and scattered centres, both sides of the date line and the poles, copies, NULL places."""
    pick = np.random.default_rng(6)
    lat = np.r_[50 + pick.normal(size=count - count // 4) * 0.05, pick.uniform(-90, 90, count // 4)]
    lon = np.r_[20 + pick.normal(size=count - count // 4) * 0.05, pick.uniform(-180, 180, count // 4)]
    centres = [(f"c{i:06d}", float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
    centres += [("copy", *centres[0][1:]), ("none", None, 1.0)] if count else []
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(pick.uniform(-90, 90, 60), pick.uniform(-180, 180, 60)))]
    points += [(100 + i, 50 + float(x), 20 - float(x)) for i, x in enumerate(pick.normal(size=60) * 0.05)] + [(200, 0.0, 180.0), (201, 0.0, -180.0), (202, 90.0, 5.0), (203, None, 1.0), (0, *points[0][1:])]
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")
    cdf = spark.createDataFrame(centres, "centre string, lat double, lon double")
    got = nearest.nearest_of_many(pdf, cdf, leaf).collect()
    assert sorted(r.id for r in got) == sorted(p[0] for p in points)
    names, place = [c[0] for c in centres if c[1] is not None], np.radians([c[1:] for c in centres if c[1] is not None]).reshape(-1, 2)
    for r in got:
        if r.lat is None or not count:
            assert r.centre is None
            continue
        a, b = np.radians(r.lat), np.radians(r.lon)
        h = np.sin((place[:, 0] - a) / 2) ** 2 + np.cos(a) * np.cos(place[:, 0]) * np.sin((place[:, 1] - b) / 2) ** 2
        best = h.min()
        assert abs(2 * 6371008.8 * np.arcsin(np.sqrt(best)) - r.distance_m) < 1e-3 and h[names.index(r.centre)] <= best + 1e-15
