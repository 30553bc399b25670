"""Delay statistics: grouped aggregates, exact quantiles, correlations and rank tests."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import with_scalar
from punctualis.operators.prefix import cumulative_counts, exact_quantiles

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

AGGREGATES = {"count": F.count, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp, "sum": F.sum}


def delay_by(df: DataFrame, group: Column | str, stats: Sequence[str] = ("mean",), value: str = "delay") -> DataFrame:
    """Statistics of a value per group: any of count, mean, min, max, std, sum, median."""
    key = F.col(group) if isinstance(group, str) else group
    keyed = df.select(key.alias("grp"), F.col(value).alias("v"))
    plain = keyed.groupBy("grp").agg(*[AGGREGATES[s]("v").alias(s) for s in stats if s != "median"] or [F.count(F.lit(1)).alias("_n")])
    if "median" in stats:
        medians = exact_quantiles(keyed, "v", {"median": 0.5}, ["grp"])
        plain = plain.join(medians.withColumnRenamed("grp", "_g"), F.col("grp").eqNullSafe(F.col("_g")), "left")
    return plain.select("grp", *stats)


def rank_groups(df: DataFrame, group: str, stat: str, n: int, value: str = "delay") -> DataFrame:
    """Top ``n`` groups by a statistic, largest first, ties by group name."""
    scored = delay_by(df, group, [stat], value).withColumnRenamed("grp", group)
    return scored.filter(F.col(stat).isNotNull()).orderBy(F.col(stat).desc(), F.col(group).asc()).limit(n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-missing value."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def top_k(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    return value_counts(df, col).orderBy(F.col("cnt").desc(), F.col(col).asc()).limit(n)


def top_k_per_group(df: DataFrame, group: str, col: str, n_groups: int, n: int) -> DataFrame:
    """The ``n`` most frequent values of ``col`` inside each of the most frequent groups."""
    counted = df.filter(F.col(group).isNotNull() & F.col(col).isNotNull()).groupBy(group, col).agg(F.count(F.lit(1)).alias("cnt"))
    kept = counted.join(top_k(df, group, n_groups).select(group), group, "left_semi")
    w = Window.partitionBy(group).orderBy(F.col("cnt").desc(), F.col(col).asc())
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def weekday_hour_matrix(df: DataFrame, ts: str = "actual_arrival", value: str = "delay") -> DataFrame:
    """Mean per weekday (rows, Monday first) and hour (columns h0 to h23)."""
    keyed = df.select(F.date_format(ts, "EEEE").alias("weekday"), F.weekday(ts).alias("_no"), F.hour(ts).alias("_h"), F.col(value).alias("v"))
    matrix = keyed.groupBy("weekday", "_no").pivot("_h", list(range(24))).agg(F.avg("v"))
    return matrix.orderBy("_no").select("weekday", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def on_time_rate(df: DataFrame, value: str = "delay", early: float = -1, late: float = 2) -> DataFrame:
    """Shares of all rows that are on time and late; rows without a value count in the base."""
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    v = F.col(value)
    return df.agg(share(v.between(early, late)).alias("on_time"), share(v > late).alias("late"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    long = _unpivot(df, cols)
    basic = long.groupBy("feature").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    quartiles = exact_quantiles(long, "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["feature"])
    return basic.join(quartiles, "feature", "left").select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage per column, from one pass over the table."""
    cols = list(cols or df.columns)
    counts = [F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    long = row.unpivot(["_rows"], cols, "column", "missing")
    return long.select("column", "missing", (F.col("missing") * 100.0 / F.col("_rows")).alias("percent"))


def trim_quantiles(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies between two exact quantiles, both ends included."""
    bounds = exact_quantiles(df, col, {"_low": low, "_high": high})
    return with_scalar(df, bounds).filter(F.col(col).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes the maximum."""
    bounds = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = with_scalar(df.select(col), bounds).filter(F.col(col).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    grid = bounds.select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"),
    )


def box_stats(df: DataFrame, value: str, groups: Sequence[str] = (), whiskers: tuple[float, float] | None = None) -> DataFrame:
    """Quartiles, whisker ends and number of points beyond them, per group.

    Whiskers reach the outermost values within 1.5 interquartile ranges, or within the two given
    quantiles.
    """
    groups = list(groups)
    ranked = cumulative_counts(df, value, groups)
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if whiskers is not None:
        probs |= {"_lo": whiskers[0], "_hi": whiskers[1]}
    boxes = exact_quantiles(df, value, probs, groups, ranked)
    if whiskers is None:
        reach = 1.5 * (F.col("q3") - F.col("q1"))
        boxes = boxes.withColumns({"_lo": F.col("q1") - reach, "_hi": F.col("q3") + reach})
    cond = [F.col(f"r.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups] or [F.lit(True)]
    if not groups:
        boxes = F.broadcast(boxes)
    joined = ranked.alias("r").join(boxes.alias("b"), cond, "inner")
    inside = F.col(f"r.{value}").between(F.col("_lo"), F.col("_hi"))
    keys = [F.col(f"b.{g}").alias(g) for g in groups]
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(f"r.{value}"))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(f"r.{value}"))).cast("double").alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("cnt"))).alias("outliers"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs (rows where both are present), in one pass."""
    cols = list(cols)
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    entries = []
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`")
        entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), value.alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), value.alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def corr_with(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlations of one column with the others, strongest positive first."""
    row = df.agg(*[F.corr(F.col(target).cast("double"), F.col(c).cast("double")).alias(c) for c in cols])
    long = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols])))
    return long.orderBy(F.col("corr").desc_nulls_last(), "feature")


def kruskal_by(df: DataFrame, value: str, features: Sequence[str]) -> DataFrame:
    """Kruskal-Wallis H, groups, rows and p of a value across the levels of each feature.

    All features run in one pass over (feature, level, value) counts. Average ranks come from the
    cumulative counts of the distinct values of a feature, so no global sort of the rows is needed.
    """
    levels = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level")) for f in features])
    long = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("v"), F.inline(levels)).filter(F.col("level").isNotNull())
    cells = long.groupBy("feature", "level", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = cumulative_counts(cells, "v", ["feature"], weight="n").withColumn("rank", F.col("below") + (F.col("cnt") + 1) / 2)
    ties = ranked.groupBy("feature").agg(
        F.max("total").alias("rows"), F.sum(F.pow(F.col("cnt"), 3) - F.col("cnt")).alias("_ties")
    )
    sums = (
        cells.join(ranked.select("feature", "v", "rank"), ["feature", "v"])
        .groupBy("feature", "level")
        .agg(F.sum(F.col("n") * F.col("rank")).alias("_r"), F.sum("n").alias("_n"))
        .groupBy("feature")
        .agg(F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_s"), F.count(F.lit(1)).alias("groups"))
    )
    n = F.col("rows").cast("double")
    raw = 12 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    correction = 1 - F.col("_ties") / (F.pow(n, F.lit(3)) - n)
    tested = sums.join(ties, "feature").select("feature", "groups", "rows", F.when(correction > 0, raw / correction).alias("h"))
    return tested.withColumn("p", chi_square_tail(F.col("h"), F.col("groups") - 1))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution, in Arrow batches (a handful of rows per use)."""
    @F.pandas_udf("double")
    def tail(h: pd.Series, k: pd.Series) -> pd.Series:
        import math

        def upper(v, n):
            if v is None or v != v or n is None or n < 1:
                return None
            a, z = n / 2.0, v / 2.0
            if z <= 0:
                return 1.0
            front = math.exp(a * math.log(z) - z - math.lgamma(a))
            if z < a + 1:
                term = total = 1.0 / a
                step = a
                while abs(term) > abs(total) * 1e-16:
                    step += 1.0
                    term *= z / step
                    total += term
                return max(0.0, 1.0 - front * total)
            # continued fraction of the upper incomplete gamma function (modified Lentz)
            b = z + 1.0 - a
            c, d = 1e300, 1.0 / b
            frac = d
            for i in range(1, 100000):
                num = -i * (i - a)
                b += 2.0
                d = 1.0 / (num * d + b)
                c = b + num / c
                frac *= c * d
                if abs(c * d - 1.0) < 1e-15:
                    break
            return front * frac

        return pd.Series([upper(v, n) for v, n in zip(h, k)], dtype="float64")

    return tail(x.cast("double"), dof.cast("double"))


def kde(df: DataFrame, col: str, grid: int = 200) -> DataFrame:
    """Gaussian density at ``grid`` even points from minimum to maximum (Scott bandwidth).

    Works on the counts of distinct values, in one pass with one sum per grid point, so no row is repeated and
    the shuffle carries one row per task.
    """
    counted = value_counts(df, col)
    scale = df.agg(
        F.count(col).alias("_n"), F.stddev_samp(col).alias("_sd"), F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi")
    ).withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))

    def at(point: Column) -> Column:
        return F.col("_lo") + point * (F.col("_hi") - F.col("_lo")) / (grid - 1)

    def density(point: int) -> Column:
        z = (at(F.lit(point)) - F.col(col)) / F.col("_h")
        weight = F.col("cnt") * F.exp(-0.5 * z * z) / (F.col("_n") * F.col("_h") * F.sqrt(F.lit(2 * 3.141592653589793)))
        return F.sum(weight)

    sums = with_scalar(counted, scale).groupBy("_lo", "_hi").agg(F.array(*[density(i) for i in range(grid)]).alias("_sums"))
    points = sums.select("_lo", "_hi", F.posexplode("_sums").alias("point", "density"))
    return points.select("point", at(F.col("point")).alias("x"), "density")


def reference_districts(districts: DataFrame) -> DataFrame:
    """Rows at the extreme longitudes and latitudes, and district 1; a row can appear more than once."""
    edge = districts.agg(
        F.min("longitude").alias("_w"), F.max("longitude").alias("_e"), F.min("latitude").alias("_s"), F.max("latitude").alias("_n")
    )
    tests = [
        ("west", F.col("longitude") == F.col("_w")),
        ("east", F.col("longitude") == F.col("_e")),
        ("south", F.col("latitude") == F.col("_s")),
        ("north", F.col("latitude") == F.col("_n")),
        ("centre", F.col("district_number") == 1),
    ]
    roles = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in tests]))
    return with_scalar(districts, edge).select(*districts.columns, F.explode(roles).alias("role"))


def high_water(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Newest day per key."""
    return df.groupBy(key).agg(F.max(F.to_date(ts)).alias("last_day"))


def polygon_centroid(points: DataFrame) -> DataFrame:
    """Area-weighted centroid per ``name`` from (name, part, ring, pos, lon, lat), 6 decimals.

    Rings are closed. Ring 0 of a part is its outline, further rings are holes. Edges are found by
    an equi join on the next position, so a huge ring is spread over many tasks.
    """
    key = ["name", "part", "ring"]
    anchor = points.agg(F.min("lon").alias("_x0"), F.min("lat").alias("_y0"))
    local = with_scalar(points, anchor).withColumns({"_x": F.col("lon") - F.col("_x0"), "_y": F.col("lat") - F.col("_y0")})
    following = local.select(*key, (F.col("pos") - 1).alias("pos"), F.col("_x").alias("_x2"), F.col("_y").alias("_y2"))
    edges = local.join(following, [*key, "pos"], "inner")
    cross = F.col("_x") * F.col("_y2") - F.col("_x2") * F.col("_y")
    rings = edges.groupBy(*key, "_x0", "_y0").agg(
        (F.sum(cross) / 2).alias("_a"),
        (F.sum((F.col("_x") + F.col("_x2")) * cross) / 6).alias("_mx"),
        (F.sum((F.col("_y") + F.col("_y2")) * cross) / 6).alias("_my"),
    )
    sign = F.when(F.col("ring") == 0, 1).otherwise(-1) * F.signum("_a")
    total = F.sum(sign * F.col("_a"))
    mean = lambda moment: F.when(total != 0, F.sum(sign * F.col(moment)) / total)
    return rings.groupBy("name").agg(
        F.round(F.max("_y0") + mean("_my"), 6).alias("latitude"),
        F.round(F.max("_x0") + mean("_mx"), 6).alias("longitude"),
    )


def _unpivot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols]
    return df.select(F.inline(F.array(*cells)))
