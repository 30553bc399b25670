"""Feature table for delay modelling, its cleaned form and a balanced sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctualis.functions.geo import haversine_km
from punctualis.functions.text import slug, strip_diacritics, trip_key
from punctualis.functions.times import (
    day_cycle, elapsed_wrap, gtfs_seconds, normalize_time, parse_date, seconds_between, seconds_of_day, weekday_name,
)
from punctualis.operators.dedup import dedup_exact, latest_per_key, sample_per_group
from punctualis.operators.stats import reference_districts


def reference_points(districts: DataFrame) -> list[tuple[str, float, float]]:
    """(column suffix, latitude, longitude) of the reference districts.

    Each becomes a column of the feature table. A caller with a list of its own passes that instead.
    """
    named = reference_districts(districts).select(
        strip_diacritics(slug("district_name")).alias("name"), "latitude", "longitude"
    ).distinct()
    return [(r["name"], r["latitude"], r["longitude"]) for r in sorted(named.collect())]


def with_distances(df: DataFrame, references: Sequence[tuple[str, float, float]]) -> DataFrame:
    """One ``dist_<name>`` column in km per reference point."""
    return df.withColumns({f"dist_{n}": haversine_km("stop_lat", "stop_lon", lat, lon) for n, lat, lon in references})


def first_stops(stops: DataFrame) -> DataFrame:
    """Earliest row per full stop identity."""
    keys = ["stop_id", "stop_code", "stop_name", "stop_lat", "stop_lon", "mode"]
    return latest_per_key(stops, keys, [F.col("load_timestamp"), F.col("stop_desc")])


def _start_order():
    return F.struct("stop_sequence", (-F.unix_micros(F.col("load_timestamp").cast("timestamp"))).alias("age"))


def trip_start(stop_times: DataFrame) -> DataFrame:
    """Departure at the first stop per trip and mode (newest load on a tie)."""
    return stop_times.groupBy("trip_id", "mode").agg(F.min_by("departure_time", _start_order()).alias("trip_start_time"))


def latest_stop_times(stop_times: DataFrame) -> DataFrame:
    """Newest row per stop time content, with the start time of its trip.

    A trip's rows are dealt once; its start (as ``trip_start``), the newest rows and a join on trip and mode (``delay_base``) all use
    that. The window holds the stop times of one trip. Rows without a trip or mode have no start.
    """
    keys = ["trip_id", "arrival_time", "departure_time", "stop_id", "shape_dist_traveled", "mode"]
    known = F.col("trip_id").isNotNull() & F.col("mode").isNotNull()
    first = F.min_by("departure_time", _start_order()).over(Window.partitionBy("trip_id", "mode"))
    dealt = stop_times.repartition("trip_id", "mode").withColumn("trip_start_time", F.when(known, first))
    latest = latest_per_key(dealt, keys, [F.col("load_timestamp").desc(), F.col("stop_sequence")])
    return latest.select("trip_id", "mode", *[c for c in stop_times.columns if c not in ("trip_id", "mode")], "trip_start_time")


def between_loads(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows loaded between two moments, both included; no bound means no filter."""
    ts = F.col("load_timestamp")
    if first is not None:
        df = df.filter(ts >= F.lit(first).cast("timestamp_ntz"))
    return df if last is None else df.filter(ts <= F.lit(last).cast("timestamp_ntz"))


def delay_base(delays: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Delays with signed seconds, stop data and the elapsed time since the trip's start."""
    st = latest_stop_times(stop_times).select("trip_id", "stop_sequence", "mode", "shape_dist_traveled", "trip_start_time")
    places = first_stops(stops).select("stop_id", "mode", "stop_code", "stop_desc", "stop_lat", "stop_lon")
    joined = delays.join(st, ["trip_id", "stop_sequence", "mode"], "left").join(places, ["stop_id", "mode"], "left")
    start = normalize_time("trip_start_time", pad=True)
    return joined.select(
        "trip_id", "trip_headsign", "route_short_name", "mode", "stop_id", "stop_name", "stop_code", "stop_desc", "stop_lat", "stop_lon",
        "stop_sequence", "actual_arrival", "planned_arrival",
        seconds_between("planned_arrival", "actual_arrival").alias("delay_calc"),
        "shape_dist_traveled",
        start.alias("trip_start_time_cleaned"),
        elapsed_wrap(gtfs_seconds(start), seconds_of_day("actual_arrival")).alias("time_elapsed_seconds"),
        parse_date("event_date").alias("event_date"),
    )


def delay_delta(df: DataFrame, key: str = "unique_trip_key", value: str = "delay_calc") -> DataFrame:
    """Previous value of the run in stop order, and the change since then."""
    w = Window.partitionBy(key).orderBy("stop_sequence", "actual_arrival", "planned_arrival", "stop_id", "shape_dist_traveled", "stop_lat", "stop_lon")
    lagged = df.withColumn("delay_lag_1", F.lag(value).over(w))
    return lagged.withColumn("delay_delta", F.col(value) - F.col("delay_lag_1"))


def delay_features(
    delays: DataFrame,
    stop_times: DataFrame,
    stops: DataFrame,
    references: Sequence[tuple[str, float, float]],
    first: str | None = None,
    last: str | None = None,
    stops_first: str | None = None,
) -> DataFrame:
    """The feature table. Load ranges are optional; the stop range may start earlier."""
    base = delay_base(
        between_loads(delays, first, last), between_loads(stop_times, first, last), between_loads(stops, stops_first or first, last)
    )
    keyed = base.withColumn("unique_trip_key", trip_key(F.col("trip_id"), F.col("trip_headsign"), F.col("event_date"), F.col("mode")))
    timed = delay_delta(keyed).withColumn("weekday", weekday_name("actual_arrival")).withColumns(day_cycle("actual_arrival"))
    return with_distances(timed, references)


def clean_outliers(df: DataFrame, centre: str = "dist_Stare_Miasto") -> DataFrame:
    """Keep plausible rows; a missing value fails its test."""
    return df.filter(
        (F.col("time_elapsed_seconds") < 7200)
        & F.col("delay_calc").between(-600, 3600)
        & F.col("delay_lag_1").between(-600, 3600)
        & (F.col(centre) < 50)
    )


def clean_features(df: DataFrame, centre: str = "dist_Stare_Miasto") -> DataFrame:
    """Distinct plausible rows with a travelled distance, without the sparse stop columns."""
    kept = clean_outliers(dedup_exact(df), centre)
    return kept.dropna(subset=["shape_dist_traveled"]).drop("stop_code", "stop_desc")


def near_and_punctual(df: DataFrame, distance_cols: Sequence[str], km: float = 50, minutes: float = 10) -> DataFrame:
    """Rows with a small delay and all distances in range."""
    cond = F.col("delay") <= minutes
    for c in distance_cols:
        cond = cond & (F.col(c) <= km)
    return df.filter(cond)


def sample_delays(delays: DataFrame, stops: DataFrame, stop_times: DataFrame, n: int = 6000, seed: int = 0) -> DataFrame:
    """At most ``n`` random delay rows per schedule day, with stop and distance data."""
    sampled = sample_per_group(delays, F.to_date("schedule_timestamp"), n, ["trip_id", "stop_id", "mode", "event_date"], seed)
    places = stops.select("stop_id", "mode", "stop_name", "stop_lat", "stop_lon")
    times = stop_times.select("stop_id", "trip_id", "stop_sequence", "mode", "shape_dist_traveled")
    joined = sampled.join(places, ["stop_id", "mode", "stop_name"], "left").join(times, ["stop_id", "trip_id", "stop_sequence", "mode"], "left")
    keys = ["trip_id", "stop_id", "stop_name", "trip_headsign", "planned_arrival"]
    order = [F.col("load_timestamp").desc()] + [F.col(c) for c in ("mode", "event_date", "stop_lat", "stop_lon", "shape_dist_traveled")]
    return latest_per_key(joined, keys, order).select(*delays.columns, "stop_lat", "stop_lon", "shape_dist_traveled")
