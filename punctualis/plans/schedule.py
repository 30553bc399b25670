"""Planned schedule: trip x stop x date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctualis.functions.times import date_text, is_night, normalize_time, parse_date
from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import join_scd2, with_scalar
from punctualis.plans.calendar import latest_calendar

VERSION = ["mode", "load_timestamp"]
SALTS = 32
COLUMNS = [
    "trip_id", "mode", "route_short_name", "arrival_time", "stop_sequence", "shape_dist_traveled", "trip_headsign",
    "stop_name", "stop_id", "stop_lat", "stop_lon", "event_date", "is_night_trip", "load_timestamp",
]


def trip_days(trips: DataFrame, routes_scd2: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips with their route version and the list of service dates (``days``) of their service.

    The dates stay an array (one service's days) until the stop times are joined, so the large join does
    not carry one row per date. A few services run most trips, so the key is salted: trips are spread over
    ``SALTS`` parts and each service's one row is repeated for every part. A version of a trip counts once,
    even when its feed was loaded twice.
    """
    dates = calendar.groupBy("service_id", *VERSION).agg(F.sort_array(F.collect_set("event_date")).alias("days"))
    dates = dates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    unique = latest_per_key(
        trips.select("trip_id", "route_id", "service_id", "trip_headsign", *VERSION),
        ["trip_id", *VERSION],
        [F.col("route_id"), F.col("service_id"), F.col("trip_headsign")],
    )
    routed = join_scd2(
        unique,
        routes_scd2.select("route_id", "mode", "route_short_name", "valid_from", "valid_to"),
        ["route_id", "mode"],
        "load_timestamp",
    )
    routed = routed.withColumn("_salt", F.pmod(F.hash("trip_id"), F.lit(SALTS)))
    return routed.join(dates, ["service_id", *VERSION, "_salt"], "inner").select(
        "trip_id", *VERSION, "trip_headsign", "route_short_name", "days"
    )


def _on_day(day: Column) -> Column:
    return date_text(parse_date(day))


def _on_next_day(day: Column) -> Column:
    return date_text(F.date_add(parse_date(day), 1))


def build_trips_schedule(
    stop_times: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    routes_scd2: DataFrame,
    calendar: DataFrame,
    all_services: bool = False,
    planned_days: DataFrame | None = None,
) -> DataFrame:
    """The schedule mart. ``calendar`` is the result of ``expand_calendar``.

    A stop visited twice by a trip keeps its first visit. Since every mode and date has one load
    version, that choice does not depend on the date and is made before the dates are added.
    Stop times of load versions that no date uses are cut before their first shuffle: the used versions,
    one value per mode and load, travel as one row.
    ``planned_days`` (column ``planned_day``, dates) builds exactly the rows of these calendar dates: service dates that
    reach none of them are cut from the calendar, so their rows and load versions never arise.
    """
    chosen = latest_calendar(calendar, stop_times, all_services)
    if planned_days is not None:
        texts = planned_days.select(date_text("planned_day").alias("day"), date_text(F.date_sub("planned_day", 1)).alias("before"))
        wanted = texts.agg(F.collect_set("day").alias("_wanted"), F.collect_set("before").alias("_before"))
        reaching = F.array_contains("_wanted", F.col("event_date")) | F.array_contains("_before", F.col("event_date"))
        chosen = with_scalar(chosen, wanted).filter(reaching).drop("_wanted", "_before")
    used = chosen.agg(F.collect_set(F.struct(*VERSION)).alias("_used"))
    served = with_scalar(stop_times, used).filter(F.array_contains("_used", F.struct(*VERSION))).drop("_used")
    days = trip_days(trips, routes_scd2, chosen)
    visits = served.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "shape_dist_traveled", *VERSION)
    places = latest_per_key(
        stops.filter(F.col("stop_name").isNotNull()).select("stop_id", *VERSION, "stop_name", "stop_lat", "stop_lon"),
        ["stop_id", *VERSION],
        [F.col("stop_name"), F.col("stop_lat"), F.col("stop_lon")],
    )
    # a stop's place does not depend on the visit, so it is attached first; from here on all rows of a trip stay together
    placed = visits.join(places, ["stop_id", *VERSION], "inner").repartition("trip_id", "mode")
    visits = latest_per_key(placed, ["trip_id", "stop_id", *VERSION], [F.col("stop_sequence"), F.col("arrival_time")])
    # times and dates are read once per visit and service, not once per row of the schedule
    visits = visits.withColumns({"arrival_time": normalize_time("arrival_time"), "is_night_trip": is_night("arrival_time")})
    both = F.struct(F.transform("days", _on_day).alias("early"), F.transform("days", _on_next_day).alias("late"))
    days = days.withColumn("_dates", both).drop("days")
    planned = visits.join(days, ["trip_id", *VERSION], "inner")
    dates = F.when(F.col("is_night_trip"), F.col("_dates.late")).otherwise(F.col("_dates.early"))
    schedule = planned.withColumn("event_date", F.explode(dates)).select(*COLUMNS)
    if planned_days is None:
        return schedule
    return with_scalar(schedule, wanted.select("_wanted")).filter(F.array_contains("_wanted", F.col("event_date"))).select(*COLUMNS)
