"""Delays per stop and stop-to-stop vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctualis.functions.text import vector_id
from punctualis.functions.times import at_least_zero, epoch_to_local, gtfs_hour, minutes_between, parse_date, planned_timestamp
from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import match_midnight, midnight_days

RUN = ["trip_id", "mode", "event_date"]
QUARTER = 900  # local clocks differ from UTC by whole quarters of an hour


def latest_updates(updates: DataFrame, by_sequence: bool = False, days: tuple[str, str] | None = None) -> DataFrame:
    """Newest prediction per trip, mode, stop and local date, with its local time.

    ``by_sequence`` keeps repeated visits of a stop apart. ``days`` (first and last service date,
    ``yyyyMMdd``) cuts the log before the shuffle to the dates that can match, one day around them.
    """
    actual = epoch_to_local(F.coalesce("arrival", "departure"))
    local = updates.select("trip_id", "mode", "stop_id", "stop_sequence", "load_timestamp", actual.alias("actual_arrival"))
    local = local.withColumn("actual_day", F.to_date("actual_arrival"))
    if days is not None:
        first, last = (parse_date(F.lit(d)) for d in days)
        local = local.filter(F.col("actual_day").between(F.date_sub(first, 1), F.date_add(last, 1)))
    keys = ["trip_id", "mode", "stop_id", "actual_day"] + (["stop_sequence"] if by_sequence else [])
    return latest_per_key(
        local, keys, [F.col("load_timestamp").desc(), F.col("stop_sequence").desc(), F.col("actual_arrival").desc()]
    )


def planned_days(updates: DataFrame) -> DataFrame:
    """``planned_day``: every date whose plan some update can match; a schedule of these dates gives the same delays.

    Times are cut to quarters of an hour before they are made distinct, so only few are converted to local time.
    """
    quarters = updates.select((F.floor(F.coalesce("arrival", "departure") / QUARTER) * QUARTER).alias("_at")).distinct()
    local = quarters.select(epoch_to_local("_at").alias("_at")).filter("_at IS NOT NULL")
    return local.select(F.explode(midnight_days(F.to_date("_at"), F.hour("_at"))).alias("planned_day")).distinct()


def _matched(
    updates: DataFrame, schedule: DataFrame, strict_text_hour: bool = False, days: tuple[str, str] | None = None, dealt: bool = False
) -> DataFrame:
    """Newest updates with their planned stops. ``dealt`` says that the rows of a trip and mode lie together already."""
    if days is not None:
        schedule = schedule.filter(F.col("event_date").between(*days))
    newest = latest_updates(updates, days=days).select("trip_id", "mode", "stop_id", "actual_arrival", F.col("load_timestamp").alias("update_timestamp"))
    # the shuffle to the schedule carries the time alone; day, hour and the second candidate day follow from it
    actual = (newest if dealt else newest.filter("actual_arrival IS NOT NULL").repartition("trip_id", "mode")).withColumns(
        {"actual_day": F.to_date("actual_arrival"), "actual_hour": F.hour("actual_arrival")}
    )
    planned = schedule.filter(F.col("mode") != "TR").withColumns(
        {"planned_day": parse_date("event_date"), "planned_hour": gtfs_hour("arrival_time")}
    )
    hour_text = F.split_part(F.col("arrival_time"), F.lit(":"), F.lit(1))
    tests = (hour_text == "00", hour_text == "23") if strict_text_hour else (None, None)
    return match_midnight(actual, planned, *tests).withColumn("planned_arrival", planned_timestamp("planned_day", "arrival_time"))


def build_delays(updates: DataFrame, schedule: DataFrame, days: tuple[str, str] | None = None, dealt: bool = False) -> DataFrame:
    """Delay in whole minutes per planned stop that was served; early arrivals count as 0.

    Service dates are independent of each other, so ``days`` builds exactly their part of the mart
    (to be stored with ``overwrite_partitions``). ``dealt`` says that the updates are dealt by trip and mode.
    """
    newest = [
        F.col("load_timestamp").desc(), F.col("update_timestamp").desc(), F.col("actual_arrival").desc(), F.col("stop_sequence").desc()
    ]
    # the key repeats the join key, so the join's partitioning is reused
    matched = latest_per_key(_matched(updates, schedule, days=days, dealt=dealt), ["trip_id", "mode", "stop_id", "planned_day"], newest)
    return matched.select(
        "trip_id", "stop_id", "stop_name", "trip_headsign", "stop_sequence", "actual_arrival", "route_short_name", "planned_arrival",
        "mode", "event_date", F.col("update_timestamp").alias("load_timestamp"), F.col("load_timestamp").alias("schedule_timestamp"),
        at_least_zero(minutes_between("planned_arrival", "actual_arrival")).alias("delay"),
    )


def build_delay_vectors(
    updates: DataFrame, schedule: DataFrame, strict_text_hour: bool = False, days: tuple[str, str] | None = None
) -> DataFrame:
    """Pairs of consecutive served stops of a run with planned and actual times.

    A run (trip, mode, date) has at most one row per stop and candidate update, which bounds the
    window. ``strict_text_hour`` compares the planned hour as the text ``00``, so that night trips
    (whose normalized hour is ``0``) are not matched across midnight. ``days`` as in ``build_delays``.
    """
    served = _matched(updates, schedule, strict_text_hour, days)
    w = Window.partitionBy(*RUN).orderBy("stop_sequence", "planned_arrival", "actual_arrival", "stop_id")
    following = {
        "direction_stop_id": "stop_id", "end_stop_sequence": "stop_sequence", "next_planned": "planned_arrival", "next_actual": "actual_arrival"
    }
    paired = served.withColumns({name: F.lead(col).over(w) for name, col in following.items()})
    return paired.filter(F.col("direction_stop_id").isNotNull()).select(
        *RUN,
        F.col("stop_id").alias("start_stop_id"),
        F.col("stop_sequence").alias("start_stop_sequence"),
        F.col("planned_arrival").alias("planned_departure"),
        F.col("actual_arrival").alias("actual_departure"),
        "direction_stop_id",
        "end_stop_sequence",
        F.col("next_planned").alias("planned_arrival"),
        F.col("next_actual").alias("actual_arrival"),
        vector_id(F.col("trip_id"), F.col("event_date"), F.col("stop_sequence"), F.col("end_stop_sequence")).alias("vector_unique_id"),
    )
