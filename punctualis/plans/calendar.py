"""Service calendar: which service runs on which date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctualis.functions.times import date_text, parse_date
from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import with_scalar

DAY_FLAGS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def service_runs_on(day: Column, exception: Column) -> Column:
    """Weekday flag of the day, minus removals (2), plus additions (1)."""
    flag = F.element_at(F.array(*[F.col(c) for c in DAY_FLAGS]), F.dayofweek(day))
    return ((flag == 1) & ((exception != 2) | exception.isNull())) | (exception == 1)


def service_days(calendar: DataFrame) -> DataFrame:
    """One row per service version and date of its period.

    A period starts at the first load of the table at the earliest and runs to its own end, however far
    that is. Each row generates its own dates; there is no join with a date table.
    """
    first = calendar.agg(F.min(F.to_date("load_timestamp")).alias("_first"))
    start = F.greatest(parse_date("start_date"), F.col("_first"))
    end = parse_date("end_date")
    ranged = with_scalar(calendar, first).withColumns({"_start": start, "_end": end}).filter(F.col("_start") <= F.col("_end"))
    return ranged.withColumn("day", F.explode(F.sequence("_start", "_end"))).drop("_first", "_start", "_end")


def with_exceptions(days: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Attach ``exception_type`` of the same service version and date, NULL without one."""
    exceptions = calendar_dates.select("service_id", "mode", "load_timestamp", parse_date("date").alias("day"), "exception_type")
    return days.join(exceptions, ["service_id", "mode", "load_timestamp", "day"], "left")


def expand_calendar(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """(event_date, service_id, mode, load_timestamp) for every date a service runs."""
    days = with_exceptions(service_days(calendar), calendar_dates)
    return days.filter(service_runs_on(F.col("day"), F.col("exception_type"))).select(
        date_text("day").alias("event_date"), "service_id", "mode", "load_timestamp"
    )


def latest_calendar(expanded: DataFrame, stop_times: DataFrame, all_services: bool = False) -> DataFrame:
    """Per mode and date the newest calendar load that also has stop times.

    One service per mode and date is kept (smallest service_id); ``all_services`` keeps all of the
    newest load. The load times with stop times, one value per load, travel as one row, so neither side
    is shuffled on them.
    """
    loads = stop_times.agg(F.collect_set("load_timestamp").alias("_loads"))
    loaded = with_scalar(expanded, loads).filter(F.array_contains("_loads", F.col("load_timestamp"))).drop("_loads")
    newest = F.col("load_timestamp").desc()
    if not all_services:
        return latest_per_key(loaded, ["mode", "event_date"], [newest, F.col("service_id")])
    top = loaded.groupBy("mode", "event_date").agg(F.max("load_timestamp").alias("load_timestamp"))
    return loaded.join(top, ["mode", "event_date", "load_timestamp"], "left_semi")
