"""Sessions over a log that grows, with a stored summary per trip, mode and day.

``<root>/log`` holds the rows by day of load. ``<root>/sessions`` holds per trip, mode and day the first and the last stop
position and how often the position fell inside the day. What a day starts from follows from the summaries of the days before, so a report
of some days reads these days, the neighbouring days into which its sessions reach, and the summaries. Rows that come late
only renew the summaries of their own day. Both are committed tables.

Rows without a load time are a day of their own before all others; rows without a stop position start no session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctualis.operators.prefix import reset_summaries, sessionize_resets
from punctualis.plans.report import REPORT_COLUMNS, report_of_sessions
from punctualis.sources import committed as ct

KEYS = ("trip_id", "mode")
TS, SEQ = "load_timestamp", "stop_sequence"


def day_summaries(rows: DataFrame) -> DataFrame:
    """trip_id, mode, first, last, falls, d of every trip and day of rows that have their day in ``d``."""
    return reset_summaries(rows.select(*KEYS, "d", TS, SEQ), (*KEYS, "d"), TS, SEQ).select(*KEYS, "first", "last", "falls", "d")


def add_rows(rows: DataFrame, root: str, batch: tuple[str, int] | None = None) -> None:
    """Take rows into the log and renew the summaries of their days; a batch counts once, and one that was cut short can be repeated.

    The summaries know their batches too, so a batch that was finished is not computed again.
    """
    spark = rows.sparkSession
    dated = rows.withColumn("d", F.to_date(TS))
    ct.append(dated, f"{root}/log", part="d", ts=TS, batch=batch)
    days = dated.select(F.col("d").cast("string").alias("part")).distinct()
    ct.replace_parts(day_summaries(ct.read(spark, f"{root}/log", days)), f"{root}/sessions", part="d", batch=batch)


def carried(summaries: DataFrame) -> DataFrame:
    """The summaries with ``before``, the session that a day starts in; the windows hold one row per day."""
    days = Window.partitionBy("_key").orderBy("d")
    keyed = summaries.withColumn("_key", F.struct(*KEYS))
    edge = F.when(F.col("first") < F.lag("last").over(days), 1).otherwise(0)
    keyed = keyed.withColumn("_edge", edge)
    return keyed.withColumn("before", F.sum(F.col("falls") + F.col("_edge")).over(days) - F.col("falls")).drop("_edge")


def days_needed(summaries: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """_key (trip, mode, day) and before of all days that share a session with a day of the range, and the first and last such session."""
    wanted = F.col("d").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    whole = Window.partitionBy("_key")
    until = F.col("before") + F.col("falls")
    days = carried(summaries).withColumns({"low": F.min(F.when(wanted, F.col("before"))).over(whole), "high": F.max(F.when(wanted, until)).over(whole)})
    return days.where((F.col("before") <= F.col("high")) & (until >= F.col("low"))).select(F.struct(*KEYS, "d").alias("_key"), "before", "low", "high")


def sessions_between(spark: SparkSession, root: str, first_day: str, last_day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the log with ``session_id`` as over the whole log: all rows of the sessions that have a row in the range (days included)."""
    needed = days_needed(ct.read(spark, f"{root}/sessions"), first_day, last_day)
    rows = ct.read(spark, f"{root}/log", needed.select(F.col("_key.d").cast("string").alias("part")))
    columns = [c for c in columns or rows.columns if c != "d"]
    of_day = needed.select("_key", F.struct("before", "low", "high").alias("_carried"))
    held = rows.select(*columns, "d").withColumn("_key", F.struct(*KEYS, "d")).join(of_day, "_key").drop("_key")
    inside = sessionize_resets(held, (*KEYS, "d"), TS, SEQ)
    numbered = inside.withColumn("session_id", F.col("session_id") + F.col("_carried.before"))
    return numbered.where(F.col("session_id").between(F.col("_carried.low"), F.col("_carried.high"))).select(*columns, "session_id")


def stored_report(spark: SparkSession, root: str, stops: DataFrame, first_day: str, last_day: str, fix_next: bool = True) -> DataFrame:
    """``segment_report`` of the log, from the days and summaries that it needs."""
    return report_of_sessions(sessions_between(spark, root, first_day, last_day, REPORT_COLUMNS), stops, first_day, last_day, fix_next)
