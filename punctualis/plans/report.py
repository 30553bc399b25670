"""Average delay per stop pair, hour and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctualis.operators.dedup import latest_per_key
from punctualis.operators.prefix import sessionize_resets


def latest_in_session(sessions: DataFrame) -> DataFrame:
    """Newest, then most delayed, row per trip, session, stop position and mode."""
    order = [F.col("load_timestamp").desc(), F.col("delay").desc_nulls_first(), F.col("stop_id")]
    return latest_per_key(sessions, ["trip_id", "session_id", "stop_sequence", "mode"], order)


def stop_pairs(latest: DataFrame) -> DataFrame:
    """Each stop with the next one of its session; only neighbours in the stop order remain.

    Input has one row per stop position of a session, which bounds the window.
    """
    w = Window.partitionBy("trip_id", "session_id", "mode").orderBy("stop_sequence")
    paired = latest.withColumns({"next_stop_id": F.lead("stop_id").over(w), "next_stop_sequence": F.lead("stop_sequence").over(w)})
    return paired.filter(F.col("next_stop_id").isNotNull() & (F.col("stop_sequence") + 1 == F.col("next_stop_sequence")))


def pair_averages(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(
        "stop_id", "next_stop_id", F.hour("load_timestamp").alias("delay_hour"), F.to_date("load_timestamp").alias("delay_date")
    ).agg(F.count(F.lit(1)).alias("cnt"), F.avg("delay").alias("avg_delay"))


def with_places(averages: DataFrame, stops: DataFrame, fix_next: bool = True) -> DataFrame:
    """Coordinates of both stops on the load day.

    ``fix_next=False`` looks the second stop up by the first stop's id, as older reports did.
    """
    places = stops.select("stop_id", F.to_date("load_timestamp").alias("day"), "stop_lat", "stop_lon")
    a, b, c = averages.alias("a"), places.alias("b"), places.alias("c")
    other = F.col("a.next_stop_id") if fix_next else F.col("a.stop_id")
    return (
        a.join(b, (F.col("a.stop_id") == F.col("b.stop_id")) & (F.col("a.delay_date") == F.col("b.day")), "left")
        .join(c, (other == F.col("c.stop_id")) & (F.col("a.delay_date") == F.col("c.day")), "left")
        .select(
            "a.cnt", "a.avg_delay", "a.stop_id", "b.stop_lat", "b.stop_lon", "a.next_stop_id",
            F.col("c.stop_lat").alias("next_stop_lat"), F.col("c.stop_lon").alias("next_stop_lon"), "a.delay_hour", "a.delay_date",
        )
    )


REPORT_COLUMNS = ("trip_id", "stop_sequence", "stop_id", "mode", "delay", "load_timestamp")


def report_of_sessions(sessions: DataFrame, stops: DataFrame, first_day: str, last_day: str, fix_next: bool = True) -> DataFrame:
    pairs = stop_pairs(latest_in_session(sessions))
    wanted = F.col("delay_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    averages = pair_averages(pairs).filter(wanted)
    return with_places(averages, stops, fix_next).orderBy(F.col("stop_id").desc(), "delay_hour")


def segment_report(delays: DataFrame, stops: DataFrame, first_day: str, last_day: str, fix_next: bool = True) -> DataFrame:
    """The report for load dates between two days (both included), by stop descending and hour."""
    return report_of_sessions(sessionize_resets(delays.select(*REPORT_COLUMNS)), stops, first_day, last_day, fix_next)
