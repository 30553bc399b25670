"""Vehicle positions tagged with the vector they are on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctualis.functions.times import LOCAL_TZ, date_text
from punctualis.operators.dedup import latest_per_key

MOVING = (1, 2)


def on_vector(positions: DataFrame, vectors: DataFrame, local_date: bool = False) -> DataFrame:
    """Positions (stopped or in transit) joined to the vector that ends at their current stop.

    The date is that of the load time as stored; ``local_date`` converts it to local time first.
    """
    moment = F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_TZ), F.col("load_timestamp")) if local_date else F.col("load_timestamp")
    moving = positions.filter(F.col("current_status").isin(*MOVING)).withColumns(
        {"event_date": date_text(F.to_date(moment)), "end_stop_sequence": F.col("current_stop_sequence")}
    )
    ends = vectors.select("trip_id", "mode", "event_date", "end_stop_sequence", "vector_unique_id")
    return moving.join(ends, ["trip_id", "mode", "event_date", "end_stop_sequence"], "inner")


def match_vehicles(positions: DataFrame, vectors: DataFrame, local_date: bool = False) -> DataFrame:
    """One tagged position per trip and load time (smallest vehicle id)."""
    tagged = on_vector(positions, vectors, local_date)
    order = [F.col("id"), F.col("current_stop_sequence"), F.col("vector_unique_id"), F.col("latitude"), F.col("longitude")]
    return latest_per_key(tagged, ["trip_id", "load_timestamp"], order).select(
        F.col("id").alias("vehicle_id"), "latitude", "longitude", "bearing", "speed", "current_status", "current_stop_sequence",
        "load_timestamp", "trip_id", "vector_unique_id",
    )
