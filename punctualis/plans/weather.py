"""Hourly weather per stop from the nearest district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctualis.operators.dedup import latest_per_key
from punctualis.operators.nearest import nearest
from punctualis.schemas import HOURLY_FIELDS

SALTS = 8


def assign_districts(stops: DataFrame, districts: DataFrame, **search) -> DataFrame:
    """(stop_id, stop_name, district_name, distance_m): nearest district per stop.

    Over all rows of a stop the smallest distance wins; ties go to the district name, the mode and
    the newest load. ``search`` goes to ``nearest``.
    """
    placed = stops.filter(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()).select(
        "stop_id", "stop_name", "mode", "load_timestamp", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon")
    )
    centres = districts.select(F.col("district_name").alias("centre"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    found = nearest(placed, centres, **search)
    order = [F.col("distance_m"), F.col("centre"), F.col("mode"), F.col("load_timestamp").desc(), F.col("stop_name")]
    return latest_per_key(found, ["stop_id"], order).select("stop_id", "stop_name", F.col("centre").alias("district_name"), "distance_m")


def stops_weather(stops: DataFrame, districts: DataFrame, weather: DataFrame) -> DataFrame:
    """Stop x hour with the weather of the stop's district.

    There are few districts, so the key is salted twice: stops and hours of a district are spread over ``SALTS`` parts each, and
    every part of the one meets every part of the other. The result is far larger than both sides, so their sizes
    do not tell how many tasks it needs: the join runs over all shuffle partitions.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    keys = ["district_name", "_stops", "_hours"]
    assigned = assign_districts(stops, districts).drop("distance_m").withColumns({"_stops": F.pmod(F.xxhash64("stop_id"), F.lit(SALTS)), "_hours": parts})
    hours = weather.select("district_name", F.col("timestamp").alias("weather_timestamp"), *HOURLY_FIELDS)
    hours = hours.withColumns({"_hours": F.pmod(F.hash("weather_timestamp"), F.lit(SALTS)), "_stops": parts})
    tasks = int(stops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return assigned.repartition(tasks, *keys).join(hours.repartition(tasks, *keys), keys, "inner").select(
        "stop_id", "stop_name", "district_name", "weather_timestamp", *HOURLY_FIELDS
    )
