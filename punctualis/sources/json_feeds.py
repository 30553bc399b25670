"""JSON inputs: weather forecasts, road traffic and district boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.schemas import FLOW_SEGMENT, HOURLY_FIELDS, MIN15_FIELDS, TRAFFIC
from punctualis.sources.gtfs_static import fields_of


def _explode_block(df: DataFrame, block: str, fields: dict[str, str], payload: str) -> DataFrame:
    wire = {name: "int" if kind == "boolean" else kind for name, kind in fields.items()}
    arrays = ", ".join(f"{name}: array<{kind}>" for name, kind in wire.items())
    parsed = df.select(
        "district_name", "latitude", "longitude", F.from_json(payload, f"{block} struct<time: array<string>, {arrays}>")[block].alias("b")
    )
    rows = parsed.select("district_name", "latitude", "longitude", "b", F.posexplode("b.time").alias("i", "time"))
    return rows.select(
        "district_name", "latitude", "longitude",
        F.col("time").cast("timestamp_ntz").alias("timestamp"),
        *[F.get(F.col(f"b.{name}"), F.col("i")).cast(kind).alias(name) for name, kind in fields.items()],
    )


def explode_hourly(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per hour of (district_name, latitude, longitude, payload); short arrays give NULL."""
    return _explode_block(df, "hourly", HOURLY_FIELDS, payload)


def explode_min15(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per quarter hour, as ``explode_hourly``."""
    return _explode_block(df, "minutely_15", MIN15_FIELDS, payload)


def flatten_flow_segment(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Speeds, travel times and confidence of a road segment answer as flat columns."""
    inner = ", ".join(f"{name}: double" for name in FLOW_SEGMENT)
    parsed = F.from_json(payload, f"flowSegmentData struct<{inner}>")["flowSegmentData"]
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, parsed.alias("_s")).select(*kept, *[F.col(f"_s.{a}").alias(b) for a, b in FLOW_SEGMENT.items()])


def traffic_records(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split whole-file JSON texts (``value``) into traffic rows and unreadable files."""
    element = ", ".join(f"{n}: {k}" for n, k in fields_of(TRAFFIC))
    parsed = files.withColumn("_rows", F.from_json("value", f"array<struct<{element}>>"))
    good = parsed.filter(F.col("_rows").isNotNull()).select(F.inline("_rows"))
    good = good.withColumn("load_timestamp", F.col("load_timestamp").try_cast("timestamp_ntz"))
    return good, parsed.filter(F.col("_rows").isNull()).drop("_rows")


def read_traffic(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all ``traffic_*.json`` files and, apart, the files that are not valid JSON arrays."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "traffic_*.json").text(folder)
    return traffic_records(files.select("value", F.col("_metadata.file_path").alias("path")))


def _rings(kind: Column, text: Column) -> Column:
    polygon = F.array(F.from_json(text, "array<array<array<double>>>"))
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(name, part, ring, pos, lon, lat) of all polygon rings, closed; a missing name is UNKNOWN."""
    feature = "struct<properties: struct<name: string>, geometry: struct<type: string, coordinates: string>>"
    features = spark.read.schema(f"features array<{feature}>").option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    parts = features.select(
        F.coalesce("f.properties.name", F.lit("UNKNOWN")).alias("name"),
        F.posexplode(_rings(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))).alias("part", "rings"),
    )
    rings = parts.select("name", "part", F.posexplode("rings").alias("ring", "points"))
    closed = F.when(
        F.element_at("points", 1) == F.element_at("points", -1), F.col("points")
    ).otherwise(F.concat("points", F.slice("points", 1, 1)))
    return rings.select("name", "part", "ring", F.posexplode(closed).alias("pos", "p")).select(
        "name", "part", "ring", "pos", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat")
    )
