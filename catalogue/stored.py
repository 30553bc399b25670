"""Queries over tables that are written to a shared folder and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from catalogue.adapter import Feed
from catalogue.tables_sql import sql
from punctualis.sources import sinks as sk
from punctualis.sources import tables as tb

QUERIES = {}
SQL = {}


def folder(f: Feed, name: str) -> str:
    """A new folder below the shared one of the session; a local session without one gets a temporary folder."""
    shared = f.spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not f.spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="punctualis-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def add(name, query, text):
    QUERIES[name] = lambda spark, sf_dir: query(Feed(spark, sf_dir))
    SQL[name] = sql(text)


_KEPT = ["trip_id", "stop_id", "load_timestamp", "delay"]
_ALL = "SELECT trip_id, stop_id, load_timestamp, delay FROM delays"


def grown_export(f: Feed):
    """A table exported, grown by late rows of exported days, by new days and by rows without a time, and exported again twice."""
    path, rows = folder(f, "export"), f.delays().select(*_KEPT)
    undated = rows.withColumn("load_timestamp", F.when(~F.col("stop_id").endswith("7"), F.col("load_timestamp")))
    first = undated.filter("load_timestamp < timestamp_ntz'2024-01-15' AND delay % 2 = 0")
    sk.export(first, path, sk.export_strategy(True, None))
    for since in (None, "2024-01-15 00:00:00"):
        sk.export(undated, path, sk.export_strategy(True, since), since)
    return f.spark.read.parquet(path).select(*_KEPT)


add("snk7_grown_export", grown_export,
    "SELECT trip_id, stop_id, CASE WHEN stop_id NOT LIKE '%7' THEN load_timestamp END AS load_timestamp, delay FROM delays")


def appended(f: Feed):
    path, rows = folder(f, "append"), f.delays().select(*_KEPT).withColumn("day", F.date_format("load_timestamp", "yyyyMMdd"))
    for part in range(3):
        sk.append_table(rows.filter(F.pmod(F.hash("trip_id"), F.lit(3)) == part), path, ["day"])
    return sk.read_typed(f.spark, path, rows.schema)


add("snk2_batch_append", appended, "SELECT trip_id, stop_id, load_timestamp, delay, strftime(load_timestamp, '%Y%m%d') AS day FROM delays")


def snapshots(f: Feed):
    path, rows = folder(f, "snapshots"), f.raw("events").select("event_id", "event_type")
    for i, stamp in enumerate(("20240101_100000", "20240101_103000", "20240101_110000", "20240101_113000")):
        sk.write_snapshot(rows.filter(F.col("event_id") % 4 == i), path, "events", stamp)
    return tb.read_snapshots(f.spark, path, "events", "2024-01-01 10:30:00", "2024-01-01 11:00:00")


add("snk3_src9_snapshot_window", snapshots, "SELECT event_id, event_type FROM events WHERE event_id % 4 IN (1, 2)")
QUERIES["u3_concat_snapshots"], SQL["u3_concat_snapshots"] = QUERIES["snk3_src9_snapshot_window"], SQL["snk3_src9_snapshot_window"]


def full_export(f: Feed):
    path = folder(f, "full")
    for rows in (f.delays().limit(10), f.delays()):  # the second export replaces the first
        sk.export_full(rows.select(*_KEPT), path)
    return f.spark.read.parquet(path)


add("snk4_full_export", full_export, _ALL)


def by_name(f: Feed):
    """Columns in other order and case, one missing, one more than the target has."""
    path = folder(f, "by-name")
    sk.overwrite_table(f.delays().select(F.col("delay").cast("string").alias("DELAY"), F.col("trip_id").alias("Trip_Id"), "stop_sequence"), path)
    target = f.spark.createDataFrame([], "trip_id string, delay bigint, note string").schema
    return sk.load_parquet(f.spark, path, target)


add("snk8_load_by_name", by_name, "SELECT trip_id, delay, NULL::VARCHAR AS note FROM delays")


def reloaded(f: Feed):
    path = folder(f, "reload")
    sk.overwrite_table(f.stops(), path)
    sk.replace_table(f.spark.read.parquet(path).filter("stop_name IS NOT NULL"), path)
    return f.spark.read.parquet(path).select("stop_id", "stop_name", "mode", "load_timestamp")


add("snk10_reload_from_itself", reloaded, "SELECT stop_id, stop_name, mode, load_timestamp FROM stops WHERE stop_name IS NOT NULL")


def csv_round_trip(f: Feed):
    path = folder(f, "csv")
    sk.write_csv(f.delays(), path)
    return tb.read_delays_csv(f.spark, path)


add("snk13_src11_csv", csv_round_trip, "SELECT * FROM delays")


def upserted(f: Feed):
    """Stops of the second load replace those of the first by key, a NULL mode among the keys."""
    path = folder(f, "upsert")
    rows = f.stops().select("stop_id", F.when(F.col("mode") != "T", F.col("mode")).alias("mode"), "stop_name", "load_timestamp")
    sk.overwrite_table(rows.filter("load_timestamp = timestamp_ntz'2024-01-01'"), path)
    sk.upsert_table(rows.filter("load_timestamp = timestamp_ntz'2024-01-15' AND stop_name IS NOT NULL"), path, ["stop_id", "mode"])
    return f.spark.read.parquet(path)


add("snk12_upsert_stored", upserted,
    """SELECT stop_id, CASE WHEN mode <> 'T' THEN mode END AS mode, stop_name,
       CASE WHEN stop_name IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-15' END AS load_timestamp FROM stops WHERE load_timestamp = TIMESTAMP '2024-01-01'""")


def cleaned(f: Feed):
    """Every third row of a table stored twice; the cleanup leaves each row once."""
    path, rows = folder(f, "clean"), f.raw("events")
    sk.append_table(rows, path)
    sk.append_table(rows.filter(F.col("event_id") % 3 == 0), path)
    sk.dedup_table(f.spark, path)
    return f.spark.read.parquet(path).select("event_id", "event_type")


add("m14_dedup_stored", cleaned, "SELECT event_id, event_type FROM events")
