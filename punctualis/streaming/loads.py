"""Structured Streaming: landing, micro-batch appends and latest-wins state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctualis.plans.incremental import update_marts
from punctualis.sources import committed
from punctualis.sources.json_feeds import traffic_records
from punctualis.sources.realtime import decode_trip_updates, decode_vehicle_positions, with_file_facts

BINARY = "path string, modificationTime timestamp, length long, content binary"
DECODERS = {"trip_updates": decode_trip_updates, "vehicle_positions": decode_vehicle_positions}


def _start(df: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**trigger).start()


def stream_landing(
    spark: SparkSession, folder: str, kind: str, out: str, checkpoint: str, trigger: dict | None = None, clean: str = "off"
) -> StreamingQuery:
    """Decode landed feed messages of one kind into an append-only table, once per file.

    ``clean="delete"`` removes files after they were processed (never before, unlike a retention by age).
    """
    files = (
        spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", f"{kind}_*.pb").option("cleanSource", clean).load(folder)
    )
    rows = DECODERS[kind](with_file_facts(files))
    return _start(rows, out, checkpoint, trigger or {"processingTime": "1 minute"})


def stream_append(
    spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, trigger: dict | None = None, clean: str = "off"
) -> StreamingQuery:
    """Append parquet snapshots to a table in 30-minute micro-batches, or once with ``availableNow``."""
    rows = spark.readStream.schema(schema).option("cleanSource", clean).option("recursiveFileLookup", True).parquet(folder)
    return _start(rows, out, checkpoint, trigger or {"processingTime": "30 minutes"})


def stream_traffic(
    spark: SparkSession, folder: str, out: str, checkpoint: str, trigger: dict | None = None, clean: str = "off"
) -> StreamingQuery:
    """Append the records of traffic files hourly; unreadable files go to ``<out>_bad``."""
    files = spark.readStream.option("wholetext", True).option("pathGlobFilter", "traffic_*.json").option("cleanSource", clean).text(folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch id names the output, so a repeated batch overwrites itself
        good, bad = traffic_records(batch)
        good.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{out}_bad/batch={batch_id}")

    writer = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"processingTime": "1 hour"})).start()


def stream_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: str | None = None, lateness: str = "1 day", span: str = "1 day") -> DataFrame:
    """Newest row per key as running state (update mode), equal to the batch result over the log.

    With an ``event_time`` there is a newest row per key and ``span`` of it (``span_start`` tells which), and state ends once no row
    of the span can come any more: rows up to ``lateness`` behind the newest event still win or lose by ``order``, later
    ones are left out and counted by the query. State is then bounded by the keys of ``lateness`` and one span. Where that is still many, it lies on disk
    (RocksDB, see ``session.py``), not in the heap.
    """
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order))
    if event_time is None:
        return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")
    timed = df.withColumn("_event", F.col(event_time).cast("timestamp")).withWatermark("_event", lateness)
    return timed.groupBy(*keys, F.window("_event", span)).agg(newest.alias("_row")).select(*keys, "_row.*", F.col("window.start").cast("timestamp_ntz").alias("span_start"))


def stream_to_table(df: DataFrame, path: str, checkpoint: str, name: str, part: str | None = None, ts: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append each micro-batch to a committed table, once: a repeated batch is known by the stream's name and its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        committed.append(batch, path, part=part, ts=ts, batch=(name, batch_id))

    return _each(df, write, checkpoint, trigger)


def stream_latest_table(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, name: str = "latest", trigger: dict | None = None
) -> StreamingQuery:
    """Keep a committed table with the newest row per key, whatever comes late.

    A micro-batch writes only the files again that hold one of its keys; a crash leaves the table before or after a batch.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        committed.merge_latest(batch, path, keys, order, batch=(name, batch_id))

    return _each(df, merge, checkpoint, trigger)


def stream_latest_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: str, path: str, checkpoint: str, lateness: str = "1 day", span: str = "1 day", name: str = "state", trigger: dict | None = None
) -> StreamingQuery:
    """The table of ``stream_latest`` per key and span, with bounded state: only keys whose newest row changed reach the table."""
    names, whole = [*df.columns, "span_start"], [*keys, "span_start"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        # a merge reads its rows more than once; from a file, so the state is read and written a single time
        staged = f"{checkpoint.rstrip('/')}-batch"
        batch.select(names).write.mode("overwrite").parquet(staged)
        committed.merge_latest(batch.sparkSession.read.schema(batch.select(names).schema).parquet(staged), path, whole, order, batch=(name, batch_id))

    return _each(stream_latest(df, keys, order, event_time, lateness, span), merge, checkpoint, trigger, "update")


def stream_marts(updates: DataFrame, schedule: Callable[[SparkSession], DataFrame], root: str, checkpoint: str, name: str = "marts", trigger: dict | None = None) -> StreamingQuery:
    """Delay mart and sums after every micro-batch of trip updates (``plans/incremental.py``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        update_marts(batch, schedule(batch.sparkSession), root, (name, batch_id))

    return _each(updates, write, checkpoint, trigger)


def _each(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
