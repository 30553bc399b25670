"""The delay mart and its sums kept up to date batch by batch.

A batch of trip updates touches runs: trip, mode and the service dates that its updates can match, or that an older update of the same local
day did match across midnight. Only these runs are computed anew, from the log of their days, and only files of the mart that hold them are written again. Sums by group change
by the new rows of the touched runs less the old ones. Log, sums and mart are committed tables that know which batches they
have: after a crash the same batch goes on where it stopped (sums are written before the mart, whose old rows they need).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.functions.times import epoch_to_local, date_text, parse_date
from punctualis.operators.joins import midnight_days, with_scalar
from punctualis.plans.delays import RUN, build_delays
from punctualis.sources import committed as ct

GROUPS = ("mode", "route_short_name", "event_date")


def touched_runs(updates: DataFrame, mart: DataFrame | None = None) -> DataFrame:
    """trip_id, mode, event_date (text) of all runs that the updates can change.

    An update can match the planned days of its own time, and it can take the place of an older one of its trip and local day. What that
    one matched on another date, across midnight, is in ``mart``; on its own day it is touched by the new one.
    """
    days = updates.select("trip_id", "mode", epoch_to_local(F.coalesce("arrival", "departure")).alias("_at")).where("_at IS NOT NULL")
    days = days.select("trip_id", "mode", F.to_date("_at").alias("_day"), F.when(F.hour("_at").isin(0, 23), F.hour("_at")).alias("_hour"))
    runs = days.select("trip_id", "mode", F.explode(midnight_days(F.col("_day"), F.col("_hour"))).alias("_planned"))
    if mart is not None:
        crossed = mart.select("trip_id", "mode", F.to_date("actual_arrival").alias("_day"), parse_date("event_date").alias("_planned")).where("_day <> _planned").distinct()
        renewed = days.select("trip_id", "mode", "_day").distinct()
        runs = runs.unionByName(crossed.join(renewed, ["trip_id", "mode", "_day"], "left_semi").drop("_day"))
    return runs.distinct().select("trip_id", "mode", date_text("_planned").alias("event_date"))


def delay_sums(mart: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Rows, delays and their sum by group; means of any coarser grouping follow from it."""
    return mart.groupBy(*groups).agg(F.count(F.lit(1)).alias("cnt"), F.count("delay").alias("n"), F.coalesce(F.sum("delay"), F.lit(0)).cast("bigint").alias("total"))


def mean_delay(sums: DataFrame, by: str) -> DataFrame:
    return sums.groupBy(by).agg(F.sum("cnt").alias("cnt"), (F.sum("total") / F.sum("n")).alias("mean"))


def update_marts(updates: DataFrame, schedule: DataFrame, root: str, batch: tuple[str, int], groups: Sequence[str] = GROUPS) -> None:
    """Take a batch of updates into ``<root>/log``, ``<root>/sums`` and ``<root>/mart``; a batch counts once.

    Touched runs and their new rows are read several times and kept until the batch is done; the schedule is cut to the dates of
    the runs before it meets them.
    """
    spark = updates.sparkSession
    local = F.to_date(epoch_to_local(F.coalesce("arrival", "departure")))
    ct.append(updates.withColumn("d", local), f"{root}/log", part="d", batch=batch)
    runs = touched_runs(updates, ct.read(spark, f"{root}/mart")).persist()
    days = runs.select(parse_date("event_date").alias("_day")).distinct()
    days = days.select(F.explode(F.array(*[F.date_add("_day", n).cast("string") for n in (-1, 0, 1)])).alias("part")).distinct()
    # log and schedule are dealt by trip once; the cuts, the newest updates and the match across midnight need no other shuffle
    log = ct.read(spark, f"{root}/log", days).select(updates.columns).repartition("trip_id", "mode").join(runs.select("trip_id", "mode").distinct(), ["trip_id", "mode"], "left_semi")
    near = with_scalar(schedule, runs.agg(F.collect_set("event_date").alias("_dates"))).filter(F.array_contains("_dates", F.col("event_date"))).drop("_dates")
    new = build_delays(log.select(updates.columns), near.repartition("trip_id", "mode").join(runs, RUN, "left_semi"), None, True).persist()
    try:
        _renew(new, runs, root, batch, groups)
    finally:
        new.unpersist()
        runs.unpersist()


def _renew(new: DataFrame, runs: DataFrame, root: str, batch: tuple[str, int], groups: Sequence[str]) -> None:
    """Sums and mart with the new rows of the touched runs in place of the old ones."""
    spark = new.sparkSession
    if ct.current(spark, f"{root}/mart") is None:
        ct.append(new.limit(0), f"{root}/mart", key="trip_id", ts="load_timestamp")
        ct.append(delay_sums(new.limit(0), groups), f"{root}/sums", key=groups[0])
    if ct.current(spark, f"{root}/mart").batches.get(batch[0], -1) >= batch[1]:
        return
    keys = runs.select(F.struct(*RUN).alias("_key"))
    mart = ct.read(spark, f"{root}/mart")
    old = mart.join(runs, RUN, "left_semi").select(mart.columns)
    less = [(-F.col(c)).alias(c) for c in ("cnt", "n", "total")]
    change = delay_sums(new, groups).unionByName(delay_sums(old, groups).select(*groups, *less))
    sums = ct.read(spark, f"{root}/sums").unionByName(change).groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("cnt", "n", "total")]).where("cnt <> 0")
    ct.publish(sums, f"{root}/sums", ct._none, batch=batch)
    ct.replace_keys(new, f"{root}/mart", keys, batch)
