"""Temporal, midnight-aware and membership joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_scd2(fact: DataFrame, dim: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Dimension version valid at ``ts``: equal keys, ``valid_from <= ts < valid_to`` (open end NULL)."""
    cond = [F.col(f"f.{k}") == F.col(f"d.{k}") for k in keys]
    cond.append(F.col("d.valid_from") <= F.col(f"f.{ts}"))
    cond.append(F.col("d.valid_to").isNull() | (F.col(f"f.{ts}") < F.col("d.valid_to")))
    extra = [F.col(f"d.{c}") for c in dim.columns if c not in fact.columns]
    return fact.alias("f").join(dim.alias("d"), cond, "inner").select("f.*", *extra)


def join_asof(fact: DataFrame, versions: DataFrame, keys: Sequence[str], ts: str, chunk: str = "day", salts: int = 8) -> DataFrame:
    """The version that started last at or before ``ts``, where it has not ended: linear in facts and versions, however long a history is.

    Equal to ``join_scd2`` where the versions of a key do not overlap; of overlapping ones the last started, of those that start
    together the one that ends last. Facts with a NULL key or time match nothing. Facts are cut by ``chunk`` of
    time and salted; what holds at the start of a chunk is found once per key from its versions and chunk starts alone.
    """
    given = [F.col(k).isNotNull() for k in keys]
    extra = [c for c in versions.columns if c not in fact.columns]
    key, end = F.struct(*keys).alias("_key"), F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz")).alias("_end")
    payload = F.struct("valid_from", "valid_to", *[F.col(c) for c in extra if c not in ("valid_from", "valid_to")])
    start = lambda c: F.date_trunc(chunk, c).cast("timestamp_ntz").alias("_chunk")
    known = versions.filter(reduce(Column.__and__, given)).select(key, F.col("valid_from").alias("_at"), end, payload.alias("_v"))
    facts = fact.filter(reduce(Column.__and__, [*given, F.col(ts).isNotNull()])).select(key, F.col(ts).cast("timestamp_ntz").alias("_at"), F.struct(*fact.columns).alias("_f"))
    facts = facts.withColumn("_chunk", start("_at"))
    none = F.lit(None)
    # What holds at the start of each chunk, before any version inside it.
    marks = facts.select("_key", "_chunk").distinct().select("_key", F.col("_chunk").alias("_at"), none.cast("timestamp_ntz").alias("_end"), none.cast(known.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_kind"))
    last = lambda w: F.last("_v", ignorenulls=True).over(w.orderBy("_at", "_kind", "_end").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = known.withColumn("_kind", F.lit(0)).unionByName(marks).withColumn("_v", last(Window.partitionBy("_key")))
    carried = carried.filter("_kind = 1 AND _v IS NOT NULL").select("_key", F.col("_at").alias("_chunk"), "_at", F.col("_v.valid_to").alias("_end"), "_v", F.lit(-1).alias("_kind"))
    inside = known.select("_key", start("_at"), "_at", "_end", "_v", F.lit(0).alias("_kind"))
    held = carried.unionByName(inside).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("_f", none.cast(facts.schema["_f"].dataType))
    asked = facts.withColumns({"_end": none.cast("timestamp_ntz"), "_v": none.cast(known.schema["_v"].dataType), "_kind": F.lit(1), "_salt": F.pmod(F.xxhash64("_f"), F.lit(salts)).cast("int")})
    met = held.unionByName(asked).withColumn("_v", last(Window.partitionBy("_key", "_chunk", "_salt"))).filter("_kind = 1 AND _v IS NOT NULL")
    return met.filter(F.col("_v.valid_to").isNull() | (F.col("_at") < F.col("_v.valid_to"))).select("_f.*", *[F.col(f"_v.{c}").alias(c) for c in extra])


def midnight_days(day: Column, hour: Column) -> Column:
    """The planned days that an actual time can go with: its own, and the neighbour across midnight for 23h and 0h."""
    return (
        F.when(hour == 23, F.array(day, F.date_add(day, 1)))
        .when(hour == 0, F.array(day, F.date_sub(day, 1)))
        .otherwise(F.array(day))
    )


def match_midnight(
    updates: DataFrame,
    schedule: DataFrame,
    planned_midnight: Column | None = None,
    planned_last_hour: Column | None = None,
) -> DataFrame:
    """Join actual times to planned stops of the same run, also across midnight.

    ``updates``: trip_id, mode, stop_id, actual_day (date), actual_hour plus payload.
    ``schedule``: trip_id, mode, stop_id, planned_day (date), planned_hour plus payload.
    A 23h actual goes with a 0h plan of the next day and a 0h actual with a 23h plan of the day
    before; every other pair must share the day. Only actuals of these two hours get a second
    candidate day, so the join stays an equi join on the full key.
    Both sides grow with the data and pass through ``explode``, which hides their size from the
    static estimate; the merge hint keeps either of them from being broadcast on a wrong guess.
    ``planned_midnight`` and ``planned_last_hour`` override the tests for 0h and 23h plans.
    """
    midnight = F.col("planned_hour") == 0 if planned_midnight is None else planned_midnight
    last_hour = F.col("planned_hour") == 23 if planned_last_hour is None else planned_last_hour
    day, hour = F.col("actual_day"), F.col("actual_hour")
    candidates = updates.filter(day.isNotNull()).withColumn("planned_day", F.explode(midnight_days(day, hour)))
    crossing = ((hour == 23) & midnight) | ((hour == 0) & last_hour)
    return candidates.join(schedule.hint("merge"), ["trip_id", "mode", "stop_id", "planned_day"], "inner").filter(
        (day == F.col("planned_day")) != crossing
    )


def only_in(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``allowed``."""
    return df.join(allowed.select(*on), list(on), "left_semi")


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of an ungrouped aggregate, which is exactly one row, to every row."""
    return df.join(F.broadcast(scalar), F.lit(True), "inner")
