"""Slowly changing dimensions and keyed upserts on plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctualis.operators.dedup import latest_per_key
from punctualis.operators.joins import with_scalar

FIRST_VERSION = "1900-01-01"
VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")


def latest_load(staged: DataFrame, ts: str = "load_timestamp") -> DataFrame:
    """Rows of the newest load in a staging table."""
    newest = staged.agg(F.max(ts).alias("_newest"))
    return with_scalar(staged, newest).filter(F.col(ts) == F.col("_newest")).drop("_newest")


def scd2_empty(staged: DataFrame) -> DataFrame:
    """An empty target with the columns of ``staged`` and the version columns."""
    return staged.limit(0).select(
        "*",
        F.lit(None).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(None).cast("boolean").alias("is_current"),
    )


def _load(staged: DataFrame, keys: Sequence[str], ts: str, exclude: Sequence[str]) -> tuple[DataFrame, Column]:
    """One row per key of the newest load, and the tracked content."""
    skip = {*keys, *exclude, ts, *VERSION_COLUMNS}
    tracked = [c for c in staged.columns if c not in skip]
    if not tracked:
        raise ValueError("no tracked columns left for the version comparison")
    return latest_per_key(latest_load(staged, ts), list(keys), [F.col(c) for c in tracked]), F.struct(*tracked)


def scd2_merge(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    ts: str = "load_timestamp",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """New content of a versioned dimension after the newest load of ``staged``.

    A changed key gets its current version closed at the load time and a new version opened there.
    A key never seen before starts in 1900. Unchanged and vanished keys stay as they are. Keys and content are
    compared NULL-safe, merging the same load again changes nothing, and a load that is not newer than the
    current version of a key leaves that key alone.
    """
    return scd2_closed(target, staged, keys, ts, exclude).unionByName(scd2_opened(target, staged, keys, ts, exclude))


def scd2_opened(target: DataFrame, staged: DataFrame, keys: Sequence[str], ts: str = "load_timestamp", exclude: Sequence[str] = ()) -> DataFrame:
    """The versions that the newest load opens."""
    load, content = _load(staged, keys, ts, exclude)
    state = target.groupBy(F.struct(*keys).alias("_key")).agg(
        F.max(F.when(F.col("is_current"), content)).alias("_cur"), F.max(F.when(F.col("is_current"), F.col("valid_from"))).alias("_since")
    )
    seen = state.withColumn("_seen", F.lit(True))

    compared = load.withColumn("_key", F.struct(*keys)).join(seen, "_key", "left")
    same = F.col("_cur").isNotNull() & F.col("_cur").eqNullSafe(content)
    same = same | F.coalesce(F.col(ts) <= F.col("_since"), F.lit(False))
    first = F.lit(FIRST_VERSION).cast("timestamp_ntz")
    return compared.filter(~same).select(
        *staged.columns,
        F.when(F.col("_seen").isNull(), first).otherwise(F.col(ts)).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_closed(target: DataFrame, staged: DataFrame, keys: Sequence[str], ts: str = "load_timestamp", exclude: Sequence[str] = ()) -> DataFrame:
    """The rows of ``target`` (or of a part of it), with the versions closed that the newest load ends."""
    load, content = _load(staged, keys, ts, exclude)
    incoming = load.select(F.struct(*keys).alias("_key"), content.alias("_new"), F.col(ts).alias("_at"))
    close = F.col("is_current") & F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(content) & (F.col("_at") > F.col("valid_from"))
    close = F.coalesce(close, F.lit(False))
    return target.withColumn("_key", F.struct(*keys)).join(incoming, "_key", "left").select(
        *staged.columns,
        "valid_from",
        F.when(close, F.col("_at")).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(close, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a source row of the same key (NULL parts are equal), plus all source rows."""
    replaced = source.select(F.struct(*keys).alias("_key")).distinct()
    return target.withColumn("_key", F.struct(*keys)).join(replaced, "_key", "left_anti").drop("_key").unionByName(source)
