"""Writers, exports and idempotent loads."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctualis.operators.dedup import dedup_exact, duplicate_report
from punctualis.operators.joins import with_scalar
from punctualis.operators.scd2 import latest_load, scd2_empty, scd2_merge, upsert
from punctualis.schemas import STATIC_CONFIG


def normalize_schema(df: DataFrame) -> DataFrame:
    """Upper-case names and the four storage types: integer, float, timestamp, text.

    ``load_timestamp`` is always a timestamp.
    """
    cols = []
    for f in df.schema.fields:
        if f.name.lower() == "load_timestamp" or isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            kind = "timestamp_ntz"
        elif isinstance(f.dataType, T.IntegralType):
            kind = "bigint"
        elif isinstance(f.dataType, (T.FractionalType, T.DecimalType)):
            kind = "double"
        else:
            kind = "string"
        cols.append(F.col(f"`{f.name}`").cast(kind).alias(f.name.upper()))
    return df.select(*cols)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path`` with the given types, also for partition columns, whose text Spark would read as numbers."""
    return spark.read.schema(schema).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; an empty batch still creates the table with its schema."""
    _balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; read back with ``read_typed`` to keep the type of a text key."""
    writer = _balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per table partition; AQE splits a partition value that holds most of the rows."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a table that ``df`` itself reads: write beside it, then swap by rename."""
    spark = df.sparkSession
    staged, old = (f"{path}__{word}_{uuid.uuid4().hex[:8]}" for word in ("next", "old"))
    df.write.mode("errorifexists").parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, hadoop.Path(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(hadoop.Path(staged), target):
        if had_old:
            fs.rename(hadoop.Path(old), target)
        raise OSError(f"cannot move the new version to {path}")
    if had_old:
        fs.delete(hadoop.Path(old), True)


def write_snapshot(df: DataFrame, folder: str, prefix: str, stamp: str, fmt: str = "parquet") -> bool:
    """One immutable snapshot ``<prefix>_<stamp>.<fmt>``; nothing is written for an empty poll."""
    if df.isEmpty():
        return False
    df.write.mode("errorifexists").format(fmt).save(f"{folder}/{prefix}_{stamp}.{fmt}")
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times keep their microseconds."""
    form = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    df.write.mode("overwrite").options(header=True, timestampFormat=form, timestampNTZFormat=form).csv(path)


# exports


def export_full(df: DataFrame, path: str) -> bool:
    """Whole table; nothing is written for an empty one."""
    if df.isEmpty():
        return False
    overwrite_table(df, path)
    return True


def with_day(df: DataFrame, ts: str = "load_timestamp") -> DataFrame:
    return df.withColumn("d", F.to_date(ts))


def row_hash(df: DataFrame, names: Sequence[str]) -> Column:
    """Hash of a row over the named columns; absent ones are NULL. NULL flags keep (NULL, 1) and (1, NULL) apart."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    cols = []
    for name in names:
        kind, col = kinds.get(name.lower()), F.col(f"`{name}`")
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        cols.append(F.lit(None) if kind is None else F.to_json(F.struct(col)) if nested else col)
    return F.xxhash64(*cols, *(c.isNull() for c in cols))


def changed_days(src: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of ``src`` on days (column ``d``) that ``done`` holds with other rows, or not at all.

    Days are compared by their number of rows and the sum of the row hashes, whatever the order of the rows. A day
    without a time (NULL) is a day like any other.
    """
    names = [c for c in src.columns if c != "d"]
    total = lambda df: F.struct(F.count(F.lit(1)), F.sum(row_hash(df, names).cast("decimal(20,0)")))
    state = lambda df, name: df.groupBy("d").agg(total(df).alias(name))
    had = state(done, "_had").withColumnRenamed("d", "_d")
    days = state(src, "_has").join(had, F.col("d").eqNullSafe(F.col("_d")), "left").filter(~F.col("_has").eqNullSafe(F.col("_had")))
    return src.join(days.select(F.col("d").alias("_d")), F.col("d").eqNullSafe(F.col("_d")), "left_semi")


def export_daily(df: DataFrame, path: str, ts: str = "load_timestamp") -> None:
    """One partition per calendar day; days whose rows changed since the last export are written again as a whole.

    Rows without a time have a partition of their own, so nothing is left out.
    """
    pending = with_day(df, ts)
    done = read_or_none(df.sparkSession, path)
    _replace_days(pending if done is None else changed_days(pending, done), path)


def from_day_of(df: DataFrame, since: str, ts: str = "load_timestamp") -> DataFrame:
    """Rows (with day ``d``) of the days from the high-water mark on, and those without a time."""
    dated = with_day(df, ts)
    return dated.filter(F.col("d").isNull() | (F.col("d") >= F.to_date(F.lit(since).cast("timestamp_ntz"))))


def export_incremental(df: DataFrame, path: str, since: str | None, ts: str = "load_timestamp") -> None:
    """Write the days from the mark on again; running it twice with one mark changes nothing."""
    if since is None:
        return export_daily(df, path, ts)
    _replace_days(from_day_of(df, since, ts), path)


def _replace_days(df: DataFrame, path: str) -> None:
    overwrite_partitions(df, path, ["d"])


def export_strategy(has_timestamp: bool, since: str | None) -> str:
    """``full`` for tables without load times, else ``daily``, or ``incremental`` after a mark.

    A table keeps one layout whatever its size: by day if it has load times.
    """
    if not has_timestamp:
        return "full"
    return "daily" if since is None else "incremental"


def export(df: DataFrame, path: str, strategy: str, since: str | None = None) -> None:
    actions = {"full": lambda: export_full(df, path), "daily": lambda: export_daily(df, path), "incremental": lambda: export_incremental(df, path, since)}
    actions[strategy]()


# loads


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` by name, ignoring case; absent ones are NULL, a bad value is an error."""
    have = {c.lower(): c for c in df.columns}
    cols = [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    return df.select(*cols)


def load_parquet(spark: SparkSession, path: str, target: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), target)


def load_missing_dates(src: DataFrame, tgt: DataFrame, ts: str = "load_timestamp") -> DataFrame:
    """Source rows the target does not have yet, each as often as it is missing.

    Days with equal rows in both (count and hashes) are taken as loaded; the others are compared row by row, so rows that come later
    for a loaded day, and rows without a time, are loaded once.
    """
    pending = changed_days(with_day(src, ts), with_day(tgt, ts))
    return pending.exceptAll(with_day(tgt, ts).select(*pending.columns)).drop("d")


def latest_not_loaded(staged: DataFrame, target: DataFrame | None, ts: str = "load_timestamp") -> DataFrame:
    """Rows of the newest staged load, unless the target has that load already; whether it has travels as one row, so no row is shuffled."""
    newest = latest_load(staged, ts)
    if target is None:
        return newest
    moment = staged.agg(F.max(ts).alias("_newest"))
    held = with_scalar(target.select(F.col(ts).alias("_held")), moment).filter("_held = _newest").agg(F.count(F.lit(1)).alias("_rows"))
    return with_scalar(newest, held).filter("_rows = 0").select(*staged.columns)


def append_latest(staged: DataFrame, path: str, ts: str = "load_timestamp") -> None:
    append_table(latest_not_loaded(staged, read_or_none(staged.sparkSession, path), ts), path)


def upsert_table(source: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Insert or replace by key in a table on disk."""
    target = read_or_none(source.sparkSession, path)
    replace_table(source if target is None else upsert(target, source, keys), path)


def load_static(staged: dict[str, DataFrame], root: str, config: dict = STATIC_CONFIG) -> None:
    """Move the newest load of every staged table into its target, as versions where configured."""
    for name, rule in config.items():
        if name not in staged:
            continue
        if rule["scd2"]:
            path = f"{root}/{name}_scd2"
            target = read_or_none(staged[name].sparkSession, path)
            target = scd2_empty(staged[name]) if target is None else target
            replace_table(scd2_merge(target, staged[name], rule["keys"]), path)
        else:
            append_latest(staged[name], f"{root}/{name}")


def incremental_window(keys: DataFrame, high_water: DataFrame, key: str, today: str, days: int = 60) -> DataFrame:
    """Days still to load per key: from the day after its newest one, at most ``days`` back, to yesterday."""
    now = F.lit(today).cast("date")
    start = F.greatest(F.date_sub(now, days), F.date_add("last_day", 1))
    joined = keys.select(key).distinct().join(high_water.select(key, "last_day"), key, "left")
    window = joined.select(key, start.alias("start"), F.date_sub(now, 1).alias("end"))
    return window.filter(F.col("start") <= F.col("end"))


def dedup_table(spark: SparkSession, path: str) -> tuple[dict, dict]:
    """Remove exact duplicates of a stored table; counts before and after. A clean table is not rewritten."""
    before = duplicate_report(spark.read.parquet(path)).first().asDict()
    if before["duplicate_rows"] == 0:
        return before, before
    replace_table(dedup_exact(spark.read.parquet(path)), path)
    return before, duplicate_report(spark.read.parquet(path)).first().asDict()
