"""Tables whose content is what their newest version names.

Below the table's path lie ``data/commit=<id>`` (files that never change), ``manifests/<id>`` (a row per live file: its
partition, number of rows, digest of the rows, newest load time, key range) and ``versions/<number>`` (which manifest, schema and
finished batches). A writer writes data, then the manifest, then a version file under a name of its own, and moves that to the
next number, which fails where another writer was first. Readers list the files of the newest version, so a writer that dies at
any point leaves the old rows, and one that finishes leaves the new ones. Summaries answer what changed without reading data.

NULL keys and days are values like any other; rows whose partition is NULL have a partition of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctualis.operators.dedup import latest_per_key
from punctualis.operators.scd2 import latest_load, scd2_closed, scd2_empty, scd2_opened
from punctualis.schemas import STATIC_CONFIG
from punctualis.sources.sinks import row_hash, with_day

MANIFEST = "file string, part string, rows bigint, digest decimal(38,0), newest timestamp_ntz, lowest string, highest string"


class Conflict(Exception):
    """Another writer published the version that this one wanted."""


@dataclass
class Version:
    number: int
    manifest: str
    schema: T.StructType
    part: str | None = None
    ts: str | None = None
    key: str | None = None
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"manifest": self.manifest, "schema": self.schema.json(), "part": self.part, "ts": self.ts, "key": self.key, "batches": self.batches})


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target = _files(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _claim(spark: SparkSession, path: str, number: int, text: str) -> None:
    """Make a version out of a whole file; ``Conflict`` where the number is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, draft = _files(spark, f"{path}/versions/_{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(text.encode())
    stream.close()
    files = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()) if draft.toUri().getScheme() else hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(draft, hadoop.Path(f"{path}/versions/{number:020d}"), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            raise Conflict(path) from error
        raise


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _files(spark, f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    found = json.loads(_read_text(spark, f"{path}/versions/{numbers[-1]:020d}"))
    return Version(numbers[-1], **{**found, "schema": T.StructType.fromJson(json.loads(found["schema"]))})


def manifest(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """A row per live file (``MANIFEST``)."""
    version = version or current(spark, path)
    return spark.createDataFrame([], MANIFEST) if version is None else spark.read.schema(MANIFEST).parquet(f"{path}/manifests/{version.manifest}")


def _rows(spark: SparkSession, path: str, version: Version, entries: DataFrame) -> DataFrame:
    """Rows of the given files with their file name."""
    names = [r.file for r in entries.select("file").collect()]
    if not names:
        return spark.createDataFrame([], version.schema).withColumn("_file", F.lit(""))
    found = spark.read.schema(version.schema).option("basePath", f"{path}/data").parquet(*[f"{path}/{n}" for n in names])
    return found.select(*[f"`{c}`" for c in version.schema.names], _file_name().alias("_file"))


def _file_name():
    return F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"(data/commit=[^/]*/.*)$", 1)


def read(spark: SparkSession, path: str, parts: DataFrame | None = None) -> DataFrame | None:
    """The rows of the newest version, None before the first one; ``parts`` (column ``part``) names the partitions to read."""
    version = current(spark, path)
    if version is None:
        return None
    entries = manifest(spark, path, version)
    if parts is not None:
        entries = entries.join(parts.select(F.col("part").alias("_part")).distinct(), F.col("part").eqNullSafe(F.col("_part")), "left_semi")
    return _rows(spark, path, version, entries).drop("_file")


def _described(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """Manifest rows of the files of one commit, from the data just written."""
    rows = spark.read.schema(version.schema).option("basePath", f"{path}/data").parquet(f"{path}/data/commit={version.manifest}")
    names = [c for c in version.schema.names if c != version.part]
    none = F.lit(None)
    key = F.coalesce(F.col(f"`{version.key}`").cast("string"), F.lit("")) if version.key else none.cast("string")
    return rows.groupBy(_file_name().alias("file"), (F.col(version.part).cast("string") if version.part else none.cast("string")).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_hash(rows, names).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest"),
        F.max(F.col(f"`{version.ts}`").cast("timestamp_ntz") if version.ts else none.cast("timestamp_ntz")).alias("newest"), F.min(key).alias("lowest"), F.max(key).alias("highest"),
    ).select(*[c.split()[0] for c in MANIFEST.split(", ")])


Keep = Callable[[DataFrame, DataFrame], DataFrame]


def publish(
    df: DataFrame, path: str, keep: Keep, part: str | None = None, ts: str | None = None, key: str | None = None, batch: tuple[str, int] | None = None, base: Version | None = None, again: bool = False
) -> bool:
    """A new version: the rows of ``df`` and those files of the last one that ``keep`` (live files, new files) leaves.

    The first write fixes the partition column, the load time and the key that are summarised. A batch (writer, number) that is
    already part of the table is not written again, then False. With ``again`` a writer that was beaten starts from the other's version; else ``Conflict``.
    """
    spark = df.sparkSession
    last = base or current(spark, path)
    new = Version(0, uuid.uuid4().hex, df.schema, part, ts, key)
    if last:
        new.part, new.ts, new.key = last.part, last.ts, last.key
        df = df.select(*[f"`{c}`" for c in last.schema.names])
    names = [c for c in df.columns if c != new.part] + ([new.part] if new.part else [])
    new.schema = T.StructType([df.schema[c] for c in names])
    written = False
    while True:
        if batch and last and last.batches.get(batch[0], -1) >= batch[1]:
            return False
        if not written:
            balanced = df.hint("rebalance", new.part) if new.part else df
            balanced.write.partitionBy(*([new.part] if new.part else [])).parquet(f"{path}/data/commit={new.manifest}")
            written = True
        _write_manifest(spark, path, new, last, keep)
        batches = {**(last.batches if last else {}), **({batch[0]: batch[1]} if batch else {})}
        try:
            _claim(spark, path, (last.number if last else 0) + 1, Version(0, new.manifest, new.schema, new.part, new.ts, new.key, batches).text())
            return True
        except Conflict:
            if not again:
                raise
            last = current(spark, path)


def _write_manifest(spark: SparkSession, path: str, new: Version, last: Version | None, keep: Keep) -> None:
    added = _described(spark, path, new)
    kept = added.limit(0) if last is None else keep(manifest(spark, path, last), added)
    added.unionByName(kept).write.mode("overwrite").parquet(f"{path}/manifests/{new.manifest}")


def _all(live: DataFrame, added: DataFrame) -> DataFrame:
    return live


def _none(live: DataFrame, added: DataFrame) -> DataFrame:
    return live.limit(0)


def _other_parts(live: DataFrame, added: DataFrame) -> DataFrame:
    parts = added.select(F.col("part").alias("_part")).distinct()
    return live.join(parts, F.col("part").eqNullSafe(F.col("_part")), "left_anti")


def append(df: DataFrame, path: str, part: str | None = None, ts: str | None = None, key: str | None = None, batch: tuple[str, int] | None = None) -> bool:
    """Add rows, each batch once."""
    return publish(df, path, _all, part, ts, key, batch, again=True)


def replace(df: DataFrame, path: str, part: str | None = None, ts: str | None = None, key: str | None = None) -> bool:
    """New content; ``df`` may read the table itself."""
    return publish(df, path, _none, part, ts, key)


def replace_parts(df: DataFrame, path: str, part: str, ts: str | None = None, key: str | None = None, batch: tuple[str, int] | None = None) -> bool:
    """New content of the partitions that occur in ``df``, which may read the table itself."""
    return publish(df, path, _other_parts, part, ts, key, batch)


def expire(spark: SparkSession, path: str) -> int:
    """Delete what only older versions and dead writers hold; no reader or writer of those may be at work. Returns the number of folders."""
    last = current(spark, path)
    if last is None:
        return 0
    live = {r.c for r in manifest(spark, path, last).select(F.regexp_extract("file", "commit=([^/]*)/", 1).alias("c")).distinct().collect()}
    gone = 0
    for folder, wanted in ((f"{path}/data", {f"commit={c}" for c in live}), (f"{path}/manifests", {last.manifest}), (f"{path}/versions", {f"{last.number:020d}"})):
        fs, place = _files(spark, folder)
        for entry in fs.listStatus(place):
            name = entry.getPath().getName()
            if name.lstrip(".").removesuffix(".crc") not in wanted:
                gone += bool(fs.delete(entry.getPath(), True))
    return gone


# exports by summary


def newest(spark: SparkSession, path: str):
    """The high-water mark: the newest load time of the live rows, None for no table."""
    return manifest(spark, path).agg(F.max("newest")).first()[0]


def part_summaries(spark: SparkSession, path: str) -> DataFrame:
    """part, rows, digest of every partition, from the manifest alone."""
    return manifest(spark, path).groupBy("part").agg(F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest"))


def row_summaries(df: DataFrame, part: str) -> DataFrame:
    """The same summaries of rows that are not in a committed table."""
    names = [c for c in df.columns if c != part]
    return df.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df, names).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest"))


def differing_parts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Partitions (column ``part``) of the first summaries that the second ones hold otherwise, or not at all."""
    had = target.select(F.col("part").alias("_part"), F.struct("rows", "digest").alias("_had"))
    joined = source.join(had, F.col("part").eqNullSafe(F.col("_part")), "left")
    return joined.where(~F.struct("rows", "digest").eqNullSafe(F.col("_had"))).select("part")


def _of_parts(df: DataFrame, parts: DataFrame, part: str) -> DataFrame:
    return df.join(parts.select(F.col("part").alias("_part")), F.col(part).cast("string").eqNullSafe(F.col("_part")), "left_semi")


def export_days(df: DataFrame, path: str, ts: str = "load_timestamp") -> bool:
    """One partition per day; days whose rows changed since the last export are written again. The target's data is not read."""
    dated = with_day(df, ts)
    dated = dated.select(*[c for c in dated.columns if c != "d"], "d")
    pending = differing_parts(row_summaries(dated, "d"), part_summaries(df.sparkSession, path))
    if current(df.sparkSession, path) is not None and pending.isEmpty():
        return False
    return replace_parts(_of_parts(dated, pending, "d"), path, "d", ts)


def export_new(df: DataFrame, path: str, ts: str = "load_timestamp") -> bool:
    """As ``export_days``, but only rows from the day of the stored high-water mark on, and those without a time, are looked at."""
    mark = newest(df.sparkSession, path)
    return export_days(df if mark is None else df.where(F.col(ts).isNull() | (F.to_date(ts) >= F.lit(mark.date()))), path, ts)


def copy_days(spark: SparkSession, source: str, target: str) -> bool:
    """Bring a committed table up to date with another one by their manifests; only differing days are read."""
    from_ = current(spark, source)
    pending = differing_parts(part_summaries(spark, source), part_summaries(spark, target))
    if pending.isEmpty() and current(spark, target) is not None:
        return False
    return replace_parts(read(spark, source, pending), target, from_.part, from_.ts, from_.key)


def load_missing(df: DataFrame, path: str, ts: str = "load_timestamp") -> bool:
    """Append the rows that the table does not have yet, each as often as it is missing; only days that differ are read."""
    spark = df.sparkSession
    dated = with_day(df, ts)
    if current(spark, path) is None:
        return append(dated, path, "d", ts)
    dated = dated.select(*current(spark, path).schema.names)
    pending = differing_parts(row_summaries(dated, "d"), part_summaries(spark, path))
    missing = _of_parts(dated, pending, "d").exceptAll(read(spark, path, pending))
    return not missing.isEmpty() and append(missing, path)


# merges by file


def _touched(spark: SparkSession, path: str, version: Version, keys: DataFrame) -> DataFrame:
    """Live files that hold one of the keys (struct column ``_key``): by key range first, then by the key columns of the files left."""
    entries = manifest(spark, path, version)
    names = keys.schema["_key"].dataType.names
    if version.key in names:
        text = F.coalesce(F.col(f"_key.`{version.key}`").cast("string"), F.lit(""))
        low, high = keys.agg(F.min(text), F.max(text)).first()
        entries = entries.where((F.col("highest") >= F.lit(low)) & (F.col("lowest") <= F.lit(high))) if low is not None else entries.limit(0)
    rows = _rows(spark, path, version, entries).select(F.struct(*names).alias("_key"), "_file")
    found = rows.join(keys, "_key", "left_semi").select(F.col("_file").alias("file")).distinct()
    return spark.createDataFrame(found.toArrow(), "file string")  # names of files, as the reader lists them


def _without(files: DataFrame) -> Keep:
    return lambda live, added: live.join(files, "file", "left_anti")


def replace_keys(rows: DataFrame, path: str, keys: DataFrame, batch: tuple[str, int] | None = None) -> bool:
    """Remove the rows of all ``keys`` (struct column ``_key``) and add ``rows``; only files that hold one of the keys are written again."""
    spark, last = rows.sparkSession, current(rows.sparkSession, path)
    if batch and last.batches.get(batch[0], -1) >= batch[1]:
        return False
    files = _touched(spark, path, last, keys)
    names = keys.schema["_key"].dataType.names
    left = _rows(spark, path, last, files).drop("_file").withColumn("_key", F.struct(*names)).join(keys, "_key", "left_anti").drop("_key")
    return publish(left.unionByName(rows.select(*left.columns)), path, _without(files), batch=batch, base=last)


def merge(source: DataFrame, path: str, keys: Sequence[str], batch: tuple[str, int] | None = None) -> bool:
    """Insert or replace by key; only files that hold a key of ``source`` are written again."""
    if current(source.sparkSession, path) is None:
        return publish(source, path, _none, key=keys[0], batch=batch)
    return replace_keys(source, path, source.select(F.struct(*keys).alias("_key")).distinct(), batch)


def merge_latest(source: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], batch: tuple[str, int] | None = None) -> bool:
    """Keep the newest row per key; only files that hold a key of ``source`` are written again."""
    spark, last = source.sparkSession, current(source.sparkSession, path)
    rank = [F.col(c).desc() for c in order]
    if last is None:
        return publish(latest_per_key(source, keys, rank), path, _none, key=keys[0], batch=batch)
    source = source.select(*last.schema.names)
    files = _touched(spark, path, last, source.select(F.struct(*keys).alias("_key")).distinct())
    rows = latest_per_key(_rows(spark, path, last, files).drop("_file").unionByName(source), keys, rank)
    return publish(rows, path, _without(files), batch=batch, base=last)


def merge_versions(staged: DataFrame, path: str, keys: Sequence[str], ts: str = "load_timestamp") -> bool:
    """SCD2: the newest load of ``staged`` into a versioned table; only files with a version to close are written again."""
    spark, last = staged.sparkSession, current(staged.sparkSession, path)
    if last is None:
        return publish(scd2_opened(scd2_empty(staged), staged, keys, ts), path, _none, key=keys[0])
    target = _rows(spark, path, last, manifest(spark, path, last)).drop("_file")
    opened = scd2_opened(target, staged, keys, ts)
    changed = opened.select(F.struct(*keys).alias("_key")).distinct()
    files = _touched(spark, path, last, changed)
    closed = scd2_closed(_rows(spark, path, last, files).drop("_file"), staged, keys, ts)
    rows = closed.unionByName(opened)
    return False if files.isEmpty() and opened.isEmpty() else publish(rows, path, _without(files), base=last)


def load_static(staged: dict[str, DataFrame], root: str, config: dict = STATIC_CONFIG, ts: str = "load_timestamp") -> dict[str, bool]:
    """The newest load of every staged table into its target: versions where configured, else appended once, by the stored mark."""
    done = {}
    for name in (n for n in config if n in staged):
        load, path = staged[name], f"{root}/{name}"
        if config[name]["scd2"]:
            done[name] = merge_versions(load, path, config[name]["keys"], ts)
            continue
        mark = newest(load.sparkSession, path)
        load = latest_load(load, ts)
        load = load if mark is None else load.where(F.col(ts).cast("timestamp_ntz") > F.lit(mark))
        done[name] = not load.isEmpty() and append(load, path, ts=ts, key=config[name]["keys"][0])
    return done


def list_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """name, rows, files, bytes, newest load time of committed tables; rows come from the manifests, sizes from the file listing."""
    found = []
    for name, path in paths.items():
        version = current(spark, path)
        if version is None:
            found.append((name, 0, 0, 0, None))
            continue
        entries = manifest(spark, path, version)
        rows, files, last = entries.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1)), F.max("newest")).first()
        commits = [r.c for r in entries.select(F.regexp_extract("file", "(data/commit=[^/]*)/", 1).alias("c")).distinct().collect()]
        size = sum(fs.getContentSummary(place).getLength() for fs, place in (_files(spark, f"{path}/{c}") for c in commits))
        found.append((name, rows, files, size, last))
    return spark.createDataFrame(found, "table string, rows bigint, files bigint, bytes bigint, newest timestamp_ntz")
