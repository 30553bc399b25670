"""Static timetable feeds: text folders and zip archives."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.schemas import GTFS_STATIC


def fields_of(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in ddl.split(",")]


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of the schema by name (any order or case); absent ones are NULL, bad values too."""
    have = {c.lower().strip().lstrip("﻿"): c for c in df.columns}
    cols = []
    for name, kind in fields_of(ddl):
        source = F.col(f"`{have[name]}`") if name in have else F.lit(None).cast("string")
        cols.append(F.trim(source).try_cast(kind).alias(name) if kind != "string" else source.alias(name))
    return df.select(*cols)


def union_feeds(feeds: dict[str, DataFrame], load_timestamp: str) -> DataFrame:
    """Feeds of several modes in one table, exact duplicates removed before the load time is set."""
    union = None
    for mode, df in feeds.items():
        tagged = df.withColumn("mode", F.lit(mode))
        union = tagged if union is None else union.unionByName(tagged, allowMissingColumns=True)
    return union.dropDuplicates().withColumn("load_timestamp", F.lit(load_timestamp).cast("timestamp_ntz"))


def read_gtfs_static(spark: SparkSession, feeds: dict[str, str], load_timestamp: str) -> dict[str, DataFrame]:
    """All tables found in ``{mode: folder}``; a table missing from a feed is skipped."""
    out = {}
    for table, ddl in GTFS_STATIC.items():
        found = {}
        for mode, folder in feeds.items():
            try:
                text = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{table}.txt")
            except AnalysisException as missing:
                if "PATH_NOT_FOUND" not in str(missing):
                    raise
                continue
            found[mode] = typed(text, ddl)
        if found:
            out[table] = union_feeds(found, load_timestamp)
    return out


def read_gtfs_archives(spark: SparkSession, archives: dict[str, str], load_timestamp: str) -> dict[str, DataFrame]:
    """Same tables from ``{mode: zip path or glob}``.

    An archive is one task (a zip has one directory at its end). Each table reads only its own
    member, streamed row by row as JSON text and typed by Spark.
    """

    def unpacker(table: str):
        def unpack(batches: Iterator) -> Iterator:
            import csv
            import io
            import json
            import zipfile

            import pandas as pd

            for batch in batches:
                for content in batch["content"]:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                    for member in archive.namelist():
                        if member.rsplit("/", 1)[-1] != f"{table}.txt":
                            continue
                        rows = []
                        for row in csv.DictReader(io.TextIOWrapper(archive.open(member), "utf-8-sig", newline="")):
                            rows.append(json.dumps({k.strip().lower(): v for k, v in row.items() if k and v not in (None, "")}))
                            if len(rows) == 10_000:
                                yield pd.DataFrame({"row": rows})
                                rows = []
                        yield pd.DataFrame({"row": rows})

        return unpack

    out = {}
    for table, ddl in GTFS_STATIC.items():
        text = ", ".join(f"{name} string" for name, _ in fields_of(ddl))
        found = {}
        for mode, path in archives.items():
            lines = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpacker(table), "row string")
            found[mode] = typed(lines.select(F.from_json("row", text).alias("r")).select("r.*"), ddl)
        out[table] = union_feeds(found, load_timestamp)
    return out
