"""Table scans, guarded ad-hoc queries, delay CSV and snapshot files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.schemas import DELAYS


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def adhoc_select(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Run a SELECT, with an outer limit where the caller asks for one. Anything else is refused."""
    query = text.strip().rstrip(";")
    if not re.match(r"(?i)select\b", query):
        raise ValueError("only SELECT queries are permitted")
    result = spark.sql(query)
    return result if limit is None else result.limit(limit)


def literal_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A relation written out as a union of one-row selects of typed literals."""
    fields = [part.split() for part in schema.split(", ")]
    selects = [spark.range(1).select(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows]
    return reduce(DataFrame.union, selects)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names and kinds of the tables of a database, by name."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table string, table_type string, is_temporary boolean").orderBy("table")


def describe(df: DataFrame) -> DataFrame:
    """Column names, types and nullability."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def read_delays_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delay rows from CSV with a header, in any column order or case, with parsed times."""
    text = spark.read.option("header", True).option("escape", '"').csv(path)
    have = {c.lower(): c for c in text.columns}
    cols = []
    for part in DELAYS.split(","):
        name, kind = part.split()
        cols.append((F.col(f"`{have[name]}`") if name in have else F.lit(None)).try_cast(kind).alias(name))
    return text.select(*cols)


def snapshot_time(path, prefix: str):
    """Time in a snapshot name ``<prefix>_yyyyMMdd_HHmmss.parquet``, NULL for other names."""
    return F.try_to_timestamp(F.regexp_extract(path, rf"{prefix}_(\d{{8}}_\d{{6}})\.parquet", 1), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def read_snapshots(spark: SparkSession, folder: str, prefix: str, start: str, end: str) -> DataFrame:
    """Snapshots whose name lies in the window, both ends included; other names are ignored."""
    df = spark.read.parquet(f"{folder}/{prefix}_*.parquet")
    moment = snapshot_time(F.col("_metadata.file_path"), prefix)
    return df.filter(moment.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
