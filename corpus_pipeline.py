"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import decontaminate as benchmarks
from punctualis.llm import langid, linededup, minhash, packing
from punctualis.llm.shared import fresh, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn languages from the labelled rows; only texts without a letter go, also where no row is labelled."""
    model = langid.fit(docs.select("lang", "text"))
    if not model.languages:
        return langid.with_letters(docs)
    new = tuple(fresh(docs, name) for name in langid.OUTPUT)
    return langid.identify(docs, model, new=new).where(F.size(new[2]) > 0).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later similar lines go, and documents that consist of nothing else; ``n_chars`` follows the text."""
    left = linededup.remove_lines(docs, least=linededup.EVERY_LINE)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8."""
    return minhash.near_dedup(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go."""
    return benchmarks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE_SQL = None  # language ID, tiling and packing can't be expressed in SQL; tests/llm has a brute-force version
SQL: dict[str, str] = {}
