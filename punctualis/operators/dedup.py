"""Latest-wins, exact deduplication and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of every key in the given order.

    The rank filter lets Spark cut each map partition down to ``n`` rows per key before the
    shuffle (WindowGroupLimit), so a key that holds most of the rows does not load one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def dedup_exact(df: DataFrame) -> DataFrame:
    """Remove rows that are equal in all columns."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: total and distinct row counts, from a single grouped pass."""
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return grouped.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def shuffle_rank(id_cols: Sequence[str], seed: int) -> Column:
    """A random-looking but repeatable sort key, so a recomputed task draws the same sample."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in id_cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *text))


def sample_per_group(
    df: DataFrame, group: Column, n: int, id_cols: Sequence[str], seed: int = 0, salts: int = 64
) -> DataFrame:
    """Random sample of at most ``n`` rows per group.

    A group is first cut to ``n`` rows in each of ``salts`` slices, so the final ranking of a group
    never sees more than ``n * salts`` rows. A slice takes whole partitions of the input, so each partition is
    cut to ``n`` rows of a group before the shuffle; which slice a row is in does not matter to the result.
    ``id_cols`` must identify a row.
    """
    keyed = df.withColumn("_grp", group).withColumn("_draw", shuffle_rank(id_cols, seed))
    keyed = keyed.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(salts)))
    cut = latest_per_key(keyed, ["_grp", "_slice"], [F.col("_draw")], n)
    return latest_per_key(cut, ["_grp"], [F.col("_draw")], n).drop("_grp", "_draw", "_slice")
