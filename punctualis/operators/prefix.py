"""Running values over ordered groups of any size.

A plain ordered window sends a whole group to one task. Here a group is cut into chunks along its
order; each chunk is a window of its own, and only one summary row per chunk is ordered per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

CHUNK_VALUES = 100_000


def has_maps(kind: DataType) -> bool:
    """True when values of the type have no order, since a map is in them."""
    if isinstance(kind, StructType):
        return any(has_maps(f.dataType) for f in kind)
    return isinstance(kind, ArrayType) and has_maps(kind.elementType) or isinstance(kind, (MapType, VariantType))


def sessionize_resets(
    df: DataFrame,
    keys: Sequence[str] = ("trip_id", "mode"),
    ts: str = "load_timestamp",
    seq: str = "stop_sequence",
    chunk: str = "hour",
) -> DataFrame:
    """Add ``change_indicator`` (the sequence fell) and ``session_id`` (falls so far).

    Order inside a key is (ts, seq), then the other columns. A chunk is one ``chunk`` of ``ts``. Since the order is over whole
    rows, both passes want the same rows in the same chunks: ``df`` is computed and dealt once, with all its columns, so select
    those that are needed. Columns with maps have no order; a table that holds some is dealt twice.
    """
    # struct keys compare NULL parts as equal, so no row is lost in the join
    rest = [f for f in df.schema if f.name not in (*keys, ts, seq)]
    packed = df.select(F.struct(*keys, F.date_trunc(chunk, F.col(ts)).alias("_at")).alias("_chunk"), ts, seq, F.struct(*[f.name for f in rest], F.lit(0).alias("_all")).alias("_rest"))
    sortable = [] if has_maps(StructType(rest)) else [F.col("_rest")]
    inside = Window.partitionBy("_chunk").orderBy(ts, seq, *sortable)
    rows = packed.withColumn("_fell", F.when(F.col(seq) < F.lag(seq).over(inside), 1).otherwise(0))
    rows = rows.withColumn("_n", F.row_number().over(inside))

    summary = rows.groupBy("_chunk").agg(
        F.min_by(seq, "_n").alias("_first"), F.max_by(seq, "_n").alias("_last"), F.sum("_fell").alias("_falls")
    )
    across = Window.partitionBy("_key").orderBy("_chunk")
    summary = summary.withColumn("_key", F.struct(*[F.col(f"_chunk.{k}") for k in keys]))
    summary = summary.withColumn("_edge", F.when(F.col("_first") < F.lag("_last").over(across), 1).otherwise(0))
    before = F.sum(F.col("_falls") + F.col("_edge")).over(across) - F.col("_falls")
    summary = summary.select("_chunk", "_edge", before.alias("_before"))

    running = F.sum("_fell").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_running", running)
    indicator = F.when(F.col("_n") == 1, F.col("_edge")).otherwise(F.col("_fell"))
    place = {**{k: f"_chunk.{k}" for k in keys}, ts: ts, seq: seq}
    return rows.join(summary, "_chunk", "inner").select(
        *[F.col(place.get(c, f"_rest.{c}")).alias(c) for c in df.columns],
        indicator.cast("int").alias("change_indicator"),
        (F.col("_running") + F.col("_before")).alias("session_id"),
    )


def reset_summaries(df: DataFrame, keys: Sequence[str], ts: str, seq: str, chunk: str = "hour") -> DataFrame:
    """keys, first, last, falls: first and last sequence of every key, and how often it fell, as by ``sessionize_resets``.

    Rows are dealt and ordered once, in the same chunks; what follows works on a row per chunk.
    """
    packed = df.select(F.struct(*keys, F.date_trunc(chunk, F.col(ts)).alias("_at")).alias("_chunk"), ts, seq)
    inside = Window.partitionBy("_chunk").orderBy(ts, seq)
    rows = packed.withColumns({"_fell": F.when(F.col(seq) < F.lag(seq).over(inside), 1).otherwise(0), "_n": F.row_number().over(inside)})
    summary = rows.groupBy("_chunk").agg(F.min_by(seq, "_n").alias("_first"), F.max_by(seq, "_n").alias("_last"), F.sum("_fell").alias("_falls"))
    summary = summary.withColumn("_key", F.struct(*[F.col(f"_chunk.{k}") for k in keys]))
    edge = F.when(F.col("_first") < F.lag("_last").over(Window.partitionBy("_key").orderBy("_chunk")), 1).otherwise(0)
    of_key = summary.withColumn("_falls", F.col("_falls") + edge).groupBy("_key")
    whole = of_key.agg(F.min_by("_first", "_chunk").alias("first"), F.max_by("_last", "_chunk").alias("last"), F.sum("_falls").alias("falls"))
    return whole.select("_key.*", "first", "last", "falls")


def cut_evenly(counted: DataFrame, value: str) -> DataFrame:
    """Cut every ``_chunk`` into parts that keep the order of its values, about ``CHUNK_VALUES`` rows each.

    A chunk of n rows is cut into n / ``CHUNK_VALUES`` parts of equal width between its least and its greatest finite value, first
    by logarithm, which spreads long tails, then every part by its own rows and ends on the plain scale. Cuts follow from
    counts and ends alone, so a repeated task cuts alike. Infinite values have parts of their own.
    """
    v = F.col(value).cast("double") / 2  # so that no width overflows
    for scaled in (F.signum(v) * F.log1p(F.abs(v)), v):
        finite = F.when(F.abs(v) < float("inf"), scaled)  # NaN is above infinity
        ends = counted.groupBy("_chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK_VALUES).alias("_parts"), F.min(finite).alias("_lo"), F.max(finite).alias("_hi"))
        width = F.col("_hi") - F.col("_lo")
        inside = F.least(F.col("_parts") - 1, F.floor((scaled - F.col("_lo")) / F.when(width > 0, width) * F.col("_parts")))
        part = F.when(finite.isNull(), F.when(v < 0, -1).otherwise(F.col("_parts"))).otherwise(F.coalesce(inside, F.lit(0)))
        counted = counted.join(ends, "_chunk", "inner").withColumn("_chunk", F.struct("_chunk", part.cast("long").alias("_no"))).drop("_parts", "_lo", "_hi")
    return counted


def cumulative_counts(df: DataFrame, value: str, groups: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Distinct values per group with ``cnt`` rows, ``below`` rows under them and ``total`` rows.

    NULL values are left out. Equal values are merged before the shuffle; the distinct values of a group are then ordered in
    chunks of about ``CHUNK_VALUES``, so their number follows the data.
    """
    groups = list(groups)
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(rows.alias("cnt"))
    # struct keys compare NULL parts as equal, so no row is lost in the joins
    counted = counted.withColumn("_grp", F.struct(*groups, F.lit(0).alias("_all")))
    counted = cut_evenly(counted.withColumn("_chunk", F.struct("_grp")), value)

    sizes = counted.groupBy("_chunk", "_grp").agg(F.sum("cnt").alias("_size"))
    whole = Window.partitionBy("_grp")
    before = F.sum("_size").over(whole.orderBy("_chunk")) - F.col("_size")
    sizes = sizes.select("_chunk", before.alias("_before"), F.sum("_size").over(whole).alias("total"))

    inside = Window.partitionBy("_chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_inside", F.sum("cnt").over(inside) - F.col("cnt"))
    return ranked.join(sizes, "_chunk", "inner").select(
        *groups, value, "cnt", (F.col("_inside") + F.col("_before")).alias("below"), "total"
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], groups: Sequence[str] = (), ranked: DataFrame | None = None
) -> DataFrame:
    """Quantiles with linear interpolation, one column per entry of ``probs``."""
    ranked = cumulative_counts(df, value, groups) if ranked is None else ranked

    def at(position: Column) -> Column:
        hit = (F.col("below") <= position) & (position < F.col("below") + F.col("cnt"))
        return F.max(F.when(hit, F.col(value)).cast("double"))

    aggs = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.floor(position), F.ceil(position)
        part = F.max(position - low)
        aggs.append((at(low) + (at(high) - at(low)) * part).alias(name))
    return ranked.groupBy(*groups).agg(*aggs)
