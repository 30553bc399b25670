"""Candidate regions for repeated windows, shared by the two substring operators.

A window is ``length`` consecutive units (words or bytes) of one text. Its anchor is the run of ``gram`` units in it with
the least hash (the leftmost of equal ones), which depends on the window's content only: equal windows have equal
anchors at equal places. Consecutive windows with one anchor form a region; every window lies in exactly one.
Only regions whose anchor occurs twice or more can hold a repeated window, so only they are cut out of the texts
and dealt to shards by anchor. The number of shards follows the amount of candidate text.

An anchor with more than ``hot`` occurrences doesn't go to a shard as it is. Its regions are counted by content first (a
pre-aggregated group) and only the earliest of equal ones goes on, with the number of them; all others of it repeat
an earlier region whole. Where more than ``hot`` different regions are left, they are split into single windows, which
are counted in the same way and dealt by content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.shared import stored

FILTER_BITS = 1 << 24
_PLACE_BITS = 31  # the hash keeps 33 bits in comparisons, the same for every text


@dataclass(frozen=True)
class Kind:
    words: bool
    length: int
    gram: int
    hot: int
    shard_units: int


def unit_spans(kind: Kind, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the units of all texts, and the unit offsets between the texts."""
    if kind.words:
        return tk.word_spans(data, offsets)
    place = np.arange(len(data))
    return place, place + 1, offsets


def find_regions(kind: Kind, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, anchor hash, first window and number of windows of each region."""
    if kind.words:
        starts, ends, units = tk.word_spans(data, offsets)
        values = tk.span_hashes(data, starts, ends)
    else:
        values, units = tk.BYTE_VALUES[data], offsets
    lengths = np.diff(units)
    if not len(lengths) or lengths.max(initial=0) < kind.length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = tk.window_hashes(values, kind.gram)
    keys = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    least = tk.sliding_min(keys, kind.length - kind.gram + 1)
    owner, place = tk.ragged(np.maximum(lengths - kind.length + 1, 0))
    at = (least[units[owner] + place] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    return owner[edge], grams[at[edge]], place[edge], np.diff(np.r_[edge, len(at)])


def _per_chunk(kind: Kind, texts: pa.Array):
    data, offsets = tk.flat(texts)
    for a, b in tk.chunks(offsets):
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def anchors(docs: DataFrame, kind: Kind) -> DataFrame:
    """anchor, doc_id, h, first, n of every region of the documents (doc_id, h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("h")
            for a, data, offsets in _per_chunk(kind, batch.column("text")):
                owner, anchor, first, n = find_regions(kind, data, offsets)
                rows = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), ids.take(rows), hashes.take(rows), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], ["anchor", "doc_id", "h", "first", "n"]
                )

    return docs.mapInArrow(run, "anchor bigint, doc_id bigint, h bigint, first int, n int")


def shared_marks(docs: DataFrame, kind: Kind) -> DataFrame:
    """Per document the regions whose anchor occurs twice or more: doc_id, h, marks (anchor, first, n, hot).

    The counts are stored, so both sides of the join come straight from a shuffle and hot anchors can be split.
    """
    found = anchors(docs, kind)
    counts = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "anchors")
    marks = found.join(counts, "anchor").select("doc_id", "h", F.struct("anchor", "first", "n", (F.col("times") > kind.hot).alias("hot")).alias("mark"))
    return marks.groupBy("doc_id", "h").agg(F.collect_set("mark").alias("marks"))


_CUT = "anchor bigint, doc_id bigint, h bigint, first int, n int, content binary"


def cut(docs: DataFrame, marks: DataFrame, kind: Kind) -> DataFrame:
    """The text of each marked region (_CUT); words are joined by one space."""
    renamed = marks.select(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h"), "marks")
    joined = docs.join(renamed, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("h") == F.col("m_h"))).select("doc_id", "h", "text", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, lists = batch.column("doc_id"), batch.column("h"), batch.column("marks")
            for a, data, offsets in _per_chunk(kind, batch.column("text")):
                starts, ends, units = unit_spans(kind, data, offsets)
                mine = lists.slice(a, len(offsets) - 1)
                owner = np.repeat(np.arange(len(mine)), mine.value_lengths().to_numpy(zero_copy_only=False))
                marks = mine.flatten()
                anchor, first, n = (marks.field(f).to_numpy(zero_copy_only=False) for f in ("anchor", "first", "n"))
                low = units[owner] + first
                begin, end = starts[low], ends[low + n + kind.length - 2]
                raw = data.tobytes()
                content = [raw[x:y] for x, y in zip(begin.tolist(), end.tolist())]
                if kind.words:
                    content = [b" ".join(c.split()) for c in content]
                rows = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), ids.take(rows), hashes.take(rows), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(content, pa.binary())],
                    list(_ROWS),
                )

    return joined.mapInArrow(run, _CUT)


_SPANS = "doc_id bigint, h bigint, first int, n int"
_ROWS = ("anchor", "doc_id", "h", "first", "n", "content")


def collapse(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The earliest of rows with equal content, with their number as weight, and the runs of all others.

    Rows at the same place of the same id are all earliest.
    """
    rows = stored(rows.select(*_ROWS).withColumn("digest", F.sha2("content", 256)), name)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("first").alias("at"))
    counts = stored(rows.groupBy("digest").agg(F.min(order).alias("low"), F.count(F.lit(1)).alias("weight")), f"{name}-counts")
    both = rows.join(counts, "digest")
    lowest = F.col("doc_id").eqNullSafe(F.col("low.id")) & (F.col("first") == F.col("low.at"))
    return both.where(lowest).select(*_ROWS, "weight", "digest"), both.where(~lowest).select("doc_id", "h", "first", "n")


def split_windows(regions: DataFrame, kind: Kind) -> DataFrame:
    """Every window of the regions as a row of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            data, offsets = tk.flat(batch.column("content"))
            for a, b in tk.chunks(offsets, tk.CHUNK_BYTES // 8):
                part = data[offsets[a] : offsets[b]]
                starts, ends, units = unit_spans(kind, part, offsets[a : b + 1] - offsets[a])
                owner, step = tk.ragged(n[a:b])
                low = units[owner] + step
                raw = part.tobytes()
                content = [raw[x:y] for x, y in zip(starts[low].tolist(), ends[low + kind.length - 1].tolist())]
                rows = batch.take(pa.array(owner + a))
                first = pa.array((rows.column("first").to_numpy() + step).astype(np.int32))
                one = pa.array(np.ones(len(owner), np.int32))
                yield pa.RecordBatch.from_arrays([rows.column("anchor"), rows.column("doc_id"), rows.column("h"), first, one, pa.array(content, pa.binary())], list(_ROWS))

    return regions.select(*_ROWS).mapInArrow(run, "anchor bigint, doc_id bigint, h bigint, first int, n int, content binary")


def near_marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The documents that may have a hot region, before they are shuffled: a filter of ``FILTER_BITS`` hashed bits.

    It has a fixed size and lets every marked document through; the more documents are marked, the more others pass.
    """
    place = F.pmod("h", F.lit(FILTER_BITS))
    hot = marks.where(F.exists("marks", lambda m: m["hot"])).select(F.floor(place / 63).alias("word"), (place % 63).cast("int").alias("bit"))
    words = hot.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 63 + 1, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("h").to_numpy() % FILTER_BITS
            yield batch.filter(pa.array((shared.value[at // 63] >> (at % 63) & 1).astype(bool)))

    return docs.mapInArrow(run, docs.schema)


def repeated_windows(docs: DataFrame, kind: Kind, match: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """doc_id, h, first, n: runs of windows that ``match`` reports.

    ``match`` gets the rows of a shard (doc_id, h, first, n, weight, content) and returns runs (doc_id, h, first, n) of
    them. Both operators remove every occurrence of a repeated window but at most the earliest, so occurrences that
    ``collapse`` leaves out need no further look.

    Regions are not stored: the caller's join of the runs with the documents is then part of one query with the cut,
    and Spark shuffles the texts once for both.
    """
    marks = stored(shared_marks(docs, kind), "marks")
    totals = marks.select(F.explode("marks").alias("m")).groupBy("m.hot").agg(F.sum(F.col("m.n") + kind.length))
    by_heat = {r[0]: r[1] for r in totals.collect()}

    def regions(heat: bool, texts: DataFrame) -> DataFrame:
        mine = marks.withColumn("marks", F.filter("marks", lambda m: m["hot"] == heat))
        return cut(texts, mine.where(F.size("marks") > 0), kind)

    def dealt(rows: DataFrame, by: str, units: int) -> DataFrame:
        shards = max(1, -(-units // kind.shard_units))
        sharded = rows.select(F.pmod(F.xxhash64(by), F.lit(shards)).alias("shard"), "doc_id", "h", "first", "n", "weight", "content")
        return sharded.groupBy("shard").applyInArrow(lambda t: match(t.drop_columns(["shard"])), _SPANS)

    def units(rows: DataFrame) -> int:
        return rows.agg(F.sum(F.col("n") + kind.length)).first()[0] or 0

    cold = dealt(regions(False, docs).withColumn("weight", F.lit(1).cast("bigint")), "anchor", by_heat.get(False, 0))
    if True not in by_heat:
        return cold
    leads, others = collapse(regions(True, near_marked(docs, marks)), "hot-regions")
    leads = stored(leads, "leads")
    counts = stored(leads.groupBy("anchor").agg(F.count(F.lit(1)).alias("regions")), "lead-counts")
    leads = leads.join(counts, "anchor")
    few = leads.where(F.col("regions") <= kind.hot)
    spans = cold.unionByName(others).unionByName(dealt(few, "anchor", units(few)))
    if counts.where(F.col("regions") > kind.hot).isEmpty():
        return spans
    # A lead that stands for several regions is repeated whole where ``match`` says so of its weight: keep the weight.
    many = leads.where(F.col("regions") > kind.hot)
    copied = many.where("weight > 1").select(*_ROWS, "weight")
    windows, other_windows = collapse(split_windows(many, kind), "hot-windows")
    weights = split_windows(copied, kind).select("doc_id", "h", "first", F.lit(1).alias("copied"))
    same = ["doc_id", "h", "first"]
    keys = [F.col(f"w.{c}").eqNullSafe(F.col(f"c.{c}")) for c in same]
    windows = windows.alias("w").join(weights.alias("c"), keys, "left").select("w.*", F.coalesce("copied", F.lit(0)).alias("copied"))
    windows = windows.withColumn("weight", F.col("weight") + F.col("copied"))
    return spans.unionByName(other_windows).unionByName(dealt(windows, "digest", units(windows)))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents (doc_id, h, text) with their runs of windows as a list (NULL for none)."""
    listed = spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("first", "n")).alias("runs"))
    listed = listed.select(F.col("doc_id").alias("s_id"), F.col("h").alias("s_h"), "runs")
    return docs.join(listed, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("h") == F.col("s_h")), "left").select("doc_id", "text", "runs")


def covered_units(kind: Kind, units: np.ndarray, runs: pa.Array) -> np.ndarray:
    """True for every unit covered by a reported window (unit offsets and runs of the same texts)."""
    owner = np.repeat(np.arange(len(runs)), runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = runs.drop_null().flatten()
    first, n = flat.field("first").to_numpy(zero_copy_only=False), flat.field("n").to_numpy(zero_copy_only=False)
    return tk.run_mask(int(units[-1]), units[owner] + first, n + kind.length - 1)
