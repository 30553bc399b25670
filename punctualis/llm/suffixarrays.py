"""Suffix-array dedup with a logarithmic family of indexes.

Each shard of candidate regions is worked off in document order, in batches. A new batch gets a suffix array of its
window starts (sorted by the bytes of the window), is scanned for windows that start earlier in the batch, and is
merge-scanned against the sorted arrays of all existing levels; a match of a whole window is a string of at least
``length`` bytes that also starts earlier. Its windows not seen before become a new level, and as long as the last two
levels are of like size they are merged, so there are logarithmically many levels.

Every byte covered by a window that also starts earlier goes; windows are judged on the input.

Defined results: NULL is the empty text; texts shorter than a window stay whole; earlier means a smaller id, or the same id
and an earlier start, so rows with one id that repeat each other at the same place all stay; rows with a NULL id come
after all others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import regions as rg
from punctualis.llm import textkit as tk
from punctualis.llm.fmindex import keyed
from punctualis.llm.shared import table

KIND = rg.Kind(words=False, length=100, gram=28, hot=40_000, shard_units=2_000_000)
BATCH = 1 << 15


def windows(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The window at each start as a fixed-size key; a closing byte keeps trailing zero bytes significant."""
    rows = np.ones((len(starts), length + 1), np.uint8)
    rows[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[starts]
    return rows.view(f"S{length + 1}").ravel()


class Family:
    """Sorted distinct windows in levels of falling size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def known(self, keys: np.ndarray) -> np.ndarray:
        """For sorted keys: is each in some level? A scan along both sorted arrays."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.levels.append(keys)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) >= len(self.levels[-2]):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(np.insert(large, np.searchsorted(large, small), small))


_SPANS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])


def match_shard(rows: pa.Table, length: int = KIND.length, batch: int | None = None) -> pa.Table:
    """Runs of windows that start earlier, of the regions of one shard (copies counted in a weight are not rows of it)."""
    batch = batch or BATCH
    rows = rows.sort_by([("doc_id", "ascending"), ("first", "ascending"), ("h", "ascending")])
    content = rows.column("content").combine_chunks()
    doc, first, n = (rows.column(c).to_numpy() for c in ("doc_id", "first", "n"))
    missing = pc.is_null(rows.column("doc_id")).to_numpy()
    doc = np.where(missing, 0, doc).astype(np.int64)
    # Regions with equal bytes are worked off once, at the first of them; a later one starts earlier in all its windows
    # unless it stands at the very same place of the same id.
    coded = pc.dictionary_encode(content)
    which = coded.indices.to_numpy(zero_copy_only=False)
    lead = np.full(len(coded.dictionary), len(which))
    np.minimum.at(lead, which, np.arange(len(which)))
    lead = lead[which]
    leader = lead == np.arange(len(which))
    same_place = (doc == doc[lead]) & (missing == missing[lead]) & (first == first[lead])
    data, offsets = tk.flat(content)
    family, runs = Family(), []
    work = np.flatnonzero(leader)
    cuts = np.searchsorted(np.cumsum(n[work]), np.arange(batch, n[work].sum() + batch, batch))
    for part in np.split(work, np.unique(np.minimum(cuts + 1, len(work)))):
        if not len(part):
            continue
        owner, step = tk.ragged(n[part])
        owner = part[owner]
        keys = windows(data, offsets[owner] + step, length)
        order = np.argsort(keys, kind="stable")  # the suffix array of the batch
        keys, owner, step = keys[order], owner[order], step[order]
        head = np.r_[True, keys[1:] != keys[:-1]]
        heads = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        first_of = heads[group]
        place = first[owner] + step
        tie = (doc[owner] == doc[owner[first_of]]) & (missing[owner] == missing[owner[first_of]]) & (place == place[first_of])
        known = family.known(keys[heads])
        gone = known[group] | (~head & ~tie)
        runs.append((owner[gone], step[gone]))
        family.add(keys[heads[~known]])
    row = np.concatenate([r for r, _ in runs]) if runs else np.zeros(0, np.int64)
    step = np.concatenate([s for _, s in runs]) if runs else np.zeros(0, np.int64)
    order = np.lexsort((step, row))
    row, step = row[order], step[order]
    edge = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)]) if len(row) else np.zeros(0, np.int64)
    length_of = np.diff(np.r_[edge, len(row)])
    row, step = row[edge], step[edge]
    # Runs of a leader also hold for equal regions at the same place of the same id; other equal regions go as a whole.
    by_lead = np.bincount(row, minlength=len(which))
    begins = np.cumsum(by_lead) - by_lead
    tied = np.flatnonzero(~leader & same_place)
    t_row, t_step = tk.ragged(by_lead[lead[tied]])
    t_at = begins[lead[tied][t_row]] + t_step
    whole = np.flatnonzero(~leader & ~same_place)
    out_row = np.concatenate([row, tied[t_row], whole])
    out_first = np.concatenate([first[row] + step, first[tied[t_row]] + step[t_at], first[whole]])
    out_n = np.concatenate([length_of, length_of[t_at], n[whole]])
    taken = rows.take(pa.array(out_row, pa.int64()))
    return pa.Table.from_arrays([taken.column("doc_id").combine_chunks(), taken.column("h").combine_chunks(), pa.array(out_first.astype(np.int32)), pa.array(out_n.astype(np.int32))], schema=_SPANS)


def remove_repeats(docs: DataFrame, kind: rg.Kind = KIND) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left)."""
    docs = keyed(docs)
    spans = rg.repeated_windows(docs, kind, lambda t: match_shard(t, kind.length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.flat(batch.column("text"))
            for a, b in tk.chunks(offsets):
                part, units = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                gone = rg.covered_units(kind, units, batch.column("runs").slice(a, b - a))
                count = np.concatenate([[0], np.cumsum(gone)])
                removed = np.diff(count[units])
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                edges = units[:-1][np.diff(units) > 0]
                begins[edges] = gone[edges]
                spans_of = np.diff(np.concatenate([[0], np.cumsum(begins)])[units])
                kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((units - count[units]).astype(np.int64)), pa.py_buffer(part[~gone].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(units)), pa.array(removed), pa.array(spans_of), kept.cast(pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    return rg.with_spans(docs, spans).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op10_suffix_array_dedup": op10_suffix_array_dedup}
SQL: dict[str, str] = {}
