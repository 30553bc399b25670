"""Substring dedup with a compressed FM-index per shard.

Each shard of candidate regions gets an FM-index over its distinct regions: suffix array by prefix doubling, the BWT in
a wavelet matrix of packed bits with block counts, and the number of occurrences of each region as weights along the
suffix array. The regions are then streamed against it: backward search finds, for an end position, the longest
match that occurs twice or more in the shard (its matching statistic), and all windows inside a match of at
least ``length`` words are reported. All regions of a shard step together, vectorised. A failed extension rules out
every window that contains it, so the next end is the last one that avoids it.

Every word covered by a repeated window goes, first occurrences too; windows are judged on the input.

Defined results: NULL and blank texts have no words and keep nothing (the digest of the empty text); texts shorter than a
window stay whole; repeated rows are documents of their own (all copies lose what repeats); a NULL id is an id; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import regions as rg
from punctualis.llm import textkit as tk
from punctualis.llm.shared import table

KIND = rg.Kind(words=True, length=35, gram=12, hot=40_000, shard_units=1_500_000)


class WaveletMatrix:
    """Rank over a sequence of symbols: one packed bit vector per bit of the alphabet, counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray, int]] = []
        self.alphabet, size = alphabet, len(symbols)
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            blocks = np.zeros(size // 64 + 1, np.uint64)
            blocks.view(np.uint8)[: len(packed)] = packed
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks[:-1]), dtype=np.int64)]).astype(np.int32)
            self.levels.append((np.uint64(bit), blocks, counts, size - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.starts = self._descend(np.arange(alphabet, dtype=np.uint64), np.zeros(alphabet, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, blocks, counts, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[block] + np.bitwise_count(blocks[block] & mask)
            at = np.where(symbols >> bit & np.uint64(1), zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._descend(symbols.astype(np.uint64), at) - self.starts[symbols]


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Prefix doubling; the values must make all suffixes differ within a bounded length (unique separators)."""
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    n, step = len(values), 1
    while True:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, key[order[1:]] != key[order[:-1]]])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


class FMIndex:
    """Over regions of words (symbols 1 to alphabet - 1, regions closed by separators), with a weight per region."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray, weights: np.ndarray, alphabet: int):
        count, lengths = len(offsets) - 1, np.diff(offsets)
        owner, place = tk.ragged(lengths + 1)
        closing = place == lengths[owner]
        text = np.zeros(len(owner), np.int64)
        text[~closing] = symbols
        order = suffix_array(np.where(closing, owner, text + count))
        bwt = text[order - 1]
        self.size, self.alphabet = len(text), alphabet
        self.first = np.searchsorted(text[order], np.arange(alphabet))
        self.weights = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        self.tree = WaveletMatrix(bwt, alphabet)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array ranges after one more symbol in front."""
        both = self.tree.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        return self.first[symbols] + both[: len(symbols)], self.first[symbols] + both[len(symbols) :]

    def occurrences(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weights[high] - self.weights[low]


def repeated_runs(index: FMIndex, symbols: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Region, start and end (in words) of matches of at least ``length`` words that occur twice or more in the index."""
    base, end = offsets[:-1].copy(), np.diff(offsets)
    region = np.flatnonzero(end >= length)
    base, end = base[region], end[region]
    start, low, high = end.copy(), np.zeros(len(end), np.int64), np.full(len(end), index.size)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(region):
        new_low, new_high = index.extend(symbols[base + start - 1], low, high)
        further = index.occurrences(new_low, new_high) >= 2
        low, high = np.where(further, new_low, low), np.where(further, new_high, high)
        start = start - further
        stop = ~further | (start == 0)
        hit = stop & (end - start >= length)
        out.append((region[hit], start[hit], end[hit]))
        # After a failure at start - 1 every further window ends before ``end`` and starts at start - 1 or before.
        end = np.where(stop, np.where(further, 0, np.minimum(end - 1, start - 1 + length)), end)
        low, high, start = np.where(stop, 0, low), np.where(stop, index.size, high), np.where(stop, end, start)
        alive = end >= length
        if not alive.all():
            region, base, end, start, low, high = (x[alive] for x in (region, base, end, start, low, high))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


_SPANS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])


def match_shard(rows: pa.Table, length: int = KIND.length) -> pa.Table:
    """Runs of repeated windows of the regions of one shard."""
    content = rows.column("content").combine_chunks().dictionary_encode()
    if isinstance(content, pa.ChunkedArray):
        content = content.combine_chunks()
    which = content.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    weights = np.bincount(which, rows.column("weight").to_numpy(), len(content.dictionary)).astype(np.int64)
    data, byte_offsets = tk.flat(content.dictionary)
    starts, ends, offsets = tk.word_spans(data, byte_offsets)
    names, symbols = np.unique(tk.span_hashes(data, starts, ends), return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    index = FMIndex(symbols, offsets, weights, len(names) + 1)
    region, start, end = repeated_runs(index, symbols, offsets, length)
    # Matches of a distinct region go to every row that has it.
    order = np.argsort(region, kind="stable")
    region, start, end = region[order], start[order], end[order]
    per_region = np.bincount(region, minlength=len(weights))
    row, step = tk.ragged(per_region[which])
    at = (np.cumsum(per_region) - per_region)[which[row]] + step
    first = rows.column("first").to_numpy()[row] + start[at]
    taken = rows.take(pa.array(row))
    return pa.Table.from_arrays([taken.column("doc_id").combine_chunks(), taken.column("h").combine_chunks(), pa.array(first.astype(np.int32)), pa.array((end - start - length + 1)[at].astype(np.int32))], schema=_SPANS)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))


def remove_repeats(docs: DataFrame, kind: rg.Kind = KIND) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    docs = keyed(docs)
    spans = rg.repeated_windows(docs, kind, lambda t: match_shard(t, kind.length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.flat(batch.column("text"))
            for a, b in tk.chunks(offsets):
                part = data[offsets[a] : offsets[b]]
                starts, ends, units = tk.word_spans(part, offsets[a : b + 1] - offsets[a])
                gone = rg.covered_units(kind, units, batch.column("runs").slice(a, b - a))
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[units])
                # One space after every kept word: keep the words and the first separator byte behind each.
                text = []
                raw = part.tobytes()
                for i in range(b - a):
                    x, y = units[i], units[i + 1]
                    kept = np.flatnonzero(~gone[x:y]) + x
                    text.append(b" ".join(raw[p:q] for p, q in zip(starts[kept].tolist(), ends[kept].tolist())) if removed[i] else b" ".join(raw[starts[x] : ends[y - 1]].split()) if y > x else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(units)), pa.array(removed), pa.array(text, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"]
                )

    return rg.with_spans(docs, spans).mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def op8_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op8_fm_substring_dedup": op8_fm_substring_dedup}
SQL = {
    "op8_fm_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM rep),
wds AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT wds.rid, string_agg(word, ' ' ORDER BY wds.p) AS kept, count(*) AS n FROM wds ANTI JOIN gone ON wds.rid = gone.rid AND wds.p = gone.p GROUP BY wds.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""
}
