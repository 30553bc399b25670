"""Benchmark decontamination by greedy string tiling.

Words are compared lower-cased and without ASCII punctuation; letters of scripts that set no spaces between words (Han,
kana, Thai, Lao, Khmer, Burmese) are one word each, and the full-width punctuation around them separates. Runs of ``seed`` words of the benchmark items are hashed
by a rolling (Karp-Rabin) hash; each document is rolled over once and joined with the seeds it shares. Hits on one
diagonal grow to maximal matches. The longest match is marked first, matches that run into marked words are cut to
what is left, and so on until no match of ``seed`` words remains. The covered share of an item counts, whatever the
order of its parts, so reordered passages are caught. An item of fewer than ``seed`` words is its own seed: it is
covered where all its words occur in a row.

The items are the stated query set: they go over the documents in blocks of about ``block_bytes`` of text. With one
block nothing is shuffled. With several, the findings of each are written to the shared folder and its broadcast is
released before the next block is read, so neither the driver nor an executor holds more than one. Equal items are
tiled once.

Defined results: NULL and empty texts match nothing, nor do items without a word; items with a NULL id are reported under NULL; repeated documents and repeated items give repeated
rows; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.shared import fresh, stored, table

SEED, COVERAGE, BLOCK_BYTES = 5, 0.5, 8 << 20
PUNCTUATION = tk.SEPARATOR | np.isin(np.arange(256), [c for c in range(128) if not chr(c).isalnum()])
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
WIDE_PUNCTUATION = "[\u3000-\u3004\u3008-\u3020\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]"
_FILTER_BITS = 20
PAIR_SCHEMA = "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, longest bigint, tiles bigint, coverage double"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words of all texts and the word offsets between the texts."""
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    data, offsets = tk.flat(texts)
    if (data >= 0xE0).any():  # the first byte of every letter of these scripts
        spaced = pc.replace_substring_regex(texts.cast(pa.large_string()), WIDE_PUNCTUATION, " ")
        data, offsets = tk.flat(pc.replace_substring_regex(spaced, UNSPACED, r" \0 "))
    hashes, counts = [], []
    for a, b in tk.chunks(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, words = tk.word_spans(part, offsets[a : b + 1] - offsets[a], PUNCTUATION)
        hashes.append(tk.span_hashes(part, starts, ends))
        counts.append(np.diff(words))
    lengths = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(lengths)])


@dataclass
class Seeds:
    """Sorted seeds of one width with their item and position, and a bitmap of their first bits."""

    hashes: np.ndarray
    item: np.ndarray
    at: np.ndarray
    bits: np.ndarray


@dataclass
class Items:
    """One block of benchmark items: words, their offsets, ids of equal items, seeds by width."""

    words: np.ndarray
    offsets: np.ndarray
    ids: list[list[int | None]]
    seeds: dict[int, Seeds]


def build_items(rows: list[tuple[int | None, str | None]], seed: int) -> Items:
    words, offsets = word_hashes(pa.array([text for _, text in rows], pa.string()))
    ids: dict[bytes, list[int | None]] = {}
    for (item_id, _), a, b in zip(rows, offsets, offsets[1:]):
        if b > a:
            ids.setdefault(words[a:b].tobytes(), []).append(item_id)
    sequences = [np.frombuffer(key, np.uint64) for key in ids]
    lengths = np.array([len(s) for s in sequences], np.int64)
    words = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    widths = np.minimum(lengths, seed)
    seeds = {}
    for width in np.unique(widths).tolist():
        item, at = tk.ragged(np.where(widths == width, lengths - width + 1, 0))
        hashes = tk.window_hashes(words, width)[offsets[item] + at]
        order = np.argsort(hashes, kind="stable")
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        seeds[width] = Seeds(hashes[order], item[order], at[order], bits)
    return Items(words, offsets, list(ids.values()), seeds)


def tile(item: np.ndarray, doc: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seed hits: tiles (length, item position, document position), longest first."""
    diagonal = doc_at - item_at
    order = np.lexsort((item_at, diagonal))
    i, d = item_at[order], diagonal[order]
    breaks = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1)])
    ends = np.r_[breaks[1:], len(i)]
    queue = [(-(int(i[e - 1] - i[b]) + seed), int(i[b]), int(i[b] + d[b])) for b, e in zip(breaks, ends)]
    heapq.heapify(queue)
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles = []
    while queue:
        negative, a, b = heapq.heappop(queue)
        n = -negative
        taken = used_item[a : a + n] | used_doc[b : b + n]
        if not taken.any():
            if np.array_equal(item[a : a + n], doc[b : b + n]):
                used_item[a : a + n] = used_doc[b : b + n] = True
                tiles.append((n, a, b))
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True].astype(np.int8)))
        for x, y in zip(edges[::2], edges[1::2]):
            if y - x >= seed:
                heapq.heappush(queue, (-int(y - x), a + int(x), b + int(x)))
    return tiles


def find(texts: pa.Array, items: Items, coverage: float) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text number, item number, item words, covered words, longest tile, tiles) of covered items."""
    if not items.seeds:
        return
    words, offsets = word_hashes(texts)
    for width, seeds in items.seeds.items():
        rolled = tk.window_hashes(words, width)
        maybe = np.flatnonzero(seeds.bits[rolled >> np.uint64(64 - _FILTER_BITS)])
        low, high = np.searchsorted(seeds.hashes, rolled[maybe], "left"), np.searchsorted(seeds.hashes, rolled[maybe], "right")
        owner = np.searchsorted(offsets, maybe, "right") - 1
        keep = (high > low) & (maybe + width <= offsets[owner + 1])
        maybe, low, high, owner = maybe[keep], low[keep], high[keep], owner[keep]
        for text in np.unique(owner):
            mine = slice(*np.searchsorted(owner, [text, text + 1]))
            hit, step = tk.ragged(high[mine] - low[mine])
            shared = low[mine][hit] + step
            found, doc_at, item_at = seeds.item[shared], maybe[mine][hit] - offsets[text], seeds.at[shared]
            order = np.argsort(found, kind="stable")
            numbers, firsts = np.unique(found[order], return_index=True)
            for number, part in zip(numbers, np.split(order, firsts[1:])):
                item = items.words[items.offsets[number] : items.offsets[number + 1]]
                if tk.run_mask(len(item), np.unique(item_at[part]), width).sum() < coverage * len(item):
                    continue
                tiles = tile(item, words[offsets[text] : offsets[text + 1]], item_at[part], doc_at[part], width)
                covered = sum(n for n, _, _ in tiles)
                if covered >= coverage * len(item):
                    yield int(text), int(number), len(item), covered, tiles[0][0], len(tiles)


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_bytes`` of text."""
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    count = -(-total // block_bytes)
    return [rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == n) for n in range(count)]


def _by_block(rows: DataFrame, parts: list[DataFrame], seed: int, schema, of_batch: Callable[[pa.RecordBatch, Items], pa.RecordBatch]) -> list[DataFrame]:
    """``of_batch`` of every batch of ``rows`` with each block; of several blocks, one after the other is finished and released."""

    def run_with(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield of_batch(batch, shared.value)

        return run

    found = []
    for part in parts:
        shared = rows.sparkSession.sparkContext.broadcast(build_items([tuple(r) for r in part.collect()], seed))
        result = rows.mapInArrow(run_with(shared), schema)
        if len(parts) > 1:
            result = stored(result, "decontaminate")
            shared.destroy()
        found.append(result)
    return found


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and covered item (PAIR_SCHEMA)."""

    def pairs(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        rows = [(ids[t], i, n, c, longest, tiles, c / n) for t, number, n, c, longest, tiles in find(batch.column("text"), items, coverage) for i in items.ids[number]]
        kinds = [pa.int64()] * 6 + [pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], _NAMES)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = _by_block(texts, blocks(benchmark, block_bytes), seed, PAIR_SCHEMA, pairs)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], PAIR_SCHEMA)


_NAMES = [part.split()[0] for part in PAIR_SCHEMA.split(", ")]


def decontaminate(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that cover no item, all columns. One block is filtered in place; several leave the digests of covered texts, which are joined away."""
    parts = blocks(benchmark, block_bytes)

    def clean(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
        keep = np.ones(batch.num_rows, bool)
        keep[[t for t, *_ in find(batch.column("text"), items, coverage)]] = False
        return batch.filter(pa.array(keep))

    def covered(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
        texts = batch.column("text")
        rows = sorted({t for t, *_ in find(texts, items, coverage)})
        return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(texts[t].as_py().encode()).hexdigest() for t in rows], pa.string())], ["digest"])

    if len(parts) < 2:
        return reduce(lambda _, kept: kept, _by_block(docs, parts, seed, docs.schema, clean), docs)
    dirty = reduce(DataFrame.unionByName, _by_block(docs.select("text"), parts, seed, "digest string", covered)).distinct()
    name = fresh(docs, "digest")
    return docs.join(dirty.withColumnRenamed("digest", name), F.sha2("text", 256) == F.col(name), "left_anti")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontaminate": op4_decontaminate}
SQL: dict[str, str] = {}
