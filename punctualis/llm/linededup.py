"""Line dedup by an exact set-similarity join of the distinct words of lines.

1. Lines with equal word sets form a class (128-bit digest, pre-aggregated); its first line stands for it.
2. The words of a line are put in one global order, rare first. Rarity is read from a table of ``BUCKETS`` hashed
   counts over all lines (a fixed size, so it may be broadcast), on a logarithmic scale; any fixed order keeps the join exact.
3. Lines that reach similarity t share a word among the first n - ceil(t n) + 1 of both (prefix filter), and the first
   k words that they share are among the first n - ceil(t n) + k. Each line is dealt by such runs of words: by one word where
   that is rare, else by the word and each one that may be shared next, until the run is expected in at most ``GROUP`` lines or has
   ``DEEPEST`` words. Whether a run goes on depends on its words only, so similar lines meet at the run that begins their
   common words. Runs are dealt to shards; in a shard, pairs must pass the length and the positional filter and a bitmap filter
   (the words' 256-bit masks differ in no more bits than the sets may differ in words). Each shard hands on only
   spanning links of what passes, never its pairs. A run with more than ``HOT_RECORDS`` records
   is split into blocks by line, which meet in pairs, a task (run, x, y) each.
4. Components of the forests are families; no similar pair lies across two. The full word sets of each family meet
   in blocks of at most ``BLOCK`` lines, where all links are verified and counted by Jaccard similarity.
5. A line goes if a line before it (smaller id, or same text and further up) is in its class or linked to its class.
   Lines are judged on the input.

Defined results: op2 and the pipeline compare every line that holds a word (``least`` = 1), so short lines go when their
word set came before; a caller may name a floor, and lines of fewer than ``least`` distinct words then always stay. Blank
lines stay; words are compared with ASCII letters lower-cased; NULL text has no line; NULL ids come after all others; rows that repeat each other with one id
count as one and stay; an empty table gives an empty result; further columns stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.components import components
from punctualis.llm.fmindex import keyed
from punctualis.llm.shared import fresh, stored, table

PERCENT, LEAST, EVERY_LINE = 80, 1, 1
BUCKETS = 1 << 17
SHARD_RECORDS, HOT_RECORDS, BLOCK, DENSE_GROUP = 400_000, 20_000, 2048, 4096
GROUP, DEEPEST = 2000, 4  # a line with a prefix shares four words or more with any similar one
CHUNK = 1 << 18  # bytes of text whose arrays stay in a core's cache
LEVELS = 128  # steps of rarity for each doubling of a count
PAIRS, LINKS = 250_000, 1 << 20
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale, below 4096."""
    return np.minimum(np.log2(counts + 1.0) * LEVELS, 4095).astype(np.uint16)


def line_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, line number in the text and number of the line (from 0, lines with a word only) of every word."""
    starts, ends, words = tk.word_spans(data, offsets)
    hashes = tk.span_hashes(tk.LOWER[data], starts, ends)
    newlines = np.flatnonzero(data == 10)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words))
    # Words are in text order, so newlines are counted among the words instead of searched for each word.
    passed = np.bincount(np.searchsorted(starts, newlines), minlength=len(starts) + 1)[: len(starts)]
    line = np.cumsum(passed) - np.searchsorted(newlines, offsets[:-1])[owner]
    new = passed > 0
    new[words[:-1][words[:-1] < len(starts)]] = True
    return hashes, owner, line, np.cumsum(new) - 1


def line_sets(data: np.ndarray, offsets: np.ndarray, least: int, levels: np.ndarray | None = None, wanted: Callable | None = None):
    """Lines of at least ``least`` distinct words: text number, line number, word offsets and distinct word hashes.

    The words of a line are ordered by (rarity of their bucket, hash), or by hash without ``levels``. With ``wanted``, only
    lines for which it is true are read; it gets the hashes of all words and the first word of each line.
    """
    hashes, owner, line, number = line_words(data, offsets)
    head = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.zeros(0, np.int64)
    owner, line = owner[head], line[head]
    if wanted is not None and len(head):
        chosen = wanted(hashes, head)
        words = chosen[number]
        hashes, number, owner, line = hashes[words], (np.cumsum(chosen) - 1)[number[words]], owner[chosen], line[chosen]
    order = _ordered(hashes, number, levels)
    hashes, number = hashes[order], number[order]
    first = np.r_[True, (number[1:] != number[:-1]) | (hashes[1:] != hashes[:-1])] if len(order) else np.zeros(0, bool)
    hashes, number = hashes[first], number[first]
    sizes = np.bincount(number, minlength=len(owner))
    if least > 1:
        keep = sizes >= least
        hashes, sizes, owner, line = hashes[keep[number]], sizes[keep], owner[keep], line[keep]
    return owner, line, np.r_[0, np.cumsum(sizes)], hashes


def _ordered(hashes: np.ndarray, number: np.ndarray, levels: np.ndarray | None) -> np.ndarray:
    """Order by (line, rarity of the bucket, hash): one sort of a packed key.

    The packed key holds the line, the rarity and the upper part of the hash. Where two words of a line agree in it, or there
    are too many lines, all is sorted by the full keys instead, so the order is the same everywhere.
    """
    level = None if levels is None else levels[hashes & np.uint64(BUCKETS - 1)].astype(np.uint64)
    if number[-1:].max(initial=0) < 1 << 20:
        key = number.astype(np.uint64) << np.uint64(44)
        key |= hashes >> np.uint64(20) if level is None else level << np.uint64(32) | hashes >> np.uint64(32)
        order = np.argsort(key)
        k, h = key[order], hashes[order]
        if not ((k[1:] == k[:-1]) & (h[1:] != h[:-1])).any():
            return order
    return np.lexsort((hashes, number) if level is None else (hashes, level, number))


def digests(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, from sums over its words."""
    if len(offsets) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.diff(offsets).astype(np.uint64)
    high = tk.mix(np.add.reduceat(tk.mix(hashes), offsets[:-1]) + size)
    low = tk.mix(np.add.reduceat(tk.mix(hashes ^ _SECOND), offsets[:-1]) + size)
    return high.view(np.int64), low.view(np.int64)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """Words in the prefix; none where even one word more or less is too far, so only equal sets are similar."""
    return np.where(100 * size >= percent * (size + 1), size - -(-percent * size // 100) + 1, 0)


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


_LINE = pa.struct([("line", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int32())])
_COUNT = pa.struct([("bucket", pa.int32()), ("n", pa.int64())])
_SCAN = "doc_id bigint, h bigint, n_lines bigint, lines array<struct<line:int,hi:bigint,lo:bigint,n:int>>, counts array<struct<bucket:int,n:bigint>>"


def scan(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, h, n_lines and the classes of the lines of every document, with ``counts`` NULL; then a row for each task
    that holds only ``counts``: the words of its lines by hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = tk.flat(batch.column("text"))
            buckets = [np.zeros(0, np.int64)]
            for a, b in tk.chunks(offsets, CHUNK):
                part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                owner, line, sets, hashes = line_sets(part, ends, least)
                buckets.append((hashes & np.uint64(BUCKETS - 1)).astype(np.int64))
                hi, lo = digests(hashes, sets)
                items = pa.StructArray.from_arrays([_ints(line), pa.array(hi), pa.array(lo), _ints(np.diff(sets))], fields=list(_LINE))
                list_ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))]).astype(np.int32)
                newlines = np.diff(np.searchsorted(np.flatnonzero(part == 10), ends))
                lines = np.where(np.diff(ends) > 0, newlines + 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("h").slice(a, b - a), pa.array(lines), pa.ListArray.from_arrays(pa.array(list_ends), items), pa.nulls(b - a, pa.list_(_COUNT))],
                    ["doc_id", "h", "n_lines", "lines", "counts"],
                )
            total += np.bincount(np.concatenate(buckets), minlength=BUCKETS)
        at = np.flatnonzero(total)
        counts = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.StructArray.from_arrays([_ints(at), pa.array(total[at])], fields=list(_COUNT)))
        none = [pa.nulls(1, pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*none, pa.nulls(1, pa.list_(_LINE)), counts], ["doc_id", "h", "n_lines", "lines", "counts"])

    return docs.mapInArrow(run, _SCAN)


def bucket_sums(scanned: DataFrame) -> np.ndarray:
    """Words of lines per hash bucket over all tasks; the driver receives at most BUCKETS sums."""
    each = scanned.where(F.col("n_lines").isNull()).select(F.inline("counts"))
    sums = each.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def bucket_counts(docs: DataFrame, least: int) -> np.ndarray:
    return bucket_sums(scan(docs, least))


MASK_WORDS = 4
_RECORD = np.dtype([("token", "<u4"), ("node", "<i8"), ("bits", "<u8", MASK_WORDS), ("size", "<u4"), ("most", "<u4")])
_CODEC = pa.Codec("zstd", compression_level=1)


def masks(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets x MASK_WORDS) bit masks: each word of a set has one of 256 bits."""
    word, bit = hashes >> np.uint64(62), np.uint64(1) << (hashes >> np.uint64(56) & np.uint64(63))
    return np.stack([np.bitwise_or.reduceat(np.where(word == w, bit, 0), offsets[:-1]) for w in range(MASK_WORDS)], axis=1)


def pack(records: np.ndarray) -> bytes:
    """Number of records, then column by column, compressed: the masks of short lines are nearly empty."""
    return np.int64(len(records)).tobytes() + _CODEC.compress(b"".join(records[name].tobytes() for name in _RECORD.names), asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    records, at = np.empty(int(np.frombuffer(blob, np.int64, 1)[0]), _RECORD), 0
    data = _CODEC.decompress(memoryview(blob)[8:], records.nbytes)
    for name in _RECORD.names:
        column = records[name]
        column[...] = np.frombuffer(data, column.dtype, column.size, at).reshape(column.shape)
        at += column.nbytes
    return records


def runs(hashes: np.ndarray, sets: np.ndarray, length: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of words by which lines are dealt: line, token, place of the last word and number of words.

    ``length`` is the prefix of each line, 0 for lines that are left out. The expected number of lines of a run takes the words
    as independent, and the most frequent bucket as the number of lines; a wrong guess costs time only.
    """
    rank = levels[hashes & np.uint64(BUCKETS - 1)].astype(np.int64)
    everywhere, limit = int(levels.max(initial=0)), int(np.log2(GROUP + 1) * LEVELS)
    line, place = tk.ragged(length)
    token, expected, parts = hashes[sets[line] + place], rank[sets[line] + place], []
    for depth in range(1, DEEPEST + 1):
        on = (expected > limit) & (depth < DEEPEST)
        parts.append((line[~on], token[~on], place[~on], np.full((~on).sum(), depth)))
        line, token, place, expected = line[on], token[on], place[on], expected[on]
        again, step = tk.ragged(length[line] + depth - 1 - place)
        line, place = line[again], place[again] + 1 + step
        word = sets[line] + place
        token, expected = tk.mix(token[again] + hashes[word]) + hashes[word], expected[again] + rank[word] - everywhere
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _prefixes(batch: pa.RecordBatch, levels: np.ndarray, percent: int, least: int, wanted: Callable | None = None) -> np.ndarray:
    """The records of the lines of a batch, one for each run of words. A class comes once, however often it occurs.

    ``most`` is how many words the line can share, at most, with one whose common words begin with the run.
    """
    data, offsets = tk.flat(batch.column("text"))
    parts, seen = [np.zeros(0, _RECORD)], set()
    for a, b in tk.chunks(offsets, CHUNK):
        _, _, sets, hashes = line_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], least, levels, wanted)
        if len(sets) < 2:
            continue
        _, node = digests(hashes, sets)
        new = np.array([x not in seen and not seen.add(x) for x in node.tolist()])
        sizes = np.diff(sets)
        owner, token, place, depth = runs(hashes, sets, np.where(new, prefix_length(sizes, percent), 0), levels)
        bits = masks(hashes, sets)
        records = np.empty(len(owner), _RECORD)
        records["token"] = tk.mix(token) >> np.uint64(32)
        records["node"], records["bits"], records["size"], records["most"] = node[owner], bits[owner], sizes[owner], sizes[owner] - place - 1 + depth
        parts.append(records)
    return np.concatenate(parts)


def hot_tokens(docs: DataFrame, counts: np.ndarray, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs with more than HOT_RECORDS records, sorted, and their numbers of blocks.

    A run can be hot only if all its words are in buckets of more than HOT_RECORDS words, so only lines with such a word in their prefix
    are read further. The counts are pre-aggregated; the driver receives the hot runs only, at most one per HOT_RECORDS records. A class
    that comes in several batches is counted in each, which can only make the blocks smaller.
    """
    shared = docs.sparkSession.sparkContext.broadcast((rarity(counts), counts <= HOT_RECORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, rare = shared.value

        def wanted(hashes: np.ndarray, head: np.ndarray) -> np.ndarray:
            # Bits set by the rarer words are at most as many as these words; a prefix of repeated words only looks longer.
            bit = np.where(rare[hashes & np.uint64(BUCKETS - 1)], np.uint64(1) << (hashes >> np.uint64(58)), np.uint64(0))
            return np.bitwise_count(np.bitwise_or.reduceat(bit, head)) < prefix_length(np.diff(np.r_[head, len(hashes)]), percent)

        for batch in batches:
            tokens, n = np.unique(_prefixes(batch, levels, percent, least, wanted)["token"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    sums = docs.select("text").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    hot = sums.where(F.col("n") > HOT_RECORDS).toPandas().sort_values("token")
    return hot["token"].to_numpy(np.uint32), -(-hot["n"].to_numpy(np.int64) // HOT_RECORDS)


def prefix_records(docs: DataFrame, counts: np.ndarray, hot: tuple[np.ndarray, np.ndarray], shards: int, percent: int, least: int) -> DataFrame:
    """shard, block, blocks, records: the runs of words of the lines, packed.

    Shards from 0 on hold many runs; a hot run has a negative shard of its own and a block by the line's digest.
    """
    shared = docs.sparkSession.sparkContext.broadcast((rarity(counts), *hot))  # BUCKETS levels and the hot runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, tokens, blocks = shared.value
        tokens, blocks = np.r_[tokens, np.uint32(0)].astype(np.uint32), np.r_[blocks, 1].astype(np.int64)
        for batch in batches:
            records = _prefixes(batch, levels, percent, least)
            if not len(records):
                continue
            at = np.searchsorted(tokens[:-1], records["token"])
            at[tokens[at] != records["token"]] = len(tokens) - 1
            is_hot = at < len(tokens) - 1
            shard = np.where(is_hot, -1 - records["token"].astype(np.int64), records["token"] % np.uint32(shards))
            block = (tk.mix(records["node"].view(np.uint64)) % blocks[at].astype(np.uint64)).astype(np.int64)
            order = np.argsort(shard * (1 << 20) + block, kind="stable") if blocks.max() < 1 << 20 else np.lexsort((block, shard))
            records, shard, block, of = records[order], shard[order], block[order], blocks[at][order]
            firsts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (block[1:] != block[:-1])])
            blobs = [pack(x) for x in np.split(records, firsts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(shard[firsts]), pa.array(block[firsts]), pa.array(of[firsts]), pa.array(blobs, pa.binary())], ["shard", "block", "blocks", "records"])

    return docs.select("text").mapInArrow(run, "shard bigint, block bigint, blocks bigint, records binary")


def deal(packed: DataFrame) -> DataFrame:
    """The packed records by task (shard, x, y): block b meets the blocks 0 .. blocks - 1, itself once.

    ``side`` is 0 where a block meets itself, else 1 for the records of x and 2 for those of y.
    """
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    met = packed.withColumn("other", others).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    side = F.when(F.col("x") == F.col("y"), 0).when(F.col("block") == F.col("x"), 1).otherwise(2)
    return met.select("shard", "x", "y", side.alias("side"), "records")


def _passes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Length, positional and bitmap filter for pairs of records of one run of words."""
    sa, sb = a["size"].astype(np.int64), b["size"].astype(np.int64)
    need = -(-percent * (sa + sb) // (100 + percent))
    apart = np.bitwise_count(a["bits"] ^ b["bits"]).sum(axis=1, dtype=np.int64)
    return (100 * np.minimum(sa, sb) >= percent * np.maximum(sa, sb)) & (np.minimum(a["most"], b["most"]) >= need) & (apart <= sa + sb - 2 * need)


def _near(a: np.ndarray, b: np.ndarray, columns: tuple, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass the positional filter and then the masks, word by word."""
    size, most, bits = columns
    both = size[a] + size[b]
    need = -(-percent * both // (100 + percent))
    ok = np.flatnonzero(np.minimum(most[a], most[b]) >= need)
    a, b, room = a[ok], b[ok], (both - 2 * need)[ok]
    for word in bits:
        room = room - np.bitwise_count(word[a] ^ word[b])
        ok = np.flatnonzero(room >= 0)
        a, b, room = a[ok], b[ok], room[ok]
    return a, b


def _forest(records: np.ndarray, sides: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the members of one large word group, each new one against those not yet reached only.

    Members of the same side other than 0 meet in another task.
    """
    left, froms, tos = np.arange(1, len(records)), [], []
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        meets = np.flatnonzero((sides[left] != sides[at]) | (sides[left] == 0))
        others = left[meets]
        hit = _passes(np.broadcast_to(records[at], len(others)), records[others], percent)
        froms.append(np.full(hit.sum(), at))
        tos.append(others[hit])
        queue.extend(others[hit].tolist())
        left = np.delete(left, meets[hit])
        if sides[at] and not len(queue) and len(left) and (sides[left] == sides[left[0]]).all():
            break  # one side is used up
    return np.concatenate(froms), np.concatenate(tos)


def shard_links(blobs: pa.Table, percent: int) -> pa.Table:
    parts = [unpack(blob) for blob in blobs.column("records").to_pylist()]
    sides = np.repeat(blobs.column("side").to_numpy(), [len(part) for part in parts])
    records = np.concatenate(parts)
    # Records that repeat each other are next to each other but for rare ties; one that stays is harmless.
    order = np.argsort(records["token"].astype(np.uint64) << np.uint64(32) | np.minimum(records["size"], 0xFFFF).astype(np.uint64) << np.uint64(16) | records["node"].view(np.uint64) >> np.uint64(48))
    if records["size"].max(initial=0) > 0xFFFF:
        order = np.lexsort((records["node"], records["size"], records["token"]))
    records, sides = records[order], sides[order]
    same = np.logical_and.reduce([records[c][1:] == records[c][:-1] for c in ("token", "node", "most")])
    records, sides = (x[np.r_[True, ~same]] if len(records) else x for x in (records, sides))
    edges = np.r_[0, np.flatnonzero(records["token"][1:] != records["token"][:-1]) + 1, len(records)]
    sizes = np.diff(edges)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # In groups up to DENSE_GROUP, sorted by size, each member meets those before it that are long enough.
    dense = (sizes <= DENSE_GROUP) & (sides[edges[:-1]] == 0) if len(records) else np.zeros(len(sizes), bool)
    group = np.repeat(np.arange(len(sizes)), sizes)
    size = records["size"].astype(np.int64)
    key = group << 32 | size
    lowest = np.searchsorted(key, group << 32 | -(-percent * size // 100))
    partners = np.where(dense[group], np.arange(len(records)) - lowest, 0)
    columns = size.astype(np.int32), records["most"].astype(np.int32), [np.ascontiguousarray(records["bits"][:, w]) for w in range(MASK_WORDS)]
    nodes, found = records["node"], 0

    def gather() -> None:
        a, b = spanning_links(nodes[np.concatenate(left)], nodes[np.concatenate(right)])
        links.append((a, b))
        left[:], right[:] = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    links: list[tuple[np.ndarray, np.ndarray]] = []
    busy = np.flatnonzero(partners)
    ends = np.cumsum(partners[busy])
    for part in np.split(busy, np.searchsorted(ends, np.arange(PAIRS, int(ends[-1]) if len(ends) else 0, PAIRS))):
        member, step = tk.ragged(partners[part])
        a = part[member]
        a, b = _near(a, lowest[a] + step, columns, percent)
        left.append(a)
        right.append(b)
        found += len(a)
        if found > LINKS:  # groups of copies hold many pairs; what hangs together is enough
            gather()
            found = 0
    for group in np.flatnonzero(~dense & (sizes > 1)):
        a, b = _forest(records[edges[group] : edges[group + 1]], sides[edges[group] : edges[group + 1]], percent)
        left.append(a + edges[group])
        right.append(b + edges[group])
    gather()
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    return pa.Table.from_arrays([pa.array(x) for x in (spanning_links(a, b) if len(links) > 1 else (a, b))], ["a", "b"])


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per node that connects the same nodes as the given links: to the least node it hangs together with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


def class_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The line that stands for each class of ``members`` (hi, lo, rep, ...), with all their columns."""
    columns = [c for c in members.columns if c != "rep"]
    picks = members.select(F.col("rep.doc_id").alias("m_id"), F.col("rep.h").alias("m_h"), F.struct(F.col("rep.line").alias("line"), *columns).alias("pick"))
    picks = picks.groupBy("m_id", "m_h").agg(F.array_sort(F.collect_list("pick")).alias("picks"))
    # Both sides grow with the corpus: a merge join at every size.
    joined = docs.join(picks.hint("merge"), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("h") == F.col("m_h")))
    wanted = F.transform("picks", lambda p: p["line"])
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("content")))
    lines = F.filter(numbered, lambda p: F.array_contains(wanted, p["i"]))
    cut = joined.select(F.inline(F.arrays_zip("picks", lines.alias("lines"))))
    # Rows that repeat each other give the same line twice; a class counts once.
    return cut.select("lines.content", *(F.col(f"picks.{c}").alias(c) for c in columns)).dropDuplicates(["hi", "lo"])


_COUNTED = "hi bigint, lo bigint, links bigint, earlier boolean"


def family_links(rows: pa.Table, percent: int, least: int) -> pa.Table:
    """Links of each class to the classes of its family that meet it here (blocks x and y of the family)."""
    data, offsets = tk.flat(rows.column("content").combine_chunks())
    owner, _, sets, hashes = line_sets(data, offsets, least)
    family, x, y, block = (rows.column(c).to_numpy() for c in ("family", "x", "y", "block"))
    order = np.unique(rows.column("order").to_numpy().astype(str), return_inverse=True)[1]
    tasks = np.lexsort((block, y, x, family))
    new = np.r_[True, np.any([c[tasks][1:] != c[tasks][:-1] for c in (family, x, y)], axis=0)]
    links, earlier = np.zeros(len(family), np.int64), np.zeros(len(family), bool)
    where = np.full(len(family), -1)
    where[owner] = np.arange(len(owner))
    for members in np.split(tasks, np.flatnonzero(new)[1:]):
        if len(members) < 2:
            continue
        at = where[members]
        sizes = (sets[at + 1] - sets[at]).astype(np.int64)
        row, place = tk.ragged(sizes)
        words, column = np.unique(hashes[sets[at][row] + place], return_inverse=True)
        across = x[members[0]] != y[members[0]]
        first = block[members] == x[members[0]]
        overlap = np.zeros((len(members), len(members)), np.int32)
        for low in range(0, len(words), 4096):  # a slice of the words at a time
            mine = (column >= low) & (column < low + 4096)
            grid = np.zeros((len(members), min(4096, len(words) - low)), np.float32)
            grid[row[mine], column[mine] - low] = 1
            overlap += (grid @ grid.T).astype(np.int32)
        linked = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
        np.fill_diagonal(linked, False)
        if across:  # pairs inside a block are counted where the block meets itself
            linked &= first[:, None] != first[None, :]
        links[members] += linked.sum(axis=1)
        earlier[members] |= (linked & (order[members][None, :] < order[members][:, None])).any(axis=1)
    return pa.Table.from_arrays([rows.column("hi"), rows.column("lo"), pa.array(links), pa.array(earlier)], ["hi", "lo", "links", "earlier"])


def judged_lines(docs: DataFrame, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """doc_id, h, n_lines and lines: array of (line, class_doc, class_line, links, removed) for lines that are compared."""
    docs = keyed(docs)
    tasks = stored(scan(docs, least), "lines")
    counts = bucket_sums(tasks)
    scanned = tasks.where(F.col("n_lines").isNotNull()).drop("counts")  # without reading the counts
    lines = scanned.select("doc_id", "h", F.explode("lines").alias("l")).select("doc_id", "h", "l.*")
    rep = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line", "h")
    classes = stored(lines.groupBy("hi", "lo").agg(F.min(rep).alias("rep"), F.max("n").alias("n")), "classes")
    linkable = classes.where(100 * F.col("n") >= percent * (F.col("n") + 1))
    records = linkable.agg(F.sum(F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)).first()[0] or 0
    shards = int(max(1, -(-records // SHARD_RECORDS)))
    packed = prefix_records(docs, counts, hot_tokens(docs, counts, percent, least), shards, percent, least)
    links = deal(packed).groupBy("shard", "x", "y").applyInArrow(lambda t: shard_links(t, percent), "a bigint, b bigint")
    families = stored(components(links), "families")
    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    families = families.join(sizes, "component").select(F.col("node").alias("lo"), F.col("component").alias("family"), F.ceil(F.col("members") / BLOCK).alias("blocks"))
    members = classes.join(families, "lo").select("hi", "lo", "rep", "family", "blocks")
    members = members.withColumn("block", F.pmod(F.xxhash64("hi", "lo"), F.col("blocks")))
    texts = stored(class_texts(docs, ranked(members)), "family-lines")
    # Block b of a family meets the blocks 0 .. blocks - 1, itself once.
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    met = texts.withColumn("other", others).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    batches = max(1, int(-(-(met.count()) // (4 * BLOCK))))
    dealt = met.select(F.pmod(F.xxhash64("family", "x", "y"), F.lit(batches)).alias("task"), "content", "family", "x", "y", "block", "order", "hi", "lo")
    counted = dealt.groupBy("task").applyInArrow(lambda t: family_links(t, percent, least), _COUNTED)
    verdicts = counted.groupBy("hi", "lo").agg(F.sum("links").alias("links"), F.max("earlier").alias("earlier"))
    judged = classes.join(verdicts, ["hi", "lo"], "left").select("hi", "lo", "rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("earlier", F.lit(False)).alias("earlier"))
    own = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("line") == F.col("rep.line"))
    item = F.struct("line", F.col("rep.doc_id").alias("class_doc"), F.col("rep.line").alias("class_line"), "links", (F.col("earlier") | ~own).alias("removed"))
    per_doc = lines.join(judged, ["hi", "lo"]).groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(item)).alias("judged"))
    per_doc = per_doc.select(F.col("doc_id").alias("j_id"), F.col("h").alias("j_h"), "judged")
    joined = scanned.join(per_doc, F.col("doc_id").eqNullSafe(F.col("j_id")) & (F.col("h") == F.col("j_h")), "left")
    empty = F.array().cast("array<struct<line:int,class_doc:bigint,class_line:int,links:bigint,removed:boolean>>")
    return joined.select("doc_id", "h", "n_lines", F.coalesce("judged", empty).alias("lines"))


def ranked(members: DataFrame) -> DataFrame:
    """Members with ``order``: the place of their first line among the lines of their family, without a sort of a family.

    Only comparisons matter, so the order is the pair (id, line) packed into one text that sorts the same way.
    """
    sign = F.when(F.col("rep.last"), F.lit("2")).when(F.col("rep.doc_id") < 0, F.lit("0")).otherwise(F.lit("1"))
    return members.withColumn("order", F.concat(sign, F.lpad(F.hex(F.coalesce("rep.doc_id", F.lit(0))), 16, "0"), F.lpad(F.hex("rep.line"), 8, "0")))


def remove_lines(docs: DataFrame, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """The documents, all columns, without the removed lines; texts left blank by that go."""
    key, gone_id, gone_key, gone = (fresh(docs, name) for name in ("key", "gone_id", "gone_key", "gone"))
    lines = F.transform(F.filter("lines", lambda x: x["removed"]), lambda x: x["line"])
    found = judged_lines(docs, percent, least).select(F.col("doc_id").alias(gone_id), F.col("h").alias(gone_key), lines.alias(gone))
    found = found.where(F.size(gone) > 0).dropDuplicates([gone_id, gone_key])
    rows = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = rows.join(found, F.col("doc_id").cast("bigint").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left")
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    kept = F.array_join(F.transform(F.filter(numbered, lambda p: ~F.array_contains(gone, p["i"])), lambda p: p["x"]), "\n")
    joined = joined.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
    return joined.where(F.col(gone).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(docs.columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines with class, number of links to other classes and verdict."""
    judged = judged_lines(table(spark, sf_dir, "documents"), least=EVERY_LINE)
    removed = F.filter("lines", lambda x: x["removed"])
    return judged.select(
        "doc_id", "n_lines", F.size("lines").cast("bigint").alias("n_compared"), F.size(removed).cast("bigint").alias("n_removed"),
        F.aggregate("lines", F.lit(0).cast("bigint"), lambda s, x: s + x["links"]).alias("n_links"),
        F.transform("lines", lambda x: F.concat_ws(":", x["line"], x["class_doc"], x["class_line"], x["links"])).alias("lines"),
    )


QUERIES = {"op2_line_dedup": op2_line_dedup}
SQL: dict[str, str] = {}
