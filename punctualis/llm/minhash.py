"""Near-duplicate documents: SuperMinHash, banding, verification, union-find grouping.

Signatures. Each shingle of a document draws a random permutation of the signature's places, one place at a time;
at step j it offers the value j + r to the j-th place of its permutation (Ertl 2017). The ranks of one shingle over
the places are correlated (no two alike), which lowers the variance against independent hashes, and a document
stops once every place has a value below the next step: large sets after one or two steps.

Groups. Documents with equal shingle sets form a class (128-bit digest of the set, pre-aggregated), which its smallest id
stands for. Classes that agree in one of 32 bands of 4 places are candidates: pairs of similarity 0.85 miss all
bands with probability 6e-11, 0.8 with 5e-8. Candidates that hang together are a family; they are found by ties to
the smallest class of each band, never by listing a band's pairs. The full texts of a family meet in one task, large
families in pairs of blocks of about ``BLOCK_SHINGLES`` shingles. There links are confirmed on full shingle sets: each
document reached is held against all that are not reached yet, so no link between two parts is lost and no pair
inside a part is listed. The confirmed forests are contracted to components in Spark jobs.

Defined results: NULL or blank texts have no shingle and are linked with nothing; a text with fewer words than a shingle
is one shingle; rows with a NULL id are linked with nothing and kept; rows that share an id count as one document;
an empty table gives an empty result; further columns are ignored, and by ``near_dedup`` returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.components import components
from punctualis.llm.shared import fresh, stored, table

BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
BLOCK_SHINGLES = 2_000_000
_RANDOM_BITS = 24


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each text, sorted, and the offsets between the texts (ASCII letters lower-cased)."""
    data = tk.LOWER[data]
    starts, ends, words = tk.word_spans(data, offsets)
    hashes, lengths = tk.span_hashes(data, starts, ends), np.diff(words)
    owner, place = tk.ragged(np.maximum(lengths - k + 1, 0))
    values = tk.window_hashes(hashes, k)[words[owner] + place] if len(owner) else np.zeros(0, np.uint64)
    for short in range(1, k):
        texts = np.flatnonzero(lengths == short)
        if len(texts):
            owner = np.concatenate([owner, texts])
            values = np.concatenate([values, tk.mix(tk.window_hashes(hashes, short)[words[texts]] + np.uint64(short))])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    first = np.r_[True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])] if len(owner) else np.zeros(0, bool)
    return values[first], np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(lengths)))])


def super_minhash(values: np.ndarray, offsets: np.ndarray, places: int = PLACES) -> np.ndarray:
    """(texts x places) signature of the given sets; all texts of a batch step together, finished ones drop out."""
    count = len(offsets) - 1
    signature = np.full((count, places), np.iinfo(np.uint32).max, np.uint32)
    flat = signature.reshape(-1)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    order = None
    for step in range(places):
        draw = tk.mix(values + np.uint64((step + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
        rank = (draw >> np.uint64(64 - _RANDOM_BITS)).astype(np.uint32) | np.uint32(step << _RANDOM_BITS)
        other = step + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = other
        else:
            rows = np.arange(len(values))
            place = order[rows, other].astype(np.int64)
            order[rows, other] = order[:, step]
        np.minimum.at(flat, owner * places + place, rank)
        unfinished = signature.max(axis=1) >= np.uint32((step + 1) << _RANDOM_BITS) if step + 1 < places else np.zeros(count, bool)
        alive = unfinished[owner]
        if not alive.any():
            break
        if order is None:
            other, values, owner = other[alive], values[alive], owner[alive]
            order = np.tile(np.arange(places, dtype=np.uint16), (len(values), 1))
            order[np.arange(len(values)), other] = 0
        elif not alive.all():
            values, owner, order = values[alive], owner[alive], order[alive]
    return signature


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        keys = tk.mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


SKETCH_SCHEMA = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """Size, digest and band keys of the shingle set of every document; no bands for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.flat(batch.column("text"))
            for a, b in tk.chunks(offsets):
                values, sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                keys = band_keys(super_minhash(values, sets))
                sizes = np.diff(sets)
                digests = [hashlib.blake2b(values[x:y].tobytes(), digest_size=16).digest() for x, y in zip(sets, sets[1:])]
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[sizes > 0].ravel()))
                ids = batch.column("doc_id").slice(a, b - a)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(digests, pa.binary()), bands], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SKETCH_SCHEMA)


def confirm_family(ids: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between full sets: each set reached is held against those not yet reached only."""
    sizes, codes = np.diff(offsets), np.unique(values, return_inverse=True)[1]
    marked = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    own = np.split(codes, offsets[1:-1])
    left, froms, tos, queue = np.arange(1, len(ids)), [], [], [0]
    left_codes = codes[offsets[1] :]
    while len(left):
        if not queue:
            queue = [int(left[0])]
            left, left_codes = left[1:], left_codes[sizes[left[0]] :]
            continue
        at = queue.pop()
        marked[own[at]] = True
        starts = np.cumsum(sizes[left]) - sizes[left]
        shared = np.add.reduceat(marked[left_codes], starts, dtype=np.int64)
        marked[own[at]] = False
        hit = 100 * shared >= percent * (sizes[at] + sizes[left] - shared)
        if hit.any():
            froms.append(np.full(hit.sum(), ids[at]))
            tos.append(ids[left[hit]])
            queue.extend(left[hit].tolist())
            left_codes = left_codes[np.repeat(~hit, sizes[left])]
            left = left[~hit]
    return (np.concatenate(froms), np.concatenate(tos)) if froms else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def confirm_task(rows: pa.Table, k: int, percent: int) -> pa.Table:
    """Forests of the families (or pairs of blocks of one) of a task."""
    rows = rows.sort_by([("family", "ascending"), ("x", "ascending"), ("y", "ascending")])
    data, byte_offsets = tk.flat(rows.column("text").combine_chunks())
    parts = [shingle_sets(data[byte_offsets[a] : byte_offsets[b]], byte_offsets[a : b + 1] - byte_offsets[a], k) for a, b in tk.chunks(byte_offsets)]
    values = np.concatenate([v for v, _ in parts])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(o) for _, o in parts]))])
    ids, *names = (rows.column(c).to_numpy() for c in ("doc_id", "family", "x", "y"))
    borders = np.flatnonzero(np.r_[True, np.any([n[1:] != n[:-1] for n in names], axis=0), True])
    found = [confirm_family(ids[a:b], values[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], percent) for a, b in zip(borders, borders[1:]) if b - a > 1]
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def group(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    sketch = stored(sketches(docs, k), "sketches")
    classes = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("bands").alias("bands")
    )
    classes = stored(classes, "classes")
    # Every class is tied to the smallest of each band; what hangs together is a family, and no link leaves it.
    members = classes.select(F.explode("bands").alias("key"), "id")
    buckets = stored(members.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last"), "buckets")
    ties = members.join(buckets.select("key", "pivot"), "key").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    families = stored(components(ties).join(classes.select("id", "n"), F.col("node") == F.col("id")).select("id", "n", F.col("component").alias("family")), "families")
    sizes = families.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = stored(families.join(sizes, "family").groupBy("id", "family", "blocks").agg(F.max("n").alias("n")), "placed")
    work = placed.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    tasks = max(1, -(-work // BLOCK_SHINGLES))
    # Both sides grow with the corpus: a merge join at every size.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(placed.drop("n").hint("merge"), F.col("doc_id") == F.col("id"))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    # Block b of a family meets the blocks 0 .. blocks - 1, itself once.
    texts = texts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    texts = texts.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    dealt = texts.select(F.pmod(F.xxhash64("family", "x", "y"), F.lit(tasks)).alias("task"), "family", "x", "y", "doc_id", "text")
    links = dealt.groupBy("task").applyInArrow(lambda t: confirm_task(t, k, percent), "a bigint, b bigint")
    found = components(links)
    grouped = classes.join(found, F.col("id") == F.col("node"), "left").where("copies > 1 OR component IS NOT NULL")
    grouped = stored(grouped.select("digest", F.coalesce("component", "id").alias("component")), "groups")
    out = sketch.select("doc_id", "n_shingles", "digest").join(grouped, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, all columns: the one with the smallest id."""
    name = fresh(docs, "gone")
    gone = group(docs, k, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col(name), "left_anti")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents"), k=3, percent=85)


QUERIES = {"op7_minhash_near_dedup": op7_minhash_near_dedup}
SQL = {
    "op7_minhash_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 85 * (na.n + nb.n - x)),
r AS (SELECT doc_id AS id, doc_id AS seen FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
"""
}
