"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard, results merged.

Method. Different vectors are dealt to shards by a hash of their smallest id, about ``SHARD_ROWS`` to a shard. A task builds the
hierarchical graph of its shard: a vector has a level drawn from its id, layer l holds all vectors of level l or more. Vectors
are ordered by level, so every layer is a prefix of the next, and a layer's graph is a flat array of neighbour places,
one row per vector. Vectors enter in batches that double up to ``BATCH``; a batch descends the upper layers, searches its
layer with a beam, adds what is near inside the batch, and keeps neighbours that are nearer to it than to each other.
All searches of a batch go in step. The index is a table, one row per shard, in the shared folder. Queries are dealt in blocks
to every shard; shards give their best, the best of all are ranked.

Largest inner product is not nearest in space, unless all lengths are equal. Inside a shard every vector gets one more
component that fills its length up to the longest one's (Bachrach et al. 2014), queries get zero there: the
order by distance is then the order by inner product. The graph is searched in single precision; scores are sums of double
products in the order of the components, on the vectors as given.

Equal vectors are one node, so copies of one vector can't crowd out a graph; a search needs the smallest k + 1 ids of
each node it finds. Every vector is in the index; which neighbours are found is approximate (recall in the README).

Defined results: rows with a NULL id, and vectors that are NULL, empty, zero or hold NULL or non-finite components take no part;
of rows that share an id one counts (that with the smallest vector); only vectors of as many components meet; ties go to the
smaller id; fewer candidates than asked for are all returned; empty tables give empty results; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.shared import stored, table

SHARD_ROWS = 8192
SHARD_BYTES = 16 << 20
QUERY_BLOCK = 4096
DEGREE = 16  # of new vectors and in upper layers; twice that in the lowest one
BEAM_BUILD, BEAM_SEARCH, BEAM_DESCENT = 96, 160, 8
BATCH = 256
_SIDE = 4  # places that a search opens at once


def beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and products of the best ``width`` found for each query, best first; missing ones are -1 and -inf.

    ``links`` is a layer: the neighbours (-1: none) of the vectors at the first places of ``x``.
    """
    count = len(queries)
    seen = np.zeros((count, len(links)), bool)
    ids, products = np.full((count, width), -1, np.int32), np.full((count, width), -np.inf, np.float32)
    is_open = np.zeros((count, width), bool)
    active, found = np.arange(count), entries
    while True:
        found = np.sort(found, axis=1)
        new = found >= 0
        new[:, 1:] &= found[:, 1:] != found[:, :-1]
        new &= ~seen[active[:, None], np.maximum(found, 0)]
        row, column = np.nonzero(new)
        place = found[row, column]
        seen[active[row], place] = True
        scores = np.full(found.shape, -np.inf, np.float32)
        scores[row, column] = np.einsum("ij,ij->i", x[place], queries[active[row]])
        all_ids = np.concatenate([ids[active], found], axis=1)
        all_scores = np.concatenate([products[active], scores], axis=1)
        all_open = np.concatenate([is_open[active], new], axis=1)
        best = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
        all_ids, all_scores, all_open = (np.take_along_axis(v, best, axis=1) for v in (all_ids, all_scores, all_open))
        all_open &= all_scores > -np.inf
        side = min(_SIDE, width)
        nearest = np.argpartition(np.where(all_open, -all_scores, np.inf), side - 1, axis=1)[:, :side]
        opened = np.take_along_axis(all_open, nearest, axis=1)
        chosen = np.where(opened, np.take_along_axis(all_ids, nearest, axis=1), -1)
        np.put_along_axis(all_open, nearest, False, axis=1)
        ids[active], products[active], is_open[active] = all_ids, all_scores, all_open
        going = opened.any(axis=1)
        if not going.any():
            break
        active, chosen = active[going], chosen[going]
        found = np.where(chosen[:, :, None] >= 0, links[np.maximum(chosen, 0)], -1).reshape(len(active), -1)
    order = np.argsort(-products, axis=1, kind="stable")
    ids, products = np.take_along_axis(ids, order, axis=1), np.take_along_axis(products, order, axis=1)
    return np.where(products > -np.inf, ids, -1), products


def select(x: np.ndarray, ids: np.ndarray, products: np.ndarray, keep: int) -> np.ndarray:
    """Neighbours out of candidates (best first): those nearer to the owner than to any chosen one, then the next best."""
    if ids.shape[1] <= keep:
        return ids
    near = x[ids]
    between = near @ near.transpose(0, 2, 1)
    chosen, number = np.zeros(ids.shape, bool), np.zeros(len(ids), np.int64)
    for j in range(ids.shape[1]):
        take = (ids[:, j] >= 0) & (number < keep) & ~((between[:, j] > products[:, j, None]) & chosen).any(axis=1)
        chosen[:, j] = take
        number += take
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(ids, order, axis=1)


def sorted_candidates(x: np.ndarray, owners: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    products = np.where(ids >= 0, np.einsum("ijk,ik->ij", x[ids], x[owners]), -np.inf)
    order = np.argsort(-products, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(products, order, axis=1)


class Layer:
    """A layer under construction: rows have room for more than ``degree`` neighbours and are cut back when full."""

    def __init__(self, x: np.ndarray, size: int, degree: int):
        self.x, self.degree = x, degree
        self.links = np.full((size, degree + degree // 2), -1, np.int32)
        self.used = np.zeros(size, np.int64)

    def start_from(self, upper: np.ndarray) -> None:
        self.links[: len(upper), : upper.shape[1]] = upper
        self.used[: len(upper)] = (upper >= 0).sum(axis=1)

    def put(self, first: int, neighbours: np.ndarray) -> None:
        """Neighbours of the vectors from place ``first`` on, and the links back."""
        last, room = first + len(neighbours), self.links.shape[1]
        self.links[first:last, : neighbours.shape[1]] = neighbours
        self.used[first:last] = (neighbours >= 0).sum(axis=1)
        row, column = np.nonzero(neighbours >= 0)
        target, source = neighbours[row, column], (first + row).astype(np.int32)
        fresh = ~(self.links[target] == source[:, None]).any(axis=1)
        target, source = target[fresh], source[fresh]
        while len(target):
            order = np.argsort(target, kind="stable")
            target, source = target[order], source[order]
            begins = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            rank = np.arange(len(target)) - np.repeat(begins, np.diff(np.r_[begins, len(target)]))
            slot = self.used[target] + rank
            fits = slot < room
            self.links[target[fits], slot[fits]] = source[fits]
            np.add.at(self.used, target[fits], 1)
            target, source = target[~fits], source[~fits]
            self.cut(np.unique(target))

    def cut(self, rows: np.ndarray) -> None:
        for part in np.array_split(rows, -(-len(rows) // BATCH)) if len(rows) else []:
            kept = select(self.x, *sorted_candidates(self.x, part, self.links[part]), self.degree)
            self.links[part] = -1
            self.links[part, : kept.shape[1]] = kept
            self.used[part] = (kept >= 0).sum(axis=1)

    def finished(self) -> np.ndarray:
        self.cut(np.flatnonzero(self.used > self.degree))
        return np.ascontiguousarray(self.links[:, : self.degree])


def descend(x: np.ndarray, uppers: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Entries for the layer below ``uppers`` (top layer first)."""
    entries = np.zeros((len(queries), 1), np.int32)
    for links in uppers:
        entries = beam(x, links, queries, entries, min(BEAM_DESCENT, len(links)))[0]
    return entries


def levels_of(ids: np.ndarray) -> np.ndarray:
    draw = (tk.mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    return np.floor(-np.log(np.maximum(draw, 2.0**-60)) / np.log(DEGREE)).astype(np.int64)


def build_graph(x: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """Layers, top first, over vectors ordered by falling level."""
    layers: list[np.ndarray] = []
    for level in range(int(levels.max(initial=0)), -1, -1):
        size = int((levels >= level).sum())
        layer = Layer(x, size, DEGREE if level else 2 * DEGREE)
        at = 0
        if layers:
            layer.start_from(layers[-1])
            at = len(layers[-1])
        while at < size:
            batch = np.arange(at, min(size, at + min(BATCH, max(2 * DEGREE, at))))
            q = x[batch]
            inside = q @ q.T
            np.fill_diagonal(inside, -np.inf)
            top = np.argsort(-inside, axis=1, kind="stable")[:, : min(2 * DEGREE, len(batch) - 1)]
            ids, products = (batch[0] + top).astype(np.int32), np.take_along_axis(inside, top, axis=1)
            if at:
                old = beam(x, layer.links[:at], q, descend(x, layers, q), min(BEAM_BUILD, at))
                ids, products = (np.concatenate(v, axis=1) for v in zip((ids, products), old))
                order = np.argsort(-products, axis=1, kind="stable")
                ids, products = np.take_along_axis(ids, order, axis=1), np.take_along_axis(products, order, axis=1)
            layer.put(at, select(x, ids, products, DEGREE))
            at += len(batch)
        layers.append(layer.finished())
    return layers


def prepared(vectors: np.ndarray) -> np.ndarray:
    """Single precision, scaled to a largest component of one, all of one length by a further component."""
    x = vectors / np.abs(vectors).max(initial=1e-300)
    squares = (x * x).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, summed component by component from the first on."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


INDEX_SCHEMA = "dim int, shard bigint, ids binary, vectors binary, sizes array<int>, links binary"


def matrix_of(rows: pa.Table) -> np.ndarray:
    column = rows.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def build_shard(rows: pa.Table) -> pa.Table:
    ids = rows.column("id").to_numpy()
    levels = levels_of(ids)
    order = np.lexsort((ids, -levels))
    ids, vectors = ids[order], matrix_of(rows)[order]
    layers = build_graph(prepared(vectors), levels[order])
    return pa.table({
        "dim": rows.column("dim")[:1], "shard": rows.column("shard")[:1], "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "sizes": pa.array([[len(x) for x in layers]], pa.list_(pa.int32())), "links": pa.array([b"".join(x.tobytes() for x in layers)], pa.binary()),
    })


def layers_of(links: bytes, sizes: list[int]) -> list[np.ndarray]:
    flat, out, at = np.frombuffer(links, np.int32), [], 0
    for i, size in enumerate(sizes):
        degree = DEGREE if i + 1 < len(sizes) else 2 * DEGREE
        out.append(flat[at : at + size * degree].reshape(size, degree))
        at += size * degree
    return out


def search_shard(index: pa.Table, block: pa.Table, k: int, width: int) -> pa.Table:
    """The best k of a shard for every query of a block."""
    shard = index.to_pylist()[0] if index.num_rows else None
    out: list[tuple] = []
    if shard is not None and block.num_rows:
        ids = np.frombuffer(shard["ids"], np.int64)
        vectors = np.frombuffer(shard["vectors"], np.float64).reshape(len(ids), -1)
        x, layers = prepared(vectors), layers_of(shard["links"], shard["sizes"])
        names, wanted = block.column("id").to_numpy(), matrix_of(block)
        scaled = wanted / np.abs(wanted).max(axis=1, keepdims=True)
        scaled = np.concatenate([scaled, np.zeros((len(scaled), 1))], axis=1).astype(np.float32)
        for a in range(0, len(names), BATCH):
            q = scaled[a : a + BATCH]
            found, _ = beam(x, layers[-1], q, descend(x, layers[:-1], q), max(1, min(max(width, k), len(ids))))
            row, column = np.nonzero(found >= 0)
            place = found[row, column]
            score = dot(wanted[a + row], vectors[place])
            order = np.lexsort((ids[place], -score, row))
            row, place, score = row[order], place[order], score[order]
            first = np.searchsorted(row, np.arange(len(q)))
            best = np.arange(len(row)) - first[row] < k
            out.append((names[a + row[best]], ids[place[best]], score[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "node": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """id, v, dim of the rows that take part, one per id."""
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("v", lambda c: c != 0.0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


@dataclass
class Index:
    """Graphs by shard (``INDEX_SCHEMA``), and the ids of nodes that stand for several rows (node, id)."""

    graphs: DataFrame
    copies: DataFrame
    shards: int


def build(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> Index:
    rows = stored(usable(vectors, id, vector), "vectors")
    nodes = rows.groupBy("v", "dim").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"))
    nodes = stored(nodes, "nodes")
    copies = rows.join(nodes.where("rows > 1").select("v", F.col("id").alias("node")), "v").select("node", "id")
    count, components = nodes.agg(F.count(F.lit(1)), F.sum(F.col("dim").cast("bigint"))).first()
    shards = max(1, -(-count // SHARD_ROWS), -(-(components or 0) * 8 // SHARD_BYTES))
    dealt = nodes.select("dim", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "v").repartition(shards, "dim", "shard")
    graphs = dealt.groupBy("dim", "shard").applyInArrow(build_shard, INDEX_SCHEMA)
    return Index(stored(graphs, "graphs"), stored(copies, "copies"), shards)


def search(index: Index, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding", width: int = BEAM_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each query, without the row of its own id."""
    wanted = usable(queries, id, vector)
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(index.shards - 1).cast("bigint"))))
    graphs = index.graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    keys = ("dim", "shard", "block")
    found = graphs.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(lambda g, q: search_shard(g, q, k + 1, width), "query_id bigint, node bigint, score double")
    # One node may be the query's own; of a node's rows the smallest k + 1 ids are enough.
    by_query = Window.partitionBy("query_id")
    found = found.withColumn("place", F.row_number().over(by_query.orderBy(F.desc("score"), "node"))).where(F.col("place") <= k + 1)
    copies = index.copies.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("place") <= k + 1).select("node", "id")
    rows = found.drop("place").join(copies, "node", "left").select("query_id", F.coalesce("id", "node").alias("vec_id"), "score").where("vec_id <> query_id")
    ranked = rows.withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op11_hnsw_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(build(vectors), vectors.where(F.col("vec_id") % 20 == 0), 20)


QUERIES = {"op11_hnsw_nearest": op11_hnsw_nearest}
# The search is approximate; over as few vectors as one beam may visit it finds what the exact query finds.
SQL = {
    "op11_hnsw_nearest": """
WITH v AS (SELECT vec_id::BIGINT AS vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0 GROUP BY 1)
SELECT q.vec_id AS query_id, (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id))::INTEGER AS rank, c.vec_id, list_inner_product(q.e, c.e) AS score
FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e) QUALIFY rank <= 20
"""
}
