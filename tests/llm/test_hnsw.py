import numpy as np
import pytest
from pyspark.sql import functions as F

from punctualis.llm import hnsw

SCHEMA = "vec_id bigint, embedding array<double>"


def exact(rows, queries, k):
    """Brute force by the stated rules."""
    kept = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = min(kept.get(i, v), v)

    def score(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    return {i: sorted(((-score(kept[i], v), j) for j, v in kept.items() if j != i and len(v) == len(kept[i])))[:k] for i in queries if i in kept}


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (-r.score, r.vec_id)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [v[n] for n in sorted(v)] for q, v in out.items()}


def awkward_rows():
    pick = np.random.default_rng(3)
    rows = [(i, (pick.integers(-3, 4, 6) * 0.5).tolist()) for i in range(120)]  # many ties
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(200, 320)]  # a third of all rows is one vector
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, [float("nan")] * 6), (405, [float("inf"), 1.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(None, [1.0] * 6), (20, [9.0, 9.0, 9.0, 9.0, 9.0, 9.0]), (-20, [0.0, -0.0, 1.0, 0.0, 0.0, 0.0]), rows[40], (500, [1.0, 2.0]), (520, [-2.0, 1e-3])]
    return rows


@pytest.mark.parametrize("shard_rows", [8192, 20])
def test_awkward_rows_against_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", shard_rows)
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("v", F.lit("extra")).withColumn("shard", F.lit(2))
    queries = [i for i, _ in rows if i is not None and i % 20 == 0]
    got = results(hnsw.search(hnsw.build(df), df.where("vec_id % 20 = 0"), 7))
    assert got == exact(rows, queries, 7)
    assert all(len(got[i]) == 1 for i in (500, 520)) and 400 not in got


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [1.0, 0.0])], SCHEMA)
    assert hnsw.search(hnsw.build(none), some, 3).count() == 0
    assert hnsw.search(hnsw.build(some), none, 3).count() == 0
    assert hnsw.search(hnsw.build(some), some, 3).count() == 0


@pytest.mark.parametrize("kind", ["sphere", "lengths", "near copies"])
def test_recall_over_several_shards(spark, monkeypatch, kind):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 900)
    pick = np.random.default_rng(11)
    v = pick.normal(size=(3000, 32))
    if kind == "sphere":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind == "lengths":
        v *= pick.lognormal(size=(3000, 1))
    if kind == "near copies":
        v[:1000] = v[0] + pick.normal(size=(1000, 32)) * 1e-3
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SCHEMA)
    found = results(hnsw.search(hnsw.build(df), df.where("vec_id % 20 = 0"), 20))
    best = np.argsort(-(v[::20] @ v.T), axis=1)
    hits = [len({j for _, j in found[20 * n]} & set([j for j in row if j != 20 * n][:20])) for n, row in enumerate(best.tolist())]
    assert len(found) == 150 and np.mean(hits) / 20 >= 0.9


def test_graph_has_its_form():
    pick = np.random.default_rng(2)
    ids = np.arange(2000)
    levels = hnsw.levels_of(ids)
    order = np.lexsort((ids, -levels))
    layers = hnsw.build_graph(hnsw.prepared(pick.normal(size=(2000, 8))), levels[order])
    assert [len(x) for x in layers] == [(levels >= n).sum() for n in range(levels.max(), -1, -1)] and layers[-1].shape == (2000, 2 * hnsw.DEGREE)
    for links in layers:
        row, _ = np.nonzero(links >= 0)
        assert links.max() < len(links) and all(len(set(x[x >= 0])) == (x >= 0).sum() and i not in x for i, x in enumerate(links))
    seen, stack = {0}, [0]
    while stack:
        new = set(layers[-1][stack.pop()].tolist()) - seen - {-1}
        seen |= new
        stack += new
    assert len(seen) > 1990
