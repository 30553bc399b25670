import numpy as np
import pytest

from punctualis.llm import minhash as mh
from punctualis.llm.components import components
from tests.llm.fixtures import awkward, awkward_rows, empty, lower_ascii, prose, words_of


def _sets(text, k):
    w = words_of(lower_ascii(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def _groups(rows, k, percent):
    rows = [(i, _sets(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("k, percent, block", [(3, 85, 2_000_000), (5, 80, 300)])
def test_against_all_pairs(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(mh, "BLOCK_SHINGLES", block)
    rows = awkward_rows()
    base = prose(60, 200).split()
    for n in range(40):  # a chain: each differs from the one before by a word
        base[(n * 37) % 200] = f"new{n}"
        rows.append((200 - n, " ".join(base), None, None, 0))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mh.group(df, k, percent).collect()
    assert len(got) == len(rows)
    want = _groups([(r[0], r[1]) for r in rows], k, percent)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == sorted((r[0], len(_sets(r[1], k))) for r in rows if r[0] is not None)


def test_near_dedup_keeps_all_columns(spark):
    df = awkward(spark, more=True)
    left = mh.near_dedup(df)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    assert 0 in ids and 2 not in ids and 1 not in ids and ids.count(None) == 2 and {6, 7, 8, 9} <= set(ids)
    assert mh.near_dedup(empty(spark)).count() == 0


def test_signature_is_a_superminhash():
    """Against the definition, one set at a time, and as an estimator with less variance than independent ranks."""
    pick = np.random.default_rng(1)
    sizes = [1, 2, 5, 40, 300]
    sets = [np.unique(pick.integers(0, 1 << 63, n, dtype=np.uint64)) for n in sizes]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    together = mh.super_minhash(np.concatenate(sets), offsets)
    for i, s in enumerate(sets):
        assert (together[i] == mh.super_minhash(s, np.array([0, len(s)]))[0]).all()
        assert (together[i] < np.iinfo(np.uint32).max).all()
    one = mh.super_minhash(sets[0], np.array([0, 1]))[0] >> np.uint32(mh._RANDOM_BITS)
    assert sorted(one.tolist()) == list(range(mh.PLACES))  # one element: every step once
    errors = []
    for _ in range(200):
        pool = np.unique(pick.integers(0, 1 << 63, 60, dtype=np.uint64))
        a, b = pool[:45], pool[15:]
        sig = mh.super_minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.var(errors) < 0.25 / mh.PLACES


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(300, 299), (299, 298), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 300: 298, 299: 298, 298: 298}
