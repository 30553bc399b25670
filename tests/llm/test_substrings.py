import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from punctualis.llm import fmindex as fm
from punctualis.llm import regions as rg
from punctualis.llm import suffixarrays as sa
from punctualis.llm import textkit as tk
from tests.llm.fixtures import awkward, awkward_rows, empty, words_of

SETTINGS = [{}, {"hot": 1, "shard_units": 200}, {"hot": 3, "shard_units": 10**9}]


@pytest.mark.parametrize("change", SETTINGS)
def test_words_against_brute_force(spark, change):
    rows = awkward_rows()
    seen = {}
    texts = [(r[0], words_of(r[1])) for r in rows]
    for _, w in texts:
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    want = []
    for doc_id, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        want.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = fm.remove_repeats(awkward(spark, more=True), dataclasses.replace(fm.KIND, **change)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("change", SETTINGS)
def test_bytes_against_brute_force(spark, change, monkeypatch):
    monkeypatch.setattr(sa, "BATCH", 64)
    rows = sorted(awkward_rows(), key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for n, r in enumerate(rows):
        b = (r[1] or "").encode()
        for i in range(len(b) - 99):
            first.setdefault(b[i : i + 100], ((r[0] is None, r[0] or 0), i))
    want = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] != ((r[0] is None, r[0] or 0), i):
                gone[i : i + 100] = [True] * 100
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want.append((r[0], len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    got = sa.remove_repeats(awkward(spark, more=True), dataclasses.replace(sa.KIND, **change))
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    assert fm.remove_repeats(empty(spark)).count() == 0
    assert sa.remove_repeats(empty(spark)).count() == 0


def test_fm_index_counts_and_statistics():
    pick = np.random.default_rng(4)
    regions = [pick.integers(1, 4, n) for n in (5, 30, 1, 17, 30)]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in regions])])
    weights = np.array([1, 2, 1, 3, 1])
    index = fm.FMIndex(np.concatenate(regions), offsets, weights, 4)
    strings = ["".join(map(str, r)) for r in regions]
    for _ in range(200):
        pattern = pick.integers(1, 4, pick.integers(1, 8))
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            low, high = index.extend(np.array([c]), low, high)
        text = "".join(map(str, pattern))
        count = sum(w * sum(s.startswith(text, i) for i in range(len(s))) for s, w in zip(strings, weights))
        assert (index.occurrences(low, high)[0] if high[0] > low[0] else 0) == count
    region, start, end = fm.repeated_runs(index, np.concatenate(regions), offsets, 6)
    found = {(r, i) for r, s, e in zip(region, start, end) for i in range(s, e - 5)}
    for r, s in enumerate(strings):
        for i in range(len(s) - 5):
            count = sum(w * sum(t.startswith(s[i : i + 6], j) for j in range(len(t))) for t, w in zip(strings, weights))
            assert ((r, i) in found) == (count > 1)


def test_levels_stay_logarithmic():
    family, pick = sa.Family(), np.random.default_rng(2)
    known = set()
    for _ in range(200):
        keys = np.unique(np.array([b"%06d" % x for x in pick.integers(0, 10**6, 50)]))
        assert (family.known(keys) == [k in known for k in keys]).all()
        family.add(keys[~family.known(keys)])
        known |= set(keys)
        assert all(2 * len(b) < len(a) for a, b in zip(family.levels, family.levels[1:]))
    assert len(family.levels) <= 14


def test_regions_partition_windows_and_depend_on_content():
    data = np.frombuffer(("abcdefgh" * 40 + "the quick brown fox " * 30).encode(), np.uint8)
    kind = dataclasses.replace(sa.KIND, length=50, gram=10)
    owner, anchor, first, n = rg.find_regions(kind, data, np.array([0, 320, len(data)]))
    for text, size in ((0, 320), (1, len(data) - 320)):
        covered = np.concatenate([np.arange(f, f + k) for o, f, k in zip(owner, first, n) if o == text])
        assert (covered == np.arange(size - 49)).all()
    shifted = np.concatenate([np.frombuffer(b"zz" * 35, np.uint8), data[:320]])
    other = rg.find_regions(kind, shifted, np.array([0, len(shifted)]))
    assert set(anchor[owner == 0]) <= set(other[1])


def test_sliding_minimum():
    values = np.random.default_rng(3).integers(0, 100, 57)
    for width in (1, 2, 7, 56, 57, 58):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert tk.sliding_min(values, width).tolist() == want


def test_match_takes_sliced_tables():
    rows = pa.table({"doc_id": [3, 1, 1], "h": [0, 0, 0], "first": pa.array([0, 0, 50], pa.int32()), "n": pa.array([1, 1, 1], pa.int32()), "weight": [1, 1, 1], "content": [b"q" * 100, b"p" * 100, b"p" * 100]})
    got = sa.match_shard(rows.slice(1)).to_pylist()
    assert got == [{"doc_id": 1, "h": 0, "first": 50, "n": 1}]
