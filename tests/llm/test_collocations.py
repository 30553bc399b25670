import re
from collections import Counter

import numpy as np
import pytest

from punctualis.llm import collocations as co
from tests.llm.fixtures import awkward, awkward_rows, empty, lower_ascii

SCHEMA = "lang string, text string"


def plain(rows, least, longest, percent):
    """Every phrase of every piece counted, every longer phrase tried."""
    count, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower_ascii(text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            count.update((lang, *words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    often = {p: n for p, n in count.items() if n >= least}
    subsumed = {(p[0], *p[i:j]) for p, n in often.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) - 1 and 100 * n >= percent * count[(p[0], *p[i:j])]}
    out = {}
    for p, a in often.items():
        if len(p) > 2 and p not in subsumed:
            cuts = [(2_000_000 * a // (count[p[: k + 1]] + count[(p[0], *p[k + 1 :])]), k, count[p[: k + 1]], count[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
            score, k, left, right = min(cuts)
            out[p[0], " ".join(p[1:])] = (a, k, left, right, totals[p[0]], score)
    return out


def texts():
    pick = np.random.default_rng(4)
    words = ["a", "b", "c", "d", "É", "x" * 90, "y" * 70 + "z", "日本", "B"]
    rows = [(["en", "de", None][i % 3], " ".join(pick.choice(words, 30)) + pick.choice([". ", "\n", "; "]) + " ".join(pick.choice(words[:3], 12))) for i in range(60)]
    rows += [("en", "new york city hall") for _ in range(40)] + [("en", "new york") for _ in range(5)] + [("fr", "one\ttwo  three.one two"), ("fr", ".,;"), ("de", None), (None, "")]
    return rows + [(r[2], r[1]) for r in awkward_rows()]


@pytest.mark.parametrize("least, longest, flush, shard", [(5, 4, 4_000_000, 32 << 20), (3, 3, 100, 500), (2, 5, 300, 2_000), (30, 2, 50, 100)])
def test_against_plain_counts(spark, monkeypatch, least, longest, flush, shard):
    monkeypatch.setattr(co, "SHARD_BYTES", shard)
    monkeypatch.setattr(co, "FLUSH_WORDS", flush)
    rows = texts()
    got = co.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least, longest)
    found = {(r.lang, r.phrase): (r.a, r.k, r.l, r.r, r.n, r.score) for r in got.collect()}
    assert found == plain(rows, least, longest, 80)


def test_collisions_are_counted_again(spark, monkeypatch):
    """Keys of eight bits under the first seed: the count is repeated with the next one."""
    whole = co.word_keys
    batches = spark.createDataFrame([("en", " ".join(f"w{i}" for i in range(400)))] * 3, SCHEMA).toArrow().to_batches()
    monkeypatch.setattr(co, "word_keys", lambda *a: whole(*a) & 0xFF | 1 if a[-1] == 1 else whole(*a))
    for seed, expected in ((1, True), (3, False)):
        parts = [p for b in batches for p in co.count_pairs(iter([b]), 2, seed)]
        import pyarrow as pa

        merged = [co.merge_shard(pa.Table.from_batches([p for p in parts if p.column("shard")[0].as_py() == s]), 2, 2).to_pylist() for s in (0, 1)]
        assert any(r["kind"] == co.COLLISION for m in merged for r in m) == expected


def test_awkward_tables(spark):
    assert co.collocations(empty(spark)).count() == 0
    df = awkward(spark, more=True).withColumnRenamed("piece", "phrase").withColumnRenamed("anchor", "words")
    want = plain([(r.lang, r.text) for r in df.collect()], 5, 4, 80)
    assert {(r.lang, r.phrase) for r in co.collocations(df, least=5).collect()} == set(want)
