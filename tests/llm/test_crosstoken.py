import hashlib
from collections import Counter

import numpy as np
import pytest

from punctualis.llm import crosstoken as ct
from tests.llm.fixtures import awkward, awkward_rows, empty

TEXTS = [
    "<|endoftext|> plain <s> text", "a▁b ▁ c", "two  spaces   three　wide hard", "\ttab \n line\r\n end ", "日本語の文章 と 漢字", "été à la plage", "  lead", "\x00 zero", "don't we'll 123 4567.89 (x)", " ", "\U0001f600 \U0001f680x",
    "word " * 300, "x" * 3000, "à Å ǿ аб в", "a\u0085 b  c﻿ d", "<0x41> A",
]


def plain(texts):
    """Whole texts encoded by the libraries, common ends by sets, links counted over all."""
    v = ct.vocabularies(*(f"{ct.FOLDER}/{f}" for f in ct.FILES))
    out, counts = [], Counter()
    for text in texts:
        a = v.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(v.bytes_a[i] for i in a) != whole or b"".join(v.bytes_b[i] for i in b) != whole:
            out.append(([], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(names[i]) for i in ids]).tolist() for ids, names in ((a, v.bytes_a), (b, v.bytes_b)))
        cuts = [(ends_a.index(e) + 1, ends_b.index(e) + 1) for e in sorted(set(ends_a) & set(ends_b))]
        counts.update((a[i - 1], b[j - 1]) for i, j in cuts)
        out.append((a, b, cuts))
    return out, counts


def groups(a, b, cuts):
    parts, x, y = [], 0, 0
    for i, j in cuts:
        parts.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        x, y = i, j
    return ";".join(parts)


def rows_of(want, counts):
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for a, b, cuts in want:
        links = [(a[i - 1], b[j - 1]) for i, j in cuts]
        text = groups(a, b, cuts)
        out.append((len(a), len(b), len(cuts), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("memo", [400_000, 3])
def test_against_whole_encodings(spark, monkeypatch, memo):
    monkeypatch.setattr(ct, "MEMO_WORDS", memo)
    texts = [r[1] for r in awkward_rows()] + TEXTS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    want, counts = plain(texts)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in ct.rate_links(df).collect()}
    assert got == dict(enumerate(rows_of(want, counts)))
    for r in ct.align(df).collect():
        a, b, cuts = want[r.doc_id]
        assert (r.a_ids, r.b_ids, list(zip(r.a_cuts, r.b_cuts))) == (a, b, cuts)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    want, counts = plain([r.text for r in rows])
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in ct.op12_cross_tokenizer_alignment(spark, sf_dir).collect()}
    assert got == {r.doc_id: x for r, x in zip(rows, rows_of(want, counts))}


def test_awkward_tables(spark):
    more = ct.rate_links(awkward(spark, more=True)).collect()
    assert len(more) == len(awkward_rows()) and sum(r.doc_id is None for r in more) == 2
    assert ct.rate_links(empty(spark)).count() == 0


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_gallop(lane):
    pick = np.random.default_rng(5)
    lists = [(np.unique(pick.integers(0, 4 * n + 1, n)), np.unique(pick.integers(0, 4 * n + 1, m))) for n, m in [(0, 0), (0, 5), (1, 300), (7, 7), (60, 900), (500, 500)]]
    short, long = (np.concatenate([x[i] for x in lists]) for i in (0, 1))
    borders = [np.concatenate([[0], np.cumsum([len(x[i]) for x in lists])]) for i in (0, 1)]
    i, j = ct.gallop(short, (borders[0][:-1], borders[0][1:]), long, (borders[1][:-1], borders[1][1:]), lane)
    assert (short[i] == long[j]).all()
    assert short[i].tolist() == [x for a, b in lists for x in np.intersect1d(a, b).tolist()]
