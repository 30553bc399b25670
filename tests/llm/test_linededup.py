import pytest

from punctualis.llm import linededup as ld
from tests.llm.fixtures import awkward, awkward_rows, empty, lower_ascii, words_of


def _judged(rows, percent=80, least=5):
    """Every line against every earlier one."""
    order = lambda d, i: (d is None, d or 0, i)
    lines = []
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        for i, line in enumerate((text or "").split("\n")):
            s = frozenset(lower_ascii(w) for w in words_of(line))
            if len(s) >= least:
                lines.append((order(doc_id, i), doc_id, text, i, s))
    first = {}
    for o, _, _, _, s in sorted(lines, key=lambda x: x[0]):
        first.setdefault(s, o)
    out = {}
    for o, doc_id, text, i, s in lines:
        near = [p for t, p in first.items() if t != s and 100 * len(s & t) >= percent * len(s | t)]
        removed = any(p < first[s] for p in near) or first[s] != o
        out.setdefault((doc_id, text), []).append((i, len(near), removed))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 2, "DENSE_GROUP": 1, "SHARD_RECORDS": 50}])
def test_against_all_pairs(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ld, name, value)
    rows = awkward_rows()
    variants = "one two three four five six seven eight nine ten eleven twelve".split()
    for k in range(14):
        rows.append((100 + k, "\n".join(" ".join(variants[: 9 + (k + j) % 4]) for j in range(2)), None, None, 0))
    expected = _judged(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    texts = {(r.doc_id, r.h): r.text for r in ld.keyed(df).collect()}
    got = ld.judged_lines(df, least=5).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id, r.h]
        want = expected.get((r.doc_id, text)) or expected.get((r.doc_id, None), []) if not text else expected.get((r.doc_id, text), [])
        assert [(x.line, x.links, x.removed) for x in r.lines] == want
        assert r.n_lines == (len(text.split("\n")) if text else 0)


def test_removal_keeps_columns_and_first_lines(spark):
    df = awkward(spark, more=True)
    left = ld.remove_lines(df)
    assert left.columns == df.columns
    got = {(r.doc_id, r.text) for r in left.collect()}
    rows = awkward_rows()
    assert (3, rows[3][1].rsplit("\n", 1)[0]) in got  # the last line repeats the first in other case
    assert (None, None) in got and (7, "") in got and (9, "one") in got
    assert not any(d == 2 for d, _ in got)  # a copy goes as a whole
    assert ld.remove_lines(empty(spark)).count() == 0
    assert ld.judged_lines(empty(spark)).count() == 0


SHORT = [
    (1, "one two three four\none two three four five\n}\nyes no"), (2, "}\nNO yes\none two three\n漢字漢字"), (3, "漢字漢字\n}\none two three four five six\nfour three two one"),
    (4, "one two three five\nno\n \n}"), (5, "one two three four five\none two three six\nsix"),
]


def test_short_lines_are_compared(spark, monkeypatch):
    expected = _judged(SHORT, least=1)
    df = spark.createDataFrame(SHORT, "doc_id bigint, text string")
    got = {r.doc_id: [(x.line, x.links, x.removed) for x in r.lines] for r in ld.judged_lines(df, least=ld.EVERY_LINE).collect()}
    assert got == {d: v for (d, _), v in expected.items()}
    monkeypatch.setattr(ld, "table", lambda *_: df)
    query = {r.doc_id: (r.n_compared, r.n_removed) for r in ld.op2_line_dedup(spark, "").collect()}
    assert query == {d: (len(v), sum(x[2] for x in v)) for (d, _), v in expected.items()}


def test_pipeline_stage_removes_short_lines(spark):
    import corpus_pipeline as cp

    df = spark.createDataFrame(SHORT, "doc_id bigint, text string")
    judged = _judged(SHORT, least=1)
    want = {}
    for doc_id, text in SHORT:
        gone = {n for n, _, removed in judged[doc_id, text] if removed}
        left = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        if not gone or words_of(left):
            want[doc_id] = left
    assert {r.doc_id: r.text for r in cp.line_dedup(spark, df, "").collect()} == want


def test_awkward_lines_of_any_length(spark):
    rows = awkward_rows()
    expected = _judged(rows, least=1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    texts = {(r.doc_id, r.h): r.text for r in ld.keyed(df).collect()}
    for r in ld.judged_lines(df, least=1).collect():
        assert [(x.line, x.links, x.removed) for x in r.lines] == expected.get((r.doc_id, texts[r.doc_id, r.h]), [])


def _templated(n):
    """Lines of one template (ten words, two vary) and groups of similar ones among them."""
    rows = [(k, " ".join([*"tpl0 tpl1 tpl2 tpl3 tpl4 tpl5 tpl6 tpl7".split(), f"a{k}", f"b{k % 7}" if k % 3 else f"c{k}"])) for k in range(n)]
    return rows + [(1000 + k, f"{text} tail") for k, text in rows[::4]]


def test_hot_words_are_split_into_tasks(spark, monkeypatch):
    limit = 12
    monkeypatch.setattr(ld, "HOT_RECORDS", limit)
    rows = _templated(60)
    df = ld.keyed(spark.createDataFrame(rows, "doc_id bigint, text string"))
    counts = ld.bucket_counts(df, 1)
    hot = ld.hot_tokens(df, counts, 80, 1)
    assert len(hot[0]) and (hot[1] > 1).all()
    tasks = {}
    for r in ld.deal(ld.prefix_records(df, counts, hot, 1, 80, 1)).collect():
        if r.shard < 0:
            records = ld.unpack(r.records)
            tasks.setdefault((r.shard, r.x, r.y), []).append(len(records))
            assert len(set(records["token"])) == 1
    assert len(tasks) > 3 * len(hot[0])
    assert max(sum(v) for v in tasks.values()) < 5 * limit < len(rows)  # a word of all lines is no single task
    expected = _judged(rows, least=1)
    got = {r.doc_id: [(x.line, x.links, x.removed) for x in r.lines] for r in ld.judged_lines(df.drop("h"), least=1).collect()}
    assert got == {d: v for (d, _), v in expected.items()}
    assert any(x[1] for v in got.values() for x in v)


def _frequent(n):
    """Lines of a few frequent words, so that every prefix word is in many lines; some lines differ by one word."""
    words = [f"w{k}" for k in range(24)]
    rows = []
    for k in range(n):
        start = [words[(k * 7 + j * (1 + k % 5)) % 24] for j in range(4 + k % 9)]
        rows.append((k, " ".join(start) + "\n" + " ".join([*start, f"w{k % 3}"])))
    return rows


def test_runs_of_frequent_words_lose_no_link(spark):
    """With a limit of one line, every word goes on to runs; lines that are similar still share a run."""
    rows = _frequent(80)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    levels = ld.rarity(ld.bucket_counts(ld.keyed(df), 1))
    data, offsets = ld.tk.flat(ld.pa.array([text for _, text in rows]))
    _, _, sets, hashes = ld.line_sets(data, offsets, 1, levels)
    sizes = ld.np.diff(sets)
    plain = {i: set(hashes[sets[i] : sets[i + 1]].tolist()) for i in range(len(sizes))}
    limit, ld.GROUP = ld.GROUP, 1
    try:
        line, token, place, depth = ld.runs(hashes, sets, ld.prefix_length(sizes, 80), levels)
    finally:
        ld.GROUP = limit
    assert depth.max() == ld.DEEPEST
    found = {}
    for i, t, most in zip(line.tolist(), token.tolist(), (sizes[line] - place - 1 + depth).tolist(), strict=True):
        found.setdefault(i, {})[t] = most
    links = 0
    for i in plain:
        for j in range(i):
            share = len(plain[i] & plain[j])
            if plain[i] != plain[j] and 100 * share >= 80 * len(plain[i] | plain[j]):
                links += 1
                assert any(min(found[i][t], found[j][t]) >= share for t in found[i].keys() & found[j].keys())
    assert links
    expected = _judged(rows, least=1)
    got = {r.doc_id: [(x.line, x.links, x.removed) for x in r.lines] for r in ld.judged_lines(df, least=1).collect()}
    assert got == {d: v for (d, _), v in expected.items()}


def test_large_word_groups_meet_in_columns():
    """A group of a thousand lines that share a word passes no loop over its lines, and links only what is near."""
    n, calls = 1000, []
    records = ld.np.zeros(n, ld._RECORD)
    records["token"], records["node"], records["size"], records["most"] = 5, ld.np.arange(n), 20, 20
    records["bits"] = ld.np.random.default_rng(3).integers(0, 1 << 63, (n, ld.MASK_WORDS), dtype=ld.np.uint64)
    records["bits"][1::50] = records["bits"][0::50]
    forest = ld._forest
    ld._forest = lambda *x: calls.append(x) or forest(*x)
    try:
        blobs = ld.pa.table({"records": [ld.pack(records[:600]), ld.pack(records[600:])], "side": [0, 0]})
        links = ld.shard_links(blobs, 80)
    finally:
        ld._forest = forest
    assert not calls
    assert {frozenset(x) for x in zip(*(c.to_pylist() for c in links.columns), strict=True)} == {frozenset((k, k + 1)) for k in range(0, n, 50)}
