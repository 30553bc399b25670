import numpy as np
import regex
from pyspark.sql import functions as F

from punctualis.llm import decontaminate as dc
from tests.llm.fixtures import awkward, empty, prose, words_of

ITEMS = "item_id bigint, text string, extra string"


def _plain(text):
    spaced = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}])", r" \1 ", regex.sub("[。、，！？「」]", " ", text or ""))
    return words_of("".join(c.lower() if c.isalnum() or not c.isascii() else " " for c in spaced))


def _tiling(item, doc, seed):
    """Greedy string tiling by its definition."""
    used_i, used_d, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and i + n not in used_i and d + n not in used_d:
                    n += 1
                best = max(best, (n, -i, -d))
        if best[0] < seed:
            return covered
        n, i, d = best[0], -best[1], -best[2]
        used_i |= set(range(i, i + n))
        used_d |= set(range(d, d + n))
        covered += n


def test_against_the_definition(spark):
    item = prose(50, 30).split()
    turned = item[20:] + ["and"] + item[:10] + ["or"] + item[10:20]
    docs = [
        (0, " ".join(turned)), (1, prose(51, 10) + " " + " ".join(item[:14]) + " " + prose(52, 10)), (2, " ".join(item[:15] + item[:15])),
        (3, ", ".join(w.upper() for w in item)), (4, None), (5, ""), (None, " ".join(item)), (6, " ".join(item[::2])), (6, " ".join(item)),
        (7, prose(53, 20_000) + " " + " ".join(item[:20])),
    ]
    items = [(1, " ".join(item), ""), (2, prose(54, 4), ""), (3, None, ""), (None, " ".join(item[:20]), ""), (1, " ".join(item), "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, coverage string")
    bench = spark.createDataFrame(items, ITEMS)
    expected = []
    for doc_id, text in docs:
        for item_id, other, _ in items:
            a, b = _plain(other), _plain(text)
            if a and len(b) < 5000:
                covered = _tiling(a, b, min(5, len(a)))
                if covered >= 0.5 * len(a):
                    expected.append((doc_id, item_id, covered))
    expected += [(7, 1, 20), (7, 1, 20), (7, None, 20)]
    for size in (8 << 20, 100):
        got = [(r.doc_id, r.item_id, r.covered_words) for r in dc.contaminated_pairs(df, bench, block_bytes=size).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        clean = dc.decontaminate(df, bench, block_bytes=size)
        assert clean.columns == df.columns
        assert {r.doc_id for r in clean.collect()} == {1, 4, 5, 6} - ({1} if any(e[0] == 1 for e in expected) else set())


def test_short_items_and_unspaced_scripts(spark):
    han, thai, kana = "今天天气很好，我们去公园散步。明天也去！", "ประเทศไทยสวยงามมาก", "これはテストです。「とても」長い、文章"
    texts = [
        "Before " + han + " after", "明天也去，我们去公园散步。今天天气很好", "其他文字完全不同", thai + " word", kana.replace("。", " "), "Paris is the capital", "the capital, is: PARIS", "capital of Spain", None, "",
        "“quoted” naïve café", "naïve café",
    ]
    items = [(1, han, ""), (2, thai, ""), (3, kana, ""), (4, "is the capital", ""), (5, "paris", ""), (6, "?!", ""), (7, "the capital is Paris", ""), (8, "naïve café", ""), (9, "", ""), (10, "去", "")]
    expected = set()
    for n, text in enumerate(texts):
        for item_id, other, _ in items:
            a = _plain(other)
            covered = _tiling(a, _plain(text), min(5, len(a))) if a else 0
            if a and covered >= 0.5 * len(a):
                expected.add((n, item_id, len(a), covered))
    assert {(0, 1), (1, 1), (3, 2), (4, 3), (5, 4), (5, 5), (6, 5), (6, 7), (11, 8), (1, 10)} <= {e[:2] for e in expected}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("digest", F.lit("x"))
    bench = spark.createDataFrame(items, ITEMS)
    for size in (8 << 20, 60):
        assert {(r.doc_id, r.item_id, r.item_words, r.covered_words) for r in dc.contaminated_pairs(df, bench, block_bytes=size).collect()} == expected
        clean = dc.decontaminate(df, bench, block_bytes=size)
        assert clean.columns == df.columns
        assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {e[0] for e in expected}


def test_random_tilings():
    for seed in range(30):
        pick = np.random.default_rng(seed)
        a, b = pick.integers(0, 3, 25).astype(np.uint64), pick.integers(0, 3, 40).astype(np.uint64)
        hits = [(i, d) for i in range(23) for d in range(38) if (a[i : i + 3] == b[d : d + 3]).all()]
        if hits:
            tiles = dc.tile(a, b, np.array([h[0] for h in hits]), np.array([h[1] for h in hits]), 3)
            assert sum(n for n, _, _ in tiles) == _tiling(a.tolist(), b.tolist(), 3)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], ITEMS)
    df = awkward(spark, more=True)
    assert dc.contaminated_pairs(df, bench).count() == 0
    assert dc.decontaminate(df, bench).count() == df.count()
    assert dc.contaminated_pairs(empty(spark), spark.createDataFrame([(1, prose(1, 30), "")], ITEMS)).count() == 0
