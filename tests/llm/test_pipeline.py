import collections

from pyspark.sql import functions as F

from punctualis.llm.shared import stored, table
from tests.llm import fixtures as fx
from tests.llm.test_decontaminate import _plain, _tiling
from tests.llm.test_linededup import _judged
from tests.llm.test_minhash import _groups

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    import corpus_pipeline as cp

    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, stage in cp.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF), name))
    rows = [{(r.doc_id): r for r in s.collect()} for s in steps[:5]]
    assert all(s.columns == docs.columns for s in steps[:5])
    # Language ID: every text with a letter stays.
    assert set(rows[1]) == {i for i, r in rows[0].items() if any(c.isalpha() for c in r.text or "")}
    # Line dedup: exactly the lines that the brute-force join removes are missing.
    judged = _judged([(i, r.text) for i, r in rows[1].items()], least=1)
    want = {}
    for i, r in rows[1].items():
        gone = {n for n, _, removed in judged.get((i, r.text), []) if removed}
        text = "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in gone)
        if not gone or fx.words_of(text):
            want[i] = text
    assert {i: r.text for i, r in rows[2].items()} == want
    assert all(r.n_chars == len(r.text) for r in rows[2].values())
    # MinHash: the smallest id of each group of the all-pairs graph stays.
    groups = _groups([(i, r.text) for i, r in rows[2].items()], 5, 80)
    assert set(rows[3]) == {i for i, c in groups.items() if i == c}
    # Decontamination: documents that cover half of an item go.
    items = [_plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    seeds = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in items]
    dirty = set()
    for i, r in rows[3].items():
        words = _plain(r.text)
        grams = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
        for item, own in zip(items, seeds):
            if grams & own:
                near = [j for j in range(len(words)) if any(tuple(words[k : k + 5]) in own for k in range(max(0, j - 4), j + 1))]
                if _tiling(item, [words[j] if j in set(near) else f"\x00{j}" for j in range(near[0], near[-1] + 1)], 5) >= 0.5 * len(item):
                    dirty.add(i)
    assert set(rows[4]) == set(rows[3]) - dirty
    # Packing: every document's tokens exactly once.
    counts = collections.Counter()
    for r in steps[5].collect():
        counts[r.doc_id] += r.n_tokens
    assert set(counts) == set(rows[4])


def test_stages_take_empty_tables_and_awkward_rows(spark):
    import corpus_pipeline as cp

    for start in (fx.empty(spark), fx.awkward(spark, more=True)):
        docs = start
        for name, stage in cp.STAGES:
            before, docs = docs, stored(stage(spark, docs, SF), name)
            if name != cp.STAGES[-1][0]:
                assert docs.columns == before.columns
            docs.count()


def test_language_stage_without_labels_and_with_taken_names(spark):
    import corpus_pipeline as cp

    rows = [(1, "a clean text", None), (2, "12 34 !", None), (3, None, None), (4, "漢字", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'x' AS lang_pred", "1 AS lang_score", "2 AS lang_spans")
    for given in (docs, docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en")), docs.withColumn("lang", F.when(F.col("doc_id") == 1, "und"))):
        left = cp.language_id(spark, given, SF)
        assert left.columns == given.columns
        assert {tuple(r) for r in left.collect()} == {tuple(r) for r in given.collect() if r.doc_id in (1, 4)}
