import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from punctualis.llm import langid
from tests.llm.fixtures import awkward, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("lang", "text"))


def test_viterbi_against_all_paths():
    import itertools

    pick = np.random.default_rng(5)
    offsets = np.array([0, 4, 4, 5, 10])
    scores = pick.normal(size=(6, 3)).astype(np.float32) * 3
    index = pick.integers(0, 6, 10)
    path = langid.viterbi(scores, index, offsets, 2.0)
    for a, b in zip(offsets, offsets[1:]):
        value = lambda p: sum(scores[index[a + i], c] for i, c in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=int(b - a))), default=0.0)
        assert value(path[a:b].tolist()) == pytest.approx(best, abs=1e-4)


def test_held_out_accuracy(spark):
    got = langid.op5_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rate = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert rate > 0.98
    assert got.where("score < 0 OR score > 1 OR lang_pred IS NULL").count() == 0


def test_mixed_text_gives_spans(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 1500").select("lang", "text").collect()}
    half = {k: " ".join(v.split()[:100]) for k, v in docs.items()}
    text = half["en"] + " " + half["fr"] + " " + half["de"]
    name, score, spans = langid.label(pa.array([text]), model)
    spans = spans.to_pylist()[0]
    assert [s["lang"] for s in spans if s["words"] > 30] == ["en", "fr", "de"]
    assert sum(s["words"] for s in spans) == 300 and 0.3 < score[0].as_py() < 0.5


def test_scripts_narrow_candidates(spark):
    rows = [("ru", "мама мыла раму"), ("en", "the cat sat on the mat"), ("el", "η γάτα")] * 5
    fitted = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    names, _, _ = langid.label(pa.array(["qqq", "щщщ", "ψψψ", "漢字"]), fitted)
    assert names.to_pylist()[:3] == ["en", "ru", "el"]
    assert names.to_pylist()[3] in fitted.languages  # no language uses the script: n-grams alone


def test_awkward_rows(spark, model):
    df = awkward(spark, more=True)
    got = langid.identify(df, model)
    assert got.columns == [*df.columns, "lang_pred", "lang_score", "lang_spans"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") != letters
        if not letters:
            assert r.lang_score == 0 and r.lang_spans == []
    assert langid.identify(empty(spark), model).count() == 0
    nothing = langid.fit(empty(spark).select("lang", "text"))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_sample_bound(spark):
    rows = [("a", f"text {i}") for i in range(400)] + [("b", "one"), (None, "x"), ("a", None)]
    got = langid.training_sample(spark.createDataFrame(rows, "lang string, text string"), sample=10).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"a": 10, "b": 1}


def test_sample_counts_texts_not_copies(spark):
    rows = [("a", f"text {i}") for i in range(300)] + [("a", "copy")] * 20_000 + [("b", "same")] * 1000 + [("b", "other")] * 1000
    got = langid.training_sample(spark.createDataFrame(rows, "lang string, text string"), sample=50).collect()
    assert len(got) == len({(r.lang, r.text) for r in got})
    assert sorted(r.lang for r in got) == ["a"] * 50 + ["b"] * 2
