"""Language identification by spans.

Scores: every word is scored per language by hashed character n-grams (orders 1 to 3, letters only, with word
edges), log-likelihoods with additive smoothing. Scripts: each language keeps the scripts that hold at least a
hundredth of its training letters; a word counts only for languages that use its scripts. Spans: Viterbi over the
words of a text with a penalty per change of language; the path gives the spans, the document gets the language
with the most letters, and the score is its share of the letters.

The model is fitted on at most ``sample`` different texts per language, those with the smallest content hash (a documented
bound, so it is a few MB whatever the corpus); everything else covers every text, whole.

Defined results: NULL text or no letter gives ``und`` with score 0 and no span; words without a letter take the
language of their surroundings; a text whose letters are in scripts that no language uses is scored by n-grams alone;
ties go to the alphabetically first language; a table without labelled rows gives ``und`` throughout; a column of the input
with the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from punctualis.llm import textkit as tk
from punctualis.llm.shared import table

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE = 2000
PENALTY = 8.0
# Code point ranges of scripts (fixed values of the Unicode blocks); everything else is "other".
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
_tables: dict[str, np.ndarray] = {}


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter, and the number of its script (built once per worker)."""
    if not _tables:
        _tables["letter"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        script = np.zeros(0x110000, np.uint8)
        for name, low, high in SCRIPTS:
            script[low : high + 1] = SCRIPT_NAMES.index(name)
        _tables["script"] = script
    return _tables["letter"], _tables["script"]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, float32
    scripts: np.ndarray  # languages x scripts, bool
    penalty: float = PENALTY


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased words and the offsets between the words."""
    words = pc.utf8_lower(words)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    data, _ = tk.flat(words)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum(lengths)])


def _grams(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and word of every n-gram of the letters of each word; letters of each word; (words x scripts) letters."""
    letter, script = code_tables()
    count = len(offsets) - 1
    owner = np.repeat(np.arange(count), np.diff(offsets))
    is_letter = letter[codes]
    codes, owner = codes[is_letter], owner[is_letter]
    scripts = np.bincount(owner * len(SCRIPT_NAMES) + script[codes], minlength=count * len(SCRIPT_NAMES)).reshape(count, -1)
    letters = scripts.sum(axis=1)
    # Each word with letters as one run: edge, letters, edge.
    has = letters > 0
    lengths = np.where(has, letters + 2, 0)
    word, place = tk.ragged(lengths)
    padded = np.ones(len(word), np.uint64)
    padded[(place > 0) & (place < lengths[word] - 1)] = codes
    buckets, owners = [], []
    for order in ORDERS:
        if len(padded) < order:
            continue
        h = np.full(len(padded) - order + 1, order, np.uint64)
        for i in range(order):
            h = (h * np.uint64(0x100000001B3)) ^ padded[i : len(padded) - order + 1 + i]
        inside = word[: len(h)] == word[order - 1 :]
        if order == 1:
            inside &= padded[: len(h)] != 1
        buckets.append((tk.mix(h[inside]) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[: len(h)][inside])
    return np.concatenate(buckets or [np.zeros(0, np.int64)]), np.concatenate(owners or [np.zeros(0, np.int64)]), scripts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial n-gram and script counts per language; scripts are counted under negative buckets."""
    totals: dict[str, np.ndarray] = {}
    width = BUCKETS + len(SCRIPT_NAMES)
    for batch in batches:
        languages = batch.column("lang").dictionary_encode()
        for i, language in enumerate(languages.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(languages.indices, i))
            _, offsets = tk.flat(texts)
            for a, b in tk.chunks(offsets):
                words = pc.list_flatten(pc.utf8_split_whitespace(texts.slice(a, b - a)))
                buckets, _, scripts = _grams(*_codes(words))
                mine = totals.setdefault(language, np.zeros(width, np.int64))
                mine[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                mine[BUCKETS:] += scripts.sum(axis=0)
    for language, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])], ["lang", "bucket", "n"])


def training_sample(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` different texts of each language, those with the smallest content hash; texts decide, not ids.

    Copies count once. Only rows whose hash lies under a bound computed from the language's number of different hashes
    go on to the ranking, so the shuffle holds a few times ``sample`` texts per language; copies are merged before it. The
    counts, one per language, go through the driver.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = {lang: int(min(1.0, 4.0 * sample / n) * (1 << 64)) - (1 << 63) - 1 for lang, n in counts.items()}
    bound = F.element_at(F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair)), F.col("lang")) if bounds else F.lit(0)
    rank = F.row_number().over(W.Window.partitionBy("lang").orderBy("h", "text"))
    return rows.where(F.col("h") <= bound).distinct().withColumn("__rank", rank).where(F.col("__rank") <= sample).select("lang", "text")


def fit(labelled: DataFrame, sample: int = SAMPLE, penalty: float = PENALTY) -> Model:
    """Fit on labelled texts (columns lang, text). The driver receives at most BUCKETS + scripts sums per language."""
    parts = training_sample(labelled, sample).mapInArrow(_count, "lang string, bucket bigint, n bigint")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(languages), len(SCRIPT_NAMES)))
    column = sums["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)
    bucket, n = sums["bucket"].to_numpy(), sums["n"].to_numpy()
    gram = bucket < BUCKETS
    counts[bucket[gram], column[gram]] = n[gram]
    scripts[column[~gram], bucket[~gram] - BUCKETS] = n[~gram]
    weights = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    return Model(languages, weights, scripts >= 0.01 * scripts.sum(axis=1, keepdims=True) if len(languages) else scripts > 0, penalty)


def word_scores(words: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(words x languages) scores and the letters of each word; words without letters score 0 everywhere."""
    buckets, owner, scripts = _grams(*_codes(words))
    scores = np.empty((len(words), len(model.languages)), np.float32)
    for i in range(len(model.languages)):
        scores[:, i] = np.bincount(owner, model.weights[buckets, i], len(words))
    allowed = (scripts.astype(np.float32) @ model.scripts.T.astype(np.float32)) == scripts.sum(axis=1, keepdims=True)
    scores[~allowed & allowed.any(axis=1, keepdims=True)] -= 1e4
    return scores, scripts.sum(axis=1)


def viterbi(scores: np.ndarray, index: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word of many texts at once: step t handles the t-th word of every text that has one."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = offsets[:-1][order], lengths[order]
    n_langs = scores.shape[1]
    # Bit per language and word: did the best way into it come from elsewhere; and which language was best before.
    switched = np.zeros((len(index), n_langs), bool)
    best_before = np.zeros(len(index), np.int16)
    active = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), "left")
    state = np.zeros((len(lengths), n_langs), np.float32)
    for t, k in enumerate(active):
        at = firsts[:k] + t
        s = state[:k]
        best = s.argmax(axis=1)
        top = s[np.arange(k), best][:, None]
        s -= top
        switched[at] = s < -penalty
        best_before[at] = best
        np.maximum(s, -penalty, out=s)
        s += scores[index[at]]
    path = np.zeros(len(index), np.int16)
    current = state.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = firsts[:k] + t
        c = current[:k]
        path[at] = c
        current[:k] = np.where(switched[at, c], best_before[at], c)
    return path


def label(batch_texts: pa.Array, model: Model):
    """Language, score and spans of each text of an Arrow array."""
    lists = pc.utf8_split_whitespace(pc.fill_null(batch_texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    words = pc.list_flatten(lists)
    coded = words.dictionary_encode()
    scores, letters = word_scores(coded.dictionary, model)
    index = coded.indices.to_numpy()
    path = viterbi(scores, index, offsets, model.penalty)
    count, n_langs = len(offsets) - 1, len(model.languages)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    share = np.bincount(owner * n_langs + path, letters[index], count * n_langs).reshape(count, n_langs)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    score = np.where(total > 0, share[np.arange(count), best] / np.maximum(total, 1), 0.0)
    names = np.array([*model.languages, "und"], dtype=object)[np.where(total > 0, best, n_langs)]
    # Spans: maximal runs of words of one language.
    starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (owner[1:] != owner[:-1])]) if len(path) else np.zeros(0, np.int64)
    starts = starts[total[owner[starts]] > 0]
    ends = np.r_[starts[1:], len(path)] if len(starts) else starts
    ends = np.minimum(ends, offsets[1:][owner[starts]])
    spans = pa.StructArray.from_arrays(
        [pa.array(np.array(model.languages, dtype=object)[path[starts]], pa.string()), pa.array(starts - offsets[owner[starts]]), pa.array(ends - starts)],
        ["lang", "first_word", "words"],
    )
    span_offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[starts], minlength=count))]).astype(np.int32)
    return pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(span_offsets), spans)


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose text has a letter, all columns; no model is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = tk.flat(batch.column(text))
            for a, b in tk.chunks(offsets, 4 << 20):
                part = batch.slice(a, b - a)
                codes, ends = _codes(pc.fill_null(part.column(text), ""))
                letters = np.concatenate([[0], np.cumsum(code_tables()[0][codes])])
                yield part.filter(pa.array(letters[ends[1:]] > letters[ends[:-1]]))

    return docs.mapInArrow(run, docs.schema)


OUTPUT = ("lang_pred", "lang_score", "lang_spans")


def identify(docs: DataFrame, model: Model, text: str = "text", new: tuple[str, str, str] = OUTPUT) -> DataFrame:
    """All columns of the documents with language, score and spans under the names ``new``."""
    from pyspark.sql import types as T

    docs = docs.drop(*new)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in zip(new, ("string", "double", "array<struct<lang:string,first_word:bigint,words:bigint>>")))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            _, offsets = tk.flat(batch.column(text))
            for a, b in tk.chunks(offsets, 4 << 20):
                part = batch.slice(a, b - a)
                if fitted.languages:
                    found = label(part.column(text), fitted)
                else:
                    found = (pa.array(["und"] * (b - a), pa.string()), pa.array([0.0] * (b - a)), pa.nulls(b - a, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*names, *new])

    return docs.mapInArrow(run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.where(~F.coalesce(held_out, F.lit(False))).select("lang", "text"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.size("lang_spans").cast("bigint").alias("n_spans"))


QUERIES = {"op5_language_id": op5_language_id}
SQL: dict[str, str] = {}
