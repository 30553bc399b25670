"""Host-level quality rules.

Every document is measured once (``measure``), in Arrow batches. Each rule is a condition on the measures; its
failures are counted per host. A host's failure rate is shrunk towards the corpus by a beta prior fitted to the
host rates by moments, so that a host with few documents is not condemned by one bad page. Hosts whose shrunk
rate of some rule exceeds its limit are rejected as a whole, and the verdict is joined back to the documents.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL host is a host of its own;
repeated rows count as often as they occur; an empty table gives an empty result; further columns are kept
unless they carry the name of an output column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.shared import fresh, stored, table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
REPEAT_WINDOW = 8
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    count = len(offsets) - 1
    owner = np.repeat(np.arange(count), np.diff(offsets))
    starts, ends, word_offsets = tk.word_spans(data, offsets)
    words = np.diff(word_offsets)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=count)

    chars = per_text(~tk.SEPARATOR[data] & ((data & 0xC0) != 0x80))
    symbols = per_text(SYMBOL[data])

    # Lines with a word, equal to an earlier line of the same text.
    cut = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][words > 0], cut[cut + 1 < len(data)] + 1]))
    line_starts = line_starts[data[line_starts] != 10]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    stops = np.union1d(cut, offsets[1:])
    line_ends = stops[np.searchsorted(stops, line_starts, "right")]
    holds_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_owner = line_starts[holds_word], line_ends[holds_word], line_owner[holds_word]
    dup_lines = np.bincount(line_owner[_repeats(line_owner, tk.span_hashes(data, line_starts, line_ends), later=True)], minlength=count)

    # Words in windows of eight words that occur twice or more in the text.
    hashes = tk.window_hashes(tk.span_hashes(data, starts, ends), REPEAT_WINDOW)
    word_owner = np.repeat(np.arange(count), words)
    first = np.flatnonzero(word_owner[: len(hashes)] == word_owner[REPEAT_WINDOW - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    again = first[_repeats(word_owner[first], hashes[first], later=False)]
    covered = tk.run_mask(len(starts), again, REPEAT_WINDOW)
    repeated = np.bincount(word_owner[covered], minlength=count)
    return [words, chars, symbols, dup_lines, repeated]


def _repeats(owner: np.ndarray, values: np.ndarray, later: bool) -> np.ndarray:
    """True for elements whose (owner, value) occurs more than once; with ``later`` not for the first of them."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    same = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    out = np.zeros(len(order), bool)
    out[order[1:]] = same
    if not later:
        out[order[:-1]] |= same
    return out


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without their text, with the measures of each."""
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in MEASURES]
    names = [f.name for f in kept]
    body = fresh(docs, "body")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{m} bigint" for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.flat(batch.column(body))
            parts = [_measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in tk.chunks(offsets)]
            columns = [np.concatenate(m) if m else np.zeros(0, np.int64) for m in zip(*parts)] or [np.zeros(0, np.int64)] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.array(c, pa.int64()) for c in columns)], [*names, *MEASURES])

    return docs.select(*names, F.col(text).alias(body)).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def default_rules() -> dict[str, tuple[Column, float]]:
    """Rule name to (failure condition, highest shrunk failure rate of an accepted host)."""
    return {
        "base": (base_failed(), 0.6),
        "symbols": (10 * F.col("n_symbols") > F.col("n_words"), 0.6),
        "dup_lines": (F.col("n_dup_lines") > 5, 0.6),
        "word_length": ((F.col("word_chars") > 12 * F.col("n_words")) | (F.col("word_chars") < 2 * F.col("n_words")), 0.6),
    }


def host_verdicts(measured: DataFrame, host: Column, rules: dict[str, tuple[Column, float]] | None = None) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, verdict.

    The prior of a rule is Beta(m * s, (1 - m) * s) with m the mean of the host rates and m (1 - m) / (s + 1) their
    variance. Hosts that do not vary at all give the strongest prior (s = 10^6), a variance beyond any beta the weakest.
    """
    rules = rules or default_rules()
    hosts = measured.groupBy(host.alias("host")).agg(
        F.count(F.lit(1)).alias("docs"), *(F.sum(fails.cast("bigint")).alias(f"{name}_failures") for name, (fails, _) in rules.items())
    )
    moments = hosts.agg(
        *(F.avg(F.col(f"{n}_failures") / F.col("docs")).alias(f"{n}_mean") for n in rules),
        *(F.var_pop(F.col(f"{n}_failures") / F.col("docs")).alias(f"{n}_var") for n in rules),
    )
    out = hosts.crossJoin(F.broadcast(moments))  # an ungrouped aggregate: exactly one row
    for name in rules:
        mean, var = F.col(f"{name}_mean"), F.col(f"{name}_var")
        strength = F.when(var <= mean * (1 - mean) / 1e6, F.lit(1e6)).otherwise(F.greatest(mean * (1 - mean) / var - 1, F.lit(1e-3)))
        out = out.withColumn(f"{name}_rate", (F.col(f"{name}_failures") + mean * strength) / (F.col("docs") + strength))
    accepted = F.lit(True)
    for name, (_, limit) in rules.items():
        accepted = accepted & (F.col(f"{name}_rate") <= limit)
    return out.select("host", "docs", *(f"{n}_rate" for n in rules), accepted.alias("host_ok"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", rules: dict[str, tuple[Column, float]] | None = None) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document; hosts of any size are joined by a splittable merge join.

    The measures are stored, so every text is read once.
    """
    measured = stored(measure(docs.drop("base_failed", "kept", "host_ok"), text), "measures")
    name = fresh(measured, "host")
    hosts = host_verdicts(measured, F.col(host), rules).select(F.col("host").alias(name), "host_ok")
    joined = measured.join(hosts, F.col(host).eqNullSafe(F.col(name)), "left").drop(name)
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", *MEASURES, "base_failed", "kept")


QUERIES = {"op9_quality_rules": op9_quality_rules}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines > 5",
    "word_length": "word_chars > 12 * n_words OR word_chars < 2 * n_words",
}
SQL = {
    "op9_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
lines AS (
    SELECT rid, line, count(*) AS n
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
dup AS (SELECT rid, sum(n - 1)::BIGINT AS n_dup_lines FROM lines GROUP BY rid),
win AS (SELECT rid, i, list_slice(words, i, i + 7) AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
m AS (
    SELECT d.rid, doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN dup USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, unnest([{", ".join(f"{{'rule': '{n}', 'bad': {c}}}" for n, c in _RULES.items())}], recursive := true) FROM b),
h AS (SELECT source, rule, count(*) AS n, count(*) FILTER (bad) AS bad FROM f GROUP BY ALL),
p AS (SELECT rule, avg(bad / n) AS mu, var_pop(bad / n) AS v FROM h GROUP BY rule),
q AS (SELECT *, CASE WHEN v <= mu * (1 - mu) / 1e6 THEN 1e6 ELSE greatest(mu * (1 - mu) / v - 1, 1e-3) END AS s FROM p),
ok AS (SELECT source, bool_and((bad + mu * s) / (n + s) <= 0.6) AS host_ok FROM h JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM b JOIN ok ON b.source IS NOT DISTINCT FROM ok.source
"""
}
