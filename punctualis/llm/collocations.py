"""Phrase collocations mined with stripes: each prefix keys a counter of the words that follow it.

Method. A text is cut into pieces at sentence marks and line ends, and pieces into words. A stripe is a prefix of one
to three words with an associative counter of next words. Tasks count stripes locally, merge them elementwise in
sorted arrays and send each shard its part; a stripe is split by its next words, so that the stripe of a very common word
is not one task's. What the merged stripes hold gives everything else: an entry is the frequency of the extended
phrase, a word's own counter is its prefix total, and the greatest entries of a prefix (or of a suffix) decide
which phrases are subsumed. Two passes read the texts: stripes of single words first; then stripes of two and more words
along places where every pair of words is frequent, as no other phrase can be. The second pass knows frequent
pairs by a bitmap of ``FILTER_BITS`` bits: a fixed size at any corpus, and pairs that pass it by chance are counted and
then found to be rare.

Keys are exact. A word is a 64-bit hash of language and text, longer words by a digest; a phrase is the list of its words'
hashes. Texts of words with equal hashes are compared, and a collision repeats the count with another hash.
Counters are 64 bits, products decimals of 38 digits.

Defined results: a NULL language is ``und``; NULL, empty and blank texts hold no word; repeated rows count again; ties of
rank are broken by phrase; a phrase never crosses a sentence mark, a line end or a text; very long words are words; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctualis.llm import textkit as tk
from punctualis.llm.shared import stored, table

STOP = np.zeros(256, bool)
STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAK = STOP.copy()
BREAK[[0x20, 0x09]] = True
SHARD_BYTES = 16 << 20
FLUSH_WORDS = 1_000_000
FILTER_BITS = 26
_CHUNK_BITS = 16
_LONG_WORD = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)

PART_SCHEMA = "shard bigint, bad boolean, phrases binary, counts binary, words binary, word_counts binary, word_langs binary, langs array<string>, texts binary, lengths binary"
_BLOBS = ("phrases", "counts", "words", "word_counts", "word_langs", "texts", "lengths")
PART_ARROW = pa.schema([("shard", pa.int64()), ("bad", pa.bool_()), *((c, pa.binary()) for c in _BLOBS[:5]), ("langs", pa.list_(pa.string())), *((c, pa.binary()) for c in _BLOBS[5:])])
FOUND_SCHEMA = "kind int, lang string, text string, words array<bigint>, f bigint"
FOUND_ARROW = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("text", pa.string()), ("words", pa.list_(pa.int64())), ("f", pa.int64())])
COLLISION, TOTAL, WORD, PHRASE = -1, 0, 1, 2


@lru_cache(maxsize=4)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every word; a polynomial for usual words, a digest for very long ones."""
    power, inverse = tk.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values(seed)[data] * power[:-1], out=total[1:])
    hashes = tk.mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        hashes[i] = np.frombuffer(digest, np.uint64)[0]
    return hashes


def code_of(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit mix of the words of each phrase."""
    code = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        code = tk.mix(code * _ODD + c.view(np.uint64))
    return code


def merge(columns: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Elementwise sum of counters: code, words and count of every different phrase, ordered by code."""
    code = code_of(columns)
    order = np.argsort(code)

    def changes() -> np.ndarray:
        out = np.ones(len(order), bool)
        out[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
        return out

    new = changes() if len(order) else np.zeros(0, bool)
    if (new[1:] & (code[order][1:] == code[order][:-1])).any():  # different phrases of one code: order them exactly
        order = np.lexsort([*columns, code])
        new = changes()
    first = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return code[order][first], [c[order][first] for c in columns], sums


def read_words(batch: pa.RecordBatch, seed: int) -> Iterator[tuple]:
    """Per chunk of a batch: the lower-cased bytes, start, end and row of every word, and whether the next word continues its piece."""
    data, offsets = tk.flat(batch.column("text"))
    for a, b in tk.chunks(offsets):
        chunk, borders = tk.LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        starts, ends, words = tk.word_spans(chunk, borders, BREAK)
        if len(starts):
            row = np.repeat(np.arange(a, b), np.diff(words))
            marks = np.concatenate([[0], np.cumsum(STOP[chunk])])[starts]
            joined = np.zeros(len(row), bool)
            joined[:-1] = (row[1:] == row[:-1]) & (marks[1:] == marks[:-1])
            yield chunk, starts, ends, row, joined


def salts(langs: list[str], seed: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little") for x in langs], np.uint64)


def word_keys(chunk, starts, ends, salt: np.ndarray, seed: int) -> np.ndarray:
    """Never zero, which fills up the keys of shorter phrases."""
    return (tk.mix(word_hashes(chunk, starts, ends, seed) + salt) | np.uint64(1)).view(np.int64)


def shards_of(code: np.ndarray, shards: int) -> np.ndarray:
    return ((code >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Stripes:
    """What a task has counted since it last sent parts to the shards."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.held, self.phrases, self.words, self.langs, self.bad = 0, [], [], {}, False

    def add(self, phrases: list[np.ndarray]) -> None:
        self.held += len(phrases[0])
        self.phrases.append(phrases)

    def add_words(self, keys, second, chunk, starts, ends, langs: list[str], lang: np.ndarray) -> None:
        """Counts of the words themselves, with their texts; ``second`` tells words apart that share a key."""
        unique, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        self.bad |= bool((second != second[first][inverse]).any())
        owner, place = tk.ragged((ends - starts)[first])
        number = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int32)[lang[first]]
        self.words.append((unique, second[first], counts, number, (ends - starts)[first], chunk[starts[first][owner] + place]))

    def parts(self, width: int) -> Iterator[dict]:
        """One row per shard: phrases with counts, words with counts and texts, all sorted; then everything is forgotten."""
        columns = [np.concatenate([p[i] for p in self.phrases]) if self.phrases else np.zeros(0, np.int64) for i in range(width)]
        self.phrases = []
        code, columns, counts = merge(columns, np.ones(len(columns[0]), np.int64))
        keys, second, word_counts, number, lengths, text = [np.concatenate(c) for c in zip(*self.words)] if self.words else [np.zeros(0, np.int64)] * 6
        ends = np.cumsum(lengths)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.bad |= bool((second != second[first][inverse]).any())
        sums = np.bincount(inverse, word_counts, len(unique)).astype(np.int64)
        home = shards_of(code_of([unique]), self.shards)
        by_shard = np.argsort(home, kind="stable")
        borders, home_borders = (np.searchsorted(s, np.arange(self.shards + 1)) for s in (shards_of(code, self.shards), home[by_shard]))
        for shard in range(self.shards):
            a, b = borders[shard : shard + 2]
            mine = by_shard[home_borders[shard] : home_borders[shard + 1]]
            if a == b and not len(mine):
                continue
            at = first[mine]
            owner, place = tk.ragged(lengths[at])
            yield {
                "shard": shard, "bad": self.bad, "phrases": np.stack([c[a:b] for c in columns]).tobytes(), "counts": counts[a:b].tobytes(), "words": unique[mine].tobytes(), "word_counts": sums[mine].tobytes(),
                "word_langs": number[at].astype(np.int32).tobytes(), "langs": list(self.langs), "texts": text[(ends - lengths)[at][owner] + place].astype(np.uint8).tobytes(), "lengths": lengths[at].astype(np.int64).tobytes(),
            }
        self.clear()


def count_pairs(batches: Iterator[pa.RecordBatch], shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    """First pass: words, and the stripes of single words."""
    stripes = Stripes(shards)
    for batch in batches:
        langs, lang_of = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True) if batch.num_rows else ([], np.zeros(0, np.int64))
        langs = [str(x) for x in langs]
        one, two = salts(langs, seed), salts(langs, seed + 1)
        for chunk, starts, ends, row, joined in read_words(batch, seed):
            lang = lang_of[row]
            keys = word_keys(chunk, starts, ends, one[lang], seed)
            stripes.add_words(keys, word_keys(chunk, starts, ends, two[lang], seed + 1), chunk, starts, ends, langs, lang)
            at = np.flatnonzero(joined)
            stripes.add([keys[at], keys[at + 1]])
            if stripes.held > FLUSH_WORDS:
                yield from part_batches(stripes.parts(2))
    yield from part_batches(stripes.parts(2))


def count_longer(batches: Iterator[pa.RecordBatch], shards: int, seed: int, longest: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Second pass: stripes of two words and more, along pairs that may be frequent."""
    stripes = Stripes(shards)
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        salt = salts(langs, seed) if langs else np.zeros(0, np.uint64)
        for chunk, starts, ends, row, joined in read_words(batch, seed):
            keys = word_keys(chunk, starts, ends, salt[row], seed)
            at = np.flatnonzero(joined)
            slot = slots([keys[at], keys[at + 1]])
            ahead = np.zeros(len(keys) + longest, bool)
            ahead[at[(frequent[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]] = True
            run = ahead[: len(keys)]
            for length in range(3, longest + 1):
                run = run & ahead[length - 2 : len(keys) + length - 2]
                at = np.flatnonzero(run)
                stripes.add([keys[at + i] if i < length else np.zeros(len(at), np.int64) for i in range(longest)])
            if stripes.held > FLUSH_WORDS:
                yield from part_batches(stripes.parts(longest))
    yield from part_batches(stripes.parts(longest))


def part_batches(parts: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        yield pa.RecordBatch.from_pylist([part], PART_ARROW)


def merge_shard(parts: pa.Table, width: int, least: int) -> pa.Table:
    """The shard's stripes merged elementwise: entries and words that reach ``least``, words per language, collisions."""
    rows = parts.to_pylist()
    phrases = [np.frombuffer(r["phrases"], np.int64).reshape(width, -1) for r in rows]
    columns = [np.concatenate([p[i] for p in phrases]) for i in range(width)]
    _, columns, counts = merge(columns, np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows]))
    keep = counts >= least
    found = np.stack([c[keep] for c in columns], axis=1)
    out = [(PHRASE, None, None, [k for k in words if k], n) for words, n in zip(found.tolist(), counts[keep].tolist())]
    if any(r["bad"] for r in rows):
        out.append((COLLISION, None, None, None, 1))
    keys, sums, lengths = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("words", "word_counts", "lengths"))
    if len(keys):
        text = b"".join(r["texts"] for r in rows)
        ends = np.cumsum(lengths)
        names = sorted({x for r in rows for x in r["langs"]})
        number = {x: i for i, x in enumerate(names)}
        lang = np.concatenate([np.array([number[x] for x in r["langs"]], np.int64)[np.frombuffer(r["word_langs"], np.int32)] for r in rows])
        out += [(TOTAL, names[i], None, None, int(n)) for i, n in enumerate(np.bincount(lang, sums, len(names))) if n]
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        word = lambda i: (lang[i], text[ends[i] - lengths[i] : ends[i]])
        if any(word(order[i]) != word(order[i - 1]) for i in np.flatnonzero(keys[order][1:] == keys[order][:-1]) + 1):
            out.append((COLLISION, None, None, None, 1))
        totals = np.add.reduceat(sums[order], first)
        for i in np.flatnonzero(totals >= least):
            at = order[first[i]]
            out.append((WORD, names[lang[at]], word(at)[1].decode(), [int(keys[at])], int(totals[i])))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), FOUND_ARROW.types)], schema=FOUND_ARROW) if out else FOUND_ARROW.empty_table()


def slots(columns: list[np.ndarray]) -> np.ndarray:
    return (code_of(columns) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def pair_filter(found: DataFrame) -> np.ndarray:
    """Bitmap of the frequent pairs: built in parts by Spark, 2^FILTER_BITS bits in all."""
    size = 1 << _CHUNK_BITS - 3

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            words = batch.column("words").flatten().to_numpy().reshape(-1, 2)
            slot = slots([np.ascontiguousarray(words[:, 0]), np.ascontiguousarray(words[:, 1])])
            np.bitwise_or.at(bits, slot >> 3, (1 << (slot & 7)).astype(np.uint8))
        parts = bits.reshape(-1, size)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["part", "bits"])

    def join(rows: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows.column("bits").to_pylist()])
        return pa.table({"part": rows.column("part")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    schema = "part bigint, bits binary"
    out = np.zeros((1 << FILTER_BITS - _CHUNK_BITS, size), np.uint8)
    for r in found.where(F.col("kind") == PHRASE).select("words").mapInArrow(mark, schema).groupBy("part").applyInArrow(join, schema).collect():
        out[r.part] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> DataFrame:
    """kind, lang, text, words (hashes), f: words per language, frequent words with their text, frequent phrases of 2 to ``longest`` words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    shards = max(1, -(-(texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0) // SHARD_BYTES))

    def merged(counted: DataFrame, width: int) -> DataFrame:
        return counted.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda rows: merge_shard(rows, width, least), FOUND_SCHEMA)

    for seed in count(1, 2):
        found = stored(merged(texts.mapInArrow(lambda batches: count_pairs(batches, shards, seed), PART_SCHEMA), 2), "pairs")
        if found.where(F.col("kind") == COLLISION).isEmpty():
            break
    if longest < 3:
        return found
    bits = docs.sparkSession.sparkContext.broadcast(pair_filter(found))
    longer = texts.mapInArrow(lambda batches: count_longer(batches, shards, seed, longest, bits.value), PART_SCHEMA)
    return found.unionByName(stored(merged(longer, longest), "phrases"))


def exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, percent: int = 80, scale: int = 2_000_000) -> DataFrame:
    """lang, phrase, words (number), a, k, l, r, n, score of every phrase that is not subsumed.

    a: its frequency; l, r: those of its parts when cut after k words, where ``scale * a / (l + r)`` is least; n: words of
    the language. A phrase is subsumed by a longer one with at least ``percent`` of its frequency. Only the next longer ones
    are looked at: what a much longer phrase subsumes, the phrases in between subsume as well.
    """
    found = frequent_phrases(docs, least, longest)
    parts = found.where(F.col("kind").isin(WORD, PHRASE)).select("words", "f")
    phrases = found.where(F.col("kind") == PHRASE).select("words", F.col("f").alias("a"))
    size = F.size("words")
    # The greatest entry of a stripe, and of the phrases that end alike.
    longer = phrases.where(size > 2)
    longer = longer.select(F.slice("words", 1, size - 1).alias("words"), "a").unionByName(longer.select(F.slice("words", 2, size - 1).alias("words"), "a"))
    most = longer.groupBy("words").agg(F.max("a").alias("most"))
    kept = phrases.join(most, "words", "left").where(F.coalesce(F.lit(100) * exact("most") < F.lit(percent) * exact("a"), F.lit(True))).drop("most")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn("tail", F.slice("words", F.col("k") + 1, size - F.col("k")))
    cuts = cuts.join(parts.select(F.col("words").alias("head"), F.col("f").alias("l")), "head").join(parts.select(F.col("words").alias("tail"), F.col("f").alias("r")), "tail")
    cuts = cuts.withColumn("score", F.expr(f"CAST({int(scale)} AS DECIMAL(17,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    best = cuts.groupBy("words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    texts = found.where(F.col("kind") == WORD).select(F.element_at("words", 1).alias("word"), "lang", "text")
    spelt = best.select("words", "a", "cut", F.posexplode("words").alias("place", "word")).join(texts, "word")
    spelt = spelt.groupBy("words").agg(F.first("a").alias("a"), F.first("cut").alias("cut"), F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "text"))).alias("spelt"))
    totals = found.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("f").alias("n"))
    return spelt.join(totals, "lang").select("lang", F.array_join("spelt.text", " ").alias("phrase"), size.alias("words"), "a", "cut.k", "cut.l", "cut.r", "n", "cut.score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 2000)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
SQL = {
    "op13_phrase_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
x AS (SELECT lang, p, unnest(w) AS x, unnest(range(len(w))) AS i FROM w),
y AS (SELECT lang, x, lead(x, 1) OVER o AS x2, lead(x, 2) OVER o AS x3, lead(x, 3) OVER o AS x4 FROM x WINDOW o AS (PARTITION BY p ORDER BY i)),
g AS (SELECT lang, 1 AS m, x AS phrase FROM y UNION ALL SELECT lang, 2, x || ' ' || x2 FROM y UNION ALL SELECT lang, 3, x || ' ' || x2 || ' ' || x3 FROM y UNION ALL SELECT lang, 4, x || ' ' || x2 || ' ' || x3 || ' ' || x4 FROM y),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g WHERE phrase IS NOT NULL GROUP BY lang, m, phrase HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
inside AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(f) AS longer FROM f, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS k) WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
c AS (SELECT f.* FROM f LEFT JOIN inside USING (lang, phrase) WHERE m >= 2 AND coalesce(100 * longer::HUGEINT < 80 * f.f::HUGEINT, true)),
h AS MATERIALIZED (SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
cuts AS (SELECT h.lang, h.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score FROM h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best JOIN n USING (lang) QUALIFY rank <= 2000
"""
}
