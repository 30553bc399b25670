"""Cross-tokenizer alignment: galloping intersection of the token ends of two tokenizers.

Method. Both tokenizers cut the same bytes, a space and the text. The ascending byte ends of their tokens are two sorted
lists; the shorter one drives: for each of its ends an exponential search, from where the last one was found, and a binary
search inside the last step find its place in the longer list. Long lists are driven in lanes of ``LANE`` ends, all
lanes of a chunk in step. Common ends cut both token lists into groups; differences of their ranks are the ranges of tokens
that overlap.

Tokens. Neither tokenizer lets a token run from a character that is no white space on into a space, so a text may be cut
there: each different word of a task is encoded once, and texts are put together from their words (compared with
encoding whole texts in the tests). Joined token bytes are compared with the text.

Pair counts. Two tokens that end together end in the same bytes, so one's bytes are the end of the other's. The vocabularies
have only so many such pairs (some hundred thousand), whatever the corpus: counts of all pairs travel as one array, numbered by
``Vocabularies.pairs``. A first pass stores the links of every text, Spark sums them by pair, a second pass looks them up.

Defined results: NULL or empty texts, and texts whose joined token bytes differ from the space and the text, have no tokens (empty
lists, zeros); rows are returned as often as they come, also with NULL or repeated ids; strings of special tokens in a
text are plain text; very long words are encoded whole; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from punctualis.llm import textkit as tk
from punctualis.llm.shared import stored, table

FOLDER = "/opt/tokenizers"
FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Fixed value: how byte-level vocabularies split a text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK_BYTES = 2 << 20
_LONG_WORD = 2000
LANE = 64
MEMO_WORDS, MEMO_BYTES = 400_000, 32 << 20
_NONE = np.zeros(0, np.int64)
_DIGITS = np.array([len(str(i)) for i in range(1 << 17)])


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs of tokens that can end together."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry)
        self.fast = self._ranked(path_a, alphabet)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.bytes = (self.bytes_a, self.bytes_b)
        self.lengths = tuple(np.array([len(x) for x in v], np.int64) for v in self.bytes)
        self.pairs = self._pairs()

    def _ranked(self, path_a: str, alphabet: dict[str, int]):
        """The same encoder by ranks, where the file is a plain byte-level BPE whose ids follow its merges; it takes a third of the time."""
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], spec["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        plain = model["type"] == "BPE" and not spec["normalizer"] and not any(model.get(c) for c in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        split = steps and steps["type"] == "ByteLevel" and steps["use_regex"] and not steps["add_prefix_space"]
        if not plain or not split or any(model["vocab"].get(x + y) != 256 + i for i, (x, y) in enumerate(merges)):
            return None
        ranks = {bytes(alphabet[c] for c in entry): i for entry, i in model["vocab"].items()}
        return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def _pairs(self) -> np.ndarray:
        """Sorted codes a * (number of B tokens) + b."""
        by_bytes = [{}, {}]
        for own, tokens in zip(by_bytes, (self.bytes_a, self.bytes_b)):
            for i, x in enumerate(tokens):
                own.setdefault(x, []).append(i)
        codes = set()
        for a, x in enumerate(self.bytes_a):
            codes.update(a * len(self.bytes_b) + b for i in range(len(x)) for b in by_bytes[1].get(x[i:], ()))
        for b, x in enumerate(self.bytes_b):
            codes.update(a * len(self.bytes_b) + b for i in range(1, len(x)) for a in by_bytes[0].get(x[i:], ()))
        return np.array(sorted(codes), np.int64)

    def encode_a(self, words: list[bytes]) -> list[int]:
        """Ids of words one after the other, none of which runs into the next."""
        text = b"".join(words).decode("utf-8", "replace")
        if self.fast and max(map(len, words)) <= _LONG_WORD:
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode_words(self, which: int, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, number of ids of each, whether the ids' bytes are the word."""
        whole, ends = b"".join(words), np.cumsum([len(w) for w in words])
        own, lengths = self.bytes[which], self.lengths[which]
        if which:  # B adds the space that the words start with
            parts = self.b.encode([w[1:].decode("utf-8", "replace") for w in words], num_threads=1)
            ids = np.fromiter(chain.from_iterable(parts), np.int64)
            last = np.cumsum([len(p) for p in parts]) - 1
        else:
            ids = np.array(self.encode_a(words), np.int64)
            last = np.searchsorted(np.cumsum(lengths[ids]), ends)
        token_ends = np.cumsum(lengths[ids])
        counts = np.diff(last, prepend=-1)
        if len(ids) and last[-1] == len(ids) - 1 and (counts > 0).all() and (token_ends[last] == ends).all() and b"".join([own[i] for i in ids.tolist()]) == whole:
            return ids, counts, np.ones(len(words), bool)
        if len(words) == 1:
            return ids, np.array([len(ids)]), np.zeros(1, bool)
        return tuple(np.concatenate(x) for x in zip(*(self.encode_words(which, [w]) for w in words)))

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair in ``pairs``."""
        return np.searchsorted(self.pairs, a.astype(np.int64) * len(self.bytes_b) + b)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def safe_ends(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Whether a space behind these two bytes starts a word: printable ASCII or a two-byte letter past U+00BF, no white space."""
    return (last > 0x20) & (last < 0x7F) | (last >= 0x80) & (before >= 0xC3) & (before <= 0xDF)


def ends_word(word: bytes) -> bool:
    return bool(0x20 < word[-1] < 0x7F or word[-1] >= 0x80 and len(word) > 1 and 0xC3 <= word[-2] <= 0xDF)


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the texts (none is empty) and of their words; a space that ends its text is no word."""
    cut = np.zeros(len(data), bool)
    cut[2:] = (data[2:] == 0x20) & safe_ends(data[1:-1], data[:-2])
    cut[offsets[1:] - 1] = False
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


class Memo:
    """Tokens of the different words that a task has met."""

    def __init__(self, v: Vocabularies):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.exact = np.zeros(0, bool)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > MEMO_WORDS or self.held > MEMO_BYTES:
            self.clear()
        new = [w for w in words if w not in self.known]
        if new:
            ended = [ends_word(w) for w in new]  # the others may run into a following space and are encoded one by one
            joined = sum(ended)
            new = [*compress(new, ended), *(w for w, e in zip(new, ended) if not e)]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.held += sum(map(len, new))
            exact = np.ones(len(new), bool)
            for i in range(2):
                parts = [self.v.encode_words(i, w) for w in (new[:joined], *([x] for x in new[joined:])) if w]
                ids, counts, same = (np.concatenate(x) for x in zip(*parts))
                self.ids[i] = np.concatenate([self.ids[i], ids.astype(np.int32)])
                self.ends[i] = np.concatenate([self.ends[i], self.ends[i][-1] + np.cumsum(counts)])
                exact &= same
            self.exact = np.concatenate([self.exact, exact])
        return np.array([self.known[w] for w in words], np.int64)

    def tokens(self, which: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and the number of ids of each word."""
        first = self.ends[which][numbers]
        lengths = self.ends[which][numbers + 1] - first
        owner, place = tk.ragged(lengths)
        return self.ids[which][first[owner] + place], lengths


def gallop(short: np.ndarray, borders: tuple[np.ndarray, np.ndarray], long: np.ndarray, long_borders: tuple[np.ndarray, np.ndarray], lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in ascending lists: list i is short[borders[0][i] : borders[1][i]], and likewise in ``long``."""
    first, last = borders
    owner, number = tk.ragged(-(-(last - first) // lane))
    at, low, end = first[owner] + number * lane, long_borders[0][owner], long_borders[1][owner]
    stop = np.minimum(at + lane, last[owner])
    found = []
    while len(at):
        value = short[at]
        low = seek(long, low, end, value)
        hit = np.flatnonzero(low < end)
        hit = hit[long[low[hit]] == value[hit]]
        found.append((at[hit], low[hit]))
        at = at + 1
        going = np.flatnonzero((at < stop) & (low < end))
        at, low, end, stop = at[going], low[going], end[going], stop[going]
    if not found:
        return _NONE, _NONE
    i, j = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(i)
    return i[order], j[order]


def seek(long: np.ndarray, low: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """First place from ``low`` on with at least the value: steps that double, then halving inside the last step."""
    low, high = low.copy(), np.minimum(low, end)
    active, step = np.flatnonzero(low < end), 1
    while len(active):
        active = active[long[high[active]] < value[active]]
        low[active] = high[active] + 1
        high[active] = high[active] + step
        over = high[active] >= end[active]
        high[active[over]] = end[active[over]]
        active, step = active[~over], step * 2
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        less = long[middle] < value[active]
        low[active[less]] = middle[less] + 1
        high[active[~less]] = middle[~less]
        active = active[low[active] < high[active]]
    return low


class Alignment:
    """Tokens, groups and links of a chunk of texts: token lists with borders per text, and the last tokens of every group."""

    def __init__(self, a, b, a_borders, b_borders, cut_a, cut_b):
        self.a, self.b, self.a_borders, self.b_borders, self.cut_a, self.cut_b = a, b, a_borders, b_borders, cut_a, cut_b
        #: Borders of the groups of each text.
        self.groups = np.searchsorted(cut_a, a_borders)


def align_chunk(data: np.ndarray, offsets: np.ndarray, memo: Memo) -> Alignment:
    """``data`` holds a space and the text for every text that is not empty, nothing for the others."""
    v, count = memo.v, len(offsets) - 1
    cuts = word_cuts(data, offsets[np.r_[True, offsets[1:] != offsets[:-1]]]) if len(data) else _NONE
    text_of = np.repeat(np.arange(count), np.diff(np.searchsorted(cuts, offsets)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    numbers = memo.numbers(words.dictionary.to_pylist())[words.indices.to_numpy()] if len(cuts) else _NONE
    wrong = np.unique(text_of[~memo.exact[numbers]])
    for i in wrong.tolist():  # words differ: the text is out unless all its bytes agree after all
        own = numbers[text_of == i]
        whole = data[offsets[i] : offsets[i + 1]].tobytes()
        if all(b"".join([names[x] for x in memo.tokens(which, own)[0]]) == whole for which, names in enumerate(v.bytes)):
            wrong = wrong[wrong != i]
    if len(wrong):
        keep = ~np.isin(text_of, wrong)
        numbers, text_of = numbers[keep], text_of[keep]
    sides = []
    for which, lengths in enumerate(v.lengths):
        ids, per_word = memo.tokens(which, numbers)
        borders = np.concatenate([[0], np.cumsum(np.bincount(text_of, per_word, count).astype(np.int64))])
        sides.append((ids, borders, np.cumsum(lengths[ids])))
    (a, a_borders, a_ends), (b, b_borders, b_ends) = sides
    # The shorter list of each text drives.
    few = np.diff(a_borders) <= np.diff(b_borders)
    x, y = gallop(a_ends, (a_borders[:-1][few], a_borders[1:][few]), b_ends, (b_borders[:-1][few], b_borders[1:][few]))
    z, w = gallop(b_ends, (b_borders[:-1][~few], b_borders[1:][~few]), a_ends, (a_borders[:-1][~few], a_borders[1:][~few]))
    return Alignment(a, b, a_borders, b_borders, np.sort(np.concatenate([x, w])), np.sort(np.concatenate([y, z])))


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a space and the text for all texts that are not empty; offsets."""
    data, offsets = tk.flat(column)
    lengths = np.diff(offsets)
    full = lengths > 0
    out_offsets = np.concatenate([[0], np.cumsum(lengths + full)])
    out = np.full(out_offsets[-1], 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[out_offsets[:-1][full]] = False
    out[keep] = data
    return out, out_offsets


def groups_text(g: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every text as bytes, and the offsets of the texts."""
    na, nb = len(g.a), len(g.b)
    last_a, last_b = np.zeros(na, bool), np.zeros(nb, bool)
    last_a[g.cut_a] = last_b[g.cut_b] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # Ranks: before a token of A stand the B tokens of earlier groups, before one of B the A tokens of its own group too.
    place_a = np.arange(na) + np.concatenate([[0], g.cut_b + 1])[group_a]
    place_b = np.arange(nb) + (g.cut_a + 1)[group_b] if nb else _NONE
    ids, mark = np.zeros(na + nb, np.int64), np.zeros(na + nb, np.uint8)
    ids[place_a], ids[place_b] = g.a, g.b
    mark[place_a] = np.where(last_a, ord("|"), ord(","))
    mark[place_b] = np.where(last_b, ord(";"), ord(","))
    borders = g.a_borders + g.b_borders
    mark[borders[1:][np.diff(borders) > 0] - 1] = 0
    digits = _DIGITS[ids]
    ends = np.cumsum(digits + (mark > 0))
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    marked = np.flatnonzero(mark)
    out[ends[marked] - 1] = mark[marked]
    at, rest = ends - (mark > 0) - 1, ids
    for k in range(6):
        own = np.flatnonzero(digits > k)
        out[at[own] - k] = 48 + rest[own] % 10
        rest = rest // 10
    return out, np.concatenate([[0], ends])[borders]


def int_lists(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values.astype(np.int32)))


LISTS_SCHEMA = "a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"


def as_lists(g: Alignment, v: Vocabularies) -> list[pa.Array]:
    """Token ids, and for every group the number of tokens up to its end: group i has the tokens from cut i - 1 to cut i."""
    text = np.repeat(np.arange(len(g.groups) - 1), np.diff(g.groups))
    cuts = [c + 1 - borders[text] for c, borders in ((g.cut_a, g.a_borders), (g.cut_b, g.b_borders))]
    return [int_lists(g.a, g.a_borders), int_lists(g.b, g.b_borders), *(int_lists(c, g.groups) for c in cuts)]


LINKS_SCHEMA = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


def as_links(g: Alignment, v: Vocabularies) -> list[pa.Array]:
    """Counts, digest of the groups, and the numbers of the linked pairs (int32, sorted within a text)."""
    out, offsets = groups_text(g)
    whole = out.tobytes()
    digests = [hashlib.sha256(whole[x:y]).hexdigest() if y > x else "" for x, y in zip(offsets.tolist(), offsets[1:].tolist())]
    text = np.repeat(np.arange(len(g.groups) - 1), np.diff(g.groups))
    links = np.sort(text << 32 | v.number(g.a[g.cut_a], g.b[g.cut_b])) & 0xFFFFFFFF
    raw = links.astype(np.int32).tobytes()
    borders = (g.groups * 4).tolist()
    return [*(pa.array(np.diff(x)) for x in (g.a_borders, g.b_borders, g.groups)), pa.array(digests, pa.string()), pa.array([raw[x:y] for x, y in zip(borders, borders[1:])], pa.binary())]


def align(docs: DataFrame, folder: str = FOLDER, files: tuple[str, str] = FILES, derive: Callable[[Alignment, Vocabularies], list[pa.Array]] = as_lists, schema: str = LISTS_SCHEMA) -> DataFrame:
    """doc_id and what ``derive`` takes from the alignment of each text: token ids and group borders unless named."""
    paths = [f"{folder}/{f}" for f in files]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*paths)
        memo = Memo(v)
        for batch in batches:
            data, offsets = spaced(batch.column("text"))
            for a, b in tk.chunks(offsets, CHUNK_BYTES):
                g = align_chunk(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], memo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *derive(g, v)], ["doc_id", *names])

    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id bigint, {schema}")


def pair_counts(linked: DataFrame, size: int) -> np.ndarray:
    """Links of every pair over the corpus: an array of ``size`` counts, summed by Spark from each task's own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(tk.flat(batch.column("links"))[0].view(np.int32), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["pair", "n"])

    sums = linked.select("links").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[sums["pair"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def rate_links(docs: DataFrame, folder: str = FOLDER, files: tuple[str, str] = FILES) -> DataFrame:
    """Per text: tokens, groups, links, how many of them are the most frequent link of their B token, sum of the links' counts."""
    linked = stored(align(docs, folder, files, as_links, LINKS_SCHEMA), "links")
    v = vocabularies(*(f"{folder}/{f}" for f in files))
    counts = pair_counts(linked, len(v.pairs))
    b = v.pairs % len(v.bytes_b)
    highest = np.zeros(len(v.bytes_b), np.int64)
    np.maximum.at(highest, b, counts)
    rated = docs.sparkSession.sparkContext.broadcast((counts, (counts == highest[b]) & (counts > 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = rated.value
        for batch in batches:
            data, offsets = tk.flat(batch.column("links"))
            links, borders = data.view(np.int32), offsets >> 2
            sums = [np.concatenate([[0], np.cumsum(x[links].astype(np.int64))])[borders] for x in (best, counts)]
            names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.diff(borders)), *(pa.array(np.diff(s)) for s in sums)], [*names, "n_links", "n_best", "count_sum"])

    return linked.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_links(table(spark, sf_dir, "documents"))


QUERIES = {"op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment}
SQL: dict[str, str] = {}  # tokenizers can't be expressed in SQL; tests/llm has a brute-force version
