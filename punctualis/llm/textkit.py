"""Vectorised text helpers that run inside Arrow batches: words, hashes, minimizers.

Words are ``[^\\x20\\x09-\\x0D]+``: maximal runs of bytes other than ASCII white space. All hashes are 64-bit
and depend on content only, so every task and every run computes the same values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand and kept per worker."""
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        for name, base in (("_powers", _ODD), ("_inverse_powers", inverse)):
            steps = np.full(size, base)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverse_powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and the offsets between them; NULL is empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Runs of whole texts of about ``limit`` bytes each; a longer text is a run of its own."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, count)
        first = min(last, count)


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of all words, and the word offsets between the texts."""
    n = len(data)
    blank = separator[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = True
    after[edges[edges > 0] - 1] = True
    word = ~blank
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte span, by differences of one running polynomial sum."""
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (across text borders, which the caller leaves out)."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    power, inverse = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    return mix((total[k:] - total[:-k]) * inverse[: len(values) - k + 1])


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and position within the owner of every element of lists with the given lengths."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return owner, np.arange(len(owner)) - first[owner]


def run_mask(size: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """True where at least one of the runs [start, start + length) lies."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, two running minima per block of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])
