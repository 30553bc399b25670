"""Column-wise reading of the protobuf wire format.

All messages of one level are walked in step: each step reads the next field of every message with array operations,
so there is no message object and no Python value per row. Where few long messages are left, their fields are stepped
over one by one; the results are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VARINT, FIXED64, BYTES, GROUP, GROUP_END, FIXED32 = range(6)
PADDING = 24  # zero bytes behind the data, so that a cut field can be read before it is rejected
FEW = 24


@dataclass
class Fields:
    """Fields in any order: message they belong to, tag (number and wire type), span of the value, its integer if a varint."""

    message: np.ndarray
    tag: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    value: np.ndarray

    def which(self, number: int, wire: int) -> np.ndarray:
        """Places of the fields of one number and wire type in the order of the bytes; one with another type is unknown."""
        found = np.flatnonzero(self.tag == (number << 3 | wire))
        return found[np.argsort(self.start[found], kind="stable")]


def varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers (modulo 2^64) at the positions and the positions behind them; -1 where one has more than ten bytes."""
    byte = data[at]
    value = (byte & 0x7F).astype(np.uint64)
    end = at + 1
    more = np.flatnonzero(byte >= 0x80)
    for shift in range(7, 70, 7):
        if not len(more):
            return value, end
        byte = data[np.minimum(end[more], len(data) - 1)]
        value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        end[more] += 1
        more = more[byte >= 0x80]
    end[more] = -1
    return value, end


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = 0
    for shift in range(0, 70, 7):
        byte = data[at] if at < len(data) else 0
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value & 0xFFFFFFFFFFFFFFFF, at
    return 0, -1


def _single(data: bytes, message: int, at: int, end: int, depth: int, rows: list[tuple]) -> bool:
    """Steps over the fields of one message; False where it can't be read."""
    while at < end:
        tag, at = _varint(data, at)
        wire, value, start = tag & 7, 0, at
        if at < 0 or at > end or not 8 <= tag < 1 << 32 or wire > FIXED32:
            return False
        if wire == VARINT:
            value, at = _varint(data, at)
        elif wire == BYTES:
            length, start = _varint(data, at)
            at = start + length if start >= 0 else -1
        elif wire in (FIXED64, FIXED32):
            at += 8 if wire == FIXED64 else 4
        if at < 0 or at > end:
            return False
        depth += (wire == GROUP) - (wire == GROUP_END)
        if depth < 0:
            return False
        if depth == 0 and wire != GROUP_END:
            rows.append((message, tag, start, at, value))
    return depth == 0


def fields(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, few: int = FEW) -> tuple[Fields, np.ndarray]:
    """All fields of the messages in the spans, and which messages can't be read.

    ``data`` ends with PADDING zero bytes. Groups, an old way to nest, are stepped over.
    """
    bad = np.zeros(len(starts), bool)
    parts: list[tuple] = []
    live = np.flatnonzero(starts < ends)
    at, end, depth = starts[live].astype(np.int64), ends[live].astype(np.int64), np.zeros(len(live), np.int64)
    while len(live) > few:
        tag, value_at = varints(data, at)
        wire = (tag & np.uint64(7)).astype(np.int8)
        wrong = (value_at < 0) | (value_at > end) | (tag < 8) | (tag >= 1 << 32) | (wire > FIXED32)
        tag = tag.view(np.int64)
        wire[wrong] = -1
        start, stop, value = value_at, value_at.copy(), np.zeros(len(live), np.uint64)
        which = np.flatnonzero(wire == VARINT)
        value[which], stop[which] = varints(data, value_at[which])
        which = np.flatnonzero(wire == BYTES)
        length, start[which] = varints(data, value_at[which])
        fits = (start[which] >= 0) & (length <= np.uint64(len(data)))
        stop[which] = np.where(fits, start[which] + np.where(fits, length, 0).astype(np.int64), -1)
        stop[wire == FIXED64] += 8
        stop[wire == FIXED32] += 4
        depth += wire == GROUP
        depth -= wire == GROUP_END
        wrong |= (stop < 0) | (stop > end) | (depth < 0) | ((stop == end) & (depth != 0))
        left_out = wrong | (depth != 0) | (wire == GROUP_END)
        found = (live, tag, start, stop, value)
        if left_out.any():
            bad[live[wrong]] = True
            found = tuple(column[~left_out] for column in found)
        parts.append(found)
        go_on = np.flatnonzero(~wrong & (stop < end))
        live, at, end, depth = live[go_on], stop[go_on], end[go_on], depth[go_on]
    if len(live):
        text, rows = data.tobytes(), []
        for message, a, b, d in zip(live.tolist(), at.tolist(), end.tolist(), depth.tolist()):
            bad[message] |= not _single(text, message, a, b, d, rows)
        if rows:
            columns = list(zip(*rows))
            parts.append(tuple(np.array(c, np.int64) for c in columns[:4]) + (np.array(columns[4], np.uint64),))
    if not parts:
        none = np.zeros(0, np.int64)
        return Fields(none, none, none, none, np.zeros(0, np.uint64)), bad
    return Fields(*(np.concatenate(columns) for columns in zip(*parts))), bad


def texts(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The byte spans as a column, NULL where not valid."""
    lengths = np.where(valid, stops - starts, 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    total = int(offsets[-1])
    source = np.repeat(np.where(valid, starts, 0) - offsets[:-1], lengths) + np.arange(total)
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[source])])
    return pc.if_else(pa.array(valid), flat.cast(pa.binary()), None)


def numbers(data: np.ndarray, starts: np.ndarray, values: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray | bool]:
    """Values of fields of one declared kind and which of them the column type can hold."""
    if kind in ("float", "double"):
        width = 4 if kind == "float" else 8
        raw = data[starts[:, None] + np.arange(width)]
        return raw.view("<f4" if kind == "float" else "<f8").ravel().astype(np.float64), True
    if kind in ("int32", "uint32"):
        low = values.astype(np.uint32)
        return low.view(np.int32), True if kind == "int32" else low < 1 << 31
    return values.view(np.int64), True if kind == "int64" else values < np.uint64(1 << 63)


# wire type and column type of a declared kind
KINDS = {
    "string": (BYTES, pa.binary()), "float": (FIXED32, pa.float64()), "double": (FIXED64, pa.float64()),
    "int32": (VARINT, pa.int32()), "uint32": (VARINT, pa.int32()), "int64": (VARINT, pa.int64()), "uint64": (VARINT, pa.int64()),
}


def column(data: np.ndarray, found: Fields, owner: np.ndarray, count: int, number: int, kind: str) -> pa.Array:
    """One value per owner of a single field; ``owner`` maps the messages of ``found`` to owners, the last value counts."""
    wire, arrow = KINDS[kind]
    mine = found.which(number, wire)
    if not len(mine):
        return pa.nulls(count, arrow)
    newest = np.full(count, -1, np.int64)
    newest[owner[found.message[mine]]] = mine  # in the order of the bytes: the last assignment stays
    valid = newest >= 0
    pick = np.where(valid, newest, mine[0])
    if kind == "string":
        return texts(data, found.start[pick], found.stop[pick], valid)
    values, fits = numbers(data, found.start[pick], found.value[pick], kind)
    return pa.array(values, mask=~(valid & fits))
