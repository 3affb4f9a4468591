"""Numpy views on the text columns of Arrow batches: words, their hashes, runs of words.

Everything here works on the UTF-8 bytes as Spark hands them over, a few megabytes at a
time, so memory does not depend on how many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together.
CHUNK = 1 << 21

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string column; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def byte_classes(keep: bytes, lower: bool) -> np.ndarray:
    """Table from byte to whether it belongs to a word (first row) and its value (second)."""
    table = np.zeros((2, 256), np.uint8)
    table[0, list(keep)] = 1
    table[1] = np.arange(256)
    if lower:
        table[1, 65:91] += 32
    return table


#: Words between ASCII white space.
SPACED = byte_classes(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13), False)
SPACED_LOWER = byte_classes(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13), True)
#: Words of ASCII digits and letters and of everything that is not ASCII.
ALNUM_LOWER = byte_classes(bytes(b for b in range(256) if chr(b).isalnum() and b < 128 or b > 127), True)


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Start and end of each word, and for each row the number of its first word."""
    inside = table[0][data].view(bool)
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    start[edges] |= inside[edges]
    stop[edges - 1] |= inside[edges - 1]
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word; equal words (after the table's folding) hash alike."""
    folded = np.zeros(len(data) + 8, np.uint8)
    folded[:len(data)] = table[1][data]
    eight = np.ndarray(len(data) + 1, np.uint64, folded.data, strides=(1,))
    length = stops - starts
    h = length.astype(np.uint64) * _MIX
    at, left, active = starts, length, None
    while len(at):
        part = eight[at] & _MASKS[np.minimum(left, 8)]
        if active is None:
            h = mix((h ^ part) * _MIX)
            active = np.flatnonzero(left > 8)
            at, left = at[active] + 8, left[active] - 8
        else:
            h[active] = mix((h[active] ^ part) * _MIX)
            more = left > 8
            active, at, left = active[more], at[more] + 8, left[more] - 8
    return h


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words, row ends not regarded."""
    n = max(0, len(h) - width + 1)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix((out ^ h[k:k + n]) * _MIX + np.uint64(k + 1))
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """One where a code point starts."""
    return (data & 0xC0) != 0x80


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
