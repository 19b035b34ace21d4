"""Words and their 64-bit hashes for many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. These bytes never occur
inside a multi-byte character, so working on bytes gives the same words as working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=1)
def _grown(size: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least `size` of each."""
    return _grown(1 << max(PIECE_BYTES.bit_length(), size.bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits of the result depend on all bits of the value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts of about `most` bytes."""
    data, offsets = utf8(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal runs of marked bytes that stay in one row."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = offsets[:-1][offsets[:-1] < len(inside)]
    first[begin] = inside[begin]
    close = offsets[1:][offsets[1:] > 0] - 1
    last[close] = inside[close]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of odd numbers, the same wherever the span stands."""
    powers, inverses = _powers(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverses[starts])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    return span_hashes(_VALUES[data], starts, ends)


def _open_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and row of every run, block by block; a run that crosses blocks is carried as its sum and length."""
    carried, length, owner = np.uint64(0), 0, -1
    for low in range(0, len(data), PIECE_BYTES):
        high = min(len(data), low + PIECE_BYTES)
        block = data[low:high]
        first = int(np.searchsorted(offsets, low, "right")) - 1
        bounds = np.clip(offsets[first : int(np.searchsorted(offsets, high, "left")) + 1] - low, 0, len(block))
        starts, ends, row = spans(inside[block], bounds)
        row = row + first
        powers, inverses = _powers(len(block))
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_VALUES[fold[block]] * powers[: len(block)], out=total[1:])
        sums = (total[ends] - total[starts]) * inverses[starts]
        if owner >= 0:
            if len(starts) and starts[0] == 0 and row[0] == owner:
                shift = np.uint64(pow(_BASE, length, 1 << 64))
                sums[:1] = carried + shift * sums[:1]
                length += int(ends[0])
            else:
                yield mix(np.array([carried])), np.array([owner])
                length, owner = 0, -1
        if len(ends) and ends[-1] == len(block) and high < len(data) and inside[data[high]] and offsets[row[-1] + 1] > low + len(block):
            if owner < 0 or len(ends) > 1:
                length = int(ends[-1] - starts[-1])
            carried, owner = sums[-1], int(row[-1])
            sums, row = sums[:-1], row[:-1]
        else:
            length, owner = 0, -1
        yield mix(sums), row


def run_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray = np.arange(256, dtype=np.uint8)) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the maximal runs of the bytes marked in `inside`, in order; bytes count as `fold` has them.

    Longer data than two pieces goes through in blocks, so that a very long text needs little more memory than its
    own bytes and the hashes of its runs.
    """
    if len(data) <= 2 * PIECE_BYTES:
        starts, ends, row = spans(inside[data], offsets)
        return hashes(fold[data], starts, ends), row
    found = list(_open_runs(data, offsets, inside, fold))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, in order."""
    return run_hashes(data, offsets, ~WHITE, LOWER)
