"""Array views of text columns: words, span hashes and chunks of Arrow batches.

Words are maximal runs of bytes other than space and 0x09-0x0D. All six are
ASCII, so working on UTF-8 bytes gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with about ``most`` bytes of text (a longer text is a slice of its own)."""
    for batch in batches:
        raw, at = buffers(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), raw[at[first]:at[last]], at[first:last + 1] - at[first]
            first = last


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of all words; none crosses a row."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    solid = ~IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n + 1).bit_length())
    if size not in _POWERS:
        grown = []
        for base in (_BASE, _INVERSE):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            grown.append(np.cumprod(out))
        _POWERS.clear()
        _POWERS[size] = grown
    return _POWERS[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans, equal wherever the same bytes stand."""
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _BASE)


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)
