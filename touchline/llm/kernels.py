"""Vectorised word hashing over Arrow text columns.

Words are hashed from prefix sums of a polynomial over a fixed random byte table, so that a block of many
documents costs a handful of numpy passes and no per-word Python. Documents are dealt in blocks of about
BLOCK bytes; a longer document is scanned in segments that end at white space, so memory follows the block
and not the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_COEF = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 65536)
        for k, base in enumerate((_R, _RINV)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def segment_words(buf: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one segment; cuts: offsets where a new document starts."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = cuts[cuts < n]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[buf] * power[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about size bytes; a longer document stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def words(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) of each text; empty texts have no words."""
    data, offsets = text_buffers(column)
    for lo, hi in blocks(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        if hi == lo + 1 and b - a > BLOCK:
            parts, at = [], a
            while at < b:
                stop = min(at + BLOCK, b)
                while stop < b and not _SPACE[data[stop]]:
                    step = _SPACE[data[stop : stop + BLOCK]]
                    stop += int(step.argmax()) if step.any() else len(step)
                parts.append(segment_words(data[at:stop], np.zeros(1, np.int64), lower)[0])
                at = stop
            yield lo, np.concatenate(parts)
            continue
        cuts = offsets[lo:hi] - a
        hashes, start = segment_words(data[a:b], cuts, lower)
        bounds = np.searchsorted(start, np.append(cuts, b - a))
        for k in range(hi - lo):
            yield lo + k, hashes[bounds[k] : bounds[k + 1]]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of width words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _COEF[0]
    for j in range(1, width):
        total = total + hashes[j : j + n] * _COEF[j]
    return mix(total)


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """The distinct width-word shingles, sorted; a shorter text is one shingle, no words none."""
    if not len(hashes):
        return hashes
    if len(hashes) < width:
        return mix(np.array([len(hashes)], np.uint64) + (hashes * _COEF[: len(hashes)]).sum(dtype=np.uint64))
    return np.unique(windows(hashes, width))


def repeated_words(hashes: np.ndarray, width: int) -> int:
    """Words that stand in a run of width words found twice or more."""
    runs = windows(hashes, width)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(hashes) + 1, np.int64)
    at = order[np.append(same, False) | np.insert(same, 0, False)]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + width, -1)
    return int((np.cumsum(hit)[:-1] > 0).sum())
