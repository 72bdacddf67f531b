"""Hashed word shingles of Arrow text columns, whole batches at a time.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` after A-Z are lower-cased, which is safe on UTF-8 because
every byte concerned is ASCII. A word's hash is a difference of prefix sums, so no Python code runs per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes between words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 one)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))[_LOWER]
_STEP = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for slices of the usual size only."""
    if len(_powers[0]) >= size:
        return _powers[0], _powers[1]
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(max(size, SLICE_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if size <= SLICE_BYTES:
        _powers[:] = made
    return made[0], made[1]


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole texts of about ``slice_bytes`` in all: (first row, bytes, offsets). Null texts are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and where each text's words begin among them. ``breaks`` marks the bytes that
    belong to no word."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    blank = breaks[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= blank[:-1]
    after = edge[1:].copy()
    after[:-1] |= blank[1:]
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & after) + 1
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Each text's distinct hashes of ``width`` (at most five) words in ascending order; fewer words make one shingle,
    no words none."""
    for _, data, offsets in text_slices(column):
        words, bounds = word_hashes(data, offsets)
        grams = np.zeros(0, dtype=np.uint64)
        if len(words) >= width:
            count = len(words) - width + 1
            grams = words[:count] * _STEP[0]
            for k in range(1, width):
                grams += words[k:k + count] * _STEP[k]
            grams = mix(grams)
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if end - start >= width:
                yield np.unique(grams[start:end - width + 1])
            elif end > start:
                short = (words[start:end] * _STEP[:end - start]).sum(dtype=np.uint64) + _U(end - start)
                yield mix(np.array([short], dtype=np.uint64) ^ _U(_BASE))
            else:
                yield np.zeros(0, dtype=np.uint64)


def set_digest(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets have equal names."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def prefix_length(size: int, percent: int) -> int:
    """How many of a set's first shingles, in any order all sets share, must hold one that a linked set also holds."""
    return size - -(-percent * size // 100) + 1 if size else 0
