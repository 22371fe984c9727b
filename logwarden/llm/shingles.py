"""Word and word-shingle hashes of whole record batches, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; a longer text is cut between words.
CHUNK = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random value for each byte; A-Z share those of a-z, so hashing folds their case.
VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
VALUES[65:91] = VALUES[97:123]
VALUES[IS_SPACE] = 0
BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _grown(name: str, base: int, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        factors = np.full(max(n, CHUNK + 1), base, dtype=U)
        factors[0] = 1
        _powers[name] = np.multiply.accumulate(factors)
    return _powers[name]


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 ``data``, and the number of words before each of ``bounds`` (starts of texts and the end).

    The hash of a word comes from two prefix sums of byte values times powers of an odd base, modulo 2^64.
    """
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(bounds), np.int64)
    solid = ~IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & (~before | first[:n]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum(VALUES[data] * _grown("up", BASE, n)[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _grown("down", pow(BASE, -1, 1 << 64), n)[starts]
    return mix(hashes + (ends - starts).astype(U)), np.searchsorted(starts, bounds)


def _long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, in chunks cut after a space."""
    parts, at = [], 0
    while at < len(data):
        stop = min(at + CHUNK, len(data))
        while stop < len(data) and not IS_SPACE[data[stop - 1]]:
            gap = np.flatnonzero(IS_SPACE[data[stop:stop + CHUNK]])
            stop = stop + int(gap[0]) + 1 if len(gap) else min(stop + CHUNK, len(data))
        parts.append(hash_words(data[at:stop], np.array([0, stop - at]))[0])
        at = stop
    return np.concatenate(parts)


def word_arrays(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of rows: the word hashes of all their texts, and the bounds of each text among them.

    A null text has no words.
    """
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1, row + 1)
        part = data[offsets[row]:offsets[stop]]
        if len(part) > CHUNK:
            words = _long(part)
            yield words, np.array([0, len(words)])
        else:
            yield hash_words(part, offsets[row:stop + 1] - offsets[row])
        row = stop


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles; a text of fewer words is one shingle, an empty one none."""
    for words, bounds in word_arrays(column):
        rolled = words[:max(len(words) - k + 1, 0)].copy()
        for j in range(1, k):
            rolled = mix(rolled * U(BASE) + words[j:j + len(rolled)])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(rolled[a:b - k + 1])
            elif a == b:
                yield rolled[:0]
            else:
                whole = words[a:a + 1] + U(b - a)
                for j in range(a + 1, b):
                    whole = mix(whole * U(BASE) + words[j:j + 1])
                yield whole
