"""Sets of word shingles, as 48-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

_FOLD, _MASK = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all word hashes, where each text's begin) of a list column."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return flat.view(np.uint64), offsets - offsets[0]


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that begin at each place of one text or of several in a row."""
    n = max(0, len(words) - size + 1)
    folded = np.zeros(n, np.uint64)
    for i in range(size):
        folded = folded * _FOLD + words[i : i + n]
    return mix(folded + np.uint64(size)) & _MASK


def shingle_sets(words: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a shorter text is one shingle, one without words none."""
    every = grams(words, size)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(every[a : b - size + 1]))
        else:
            sets.append(grams(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in byte planes, compressed."""
    planes = np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T[:6])
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :6] = planes.T
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)
