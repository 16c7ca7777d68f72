"""Sets of hashed word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

from touchpath.llm.common import mix64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for the values at the same place of several arrays, in their order."""
    mixed = mix64(parts[0])
    for part in parts[1:]:
        mixed = mix64(mixed * _FACTOR + part)
    return mixed


def shingle_set(text: bytes, length: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``length`` words, A-Z lower-cased; of all words as one run if they
    are fewer; nothing without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < length:
        return mix64(np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64))
    hashes = word_hashes(words)
    runs = len(words) - length + 1
    return np.unique(joined([hashes[i : i + runs] for i in range(length)]))
