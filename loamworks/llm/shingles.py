"""Sets of word shingles as 64-bit hashes, for the near-duplicate operator.

Words are runs of non-white-space bytes after lower-casing A-Z.  A text of at
least ``WIDTH`` words has its distinct ``WIDTH``-word windows as its set, one
of fewer words the whole sequence as the only element, one without words the
empty set.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .arrow import Bounded

WIDTH = 5
_rng = np.random.default_rng(20240229)
_PLACES = _rng.integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def word_cache() -> Bounded:
    return Bounded(xxhash.xxh64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, known: Bounded) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WIDTH, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        total += h[k : k + n] * _PLACES[k]
    return np.unique(mix(total))
