"""Hashed word shingles of whole texts.

Words are what lies between ASCII white space, A-Z in lower case. A shingle is ``SIZE`` words in
a row; a text of fewer words, but not none, has its whole sequence as its one shingle. Shingles
are 64-bit hashes: two different shingles agree with a chance of 2**-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

from shelfwise.llm import caches

SIZE = 5
_CACHED = 100_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: One odd multiplier for each word of a shingle, drawn from a fixed seed.
_MULTIPLIERS = np.random.default_rng(5).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hashes of words; kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < _CACHED and len(word) <= 64:
            self[word] = found
        return found


_WORDS = _Words()
caches.register("shingles", _WORDS.clear)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, size: int = SIZE) -> np.ndarray:
    """Hashes of all shingles of a text, in order, repeated ones included."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    hashes = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        salted = hashes * _MULTIPLIERS[size : size + n]
        return mix(salted.sum(keepdims=True) + np.uint64(n))
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for i in range(size):
        out += hashes[i : n - size + 1 + i] * _MULTIPLIERS[i]
    return mix(out)


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, size))
