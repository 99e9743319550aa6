"""Hashes of words and of runs of words, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a whole text, optionally with A-Z lowered."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = (data.lower() if lower else data).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, size + (seed << 32), np.uint64)
    for j in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MIX + hashes[j : j + n]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def hashes_at(hashes: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """``run_hashes(hashes, size, seed)[at]``, without the others."""
    out = np.full(len(at), size + (seed << 32), np.uint64)
    for j in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MIX + hashes[at + j]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle, a text without words none."""
    words = word_hashes(text, lower=True)
    return np.unique(run_hashes(words, min(size, len(words)))) if len(words) else words
