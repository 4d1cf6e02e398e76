"""Word hashes and shingles of texts, in numpy, for tasks that read whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)
#: Word hashes a Python worker remembers.
REMEMBERED = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_known = _WordHashes()


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a text as UTF-8; ``lower`` changes A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_known) > REMEMBERED:
        _known.clear()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _ODD
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def extended(values: np.ndarray, step: int) -> np.ndarray:
    """Hashes of runs that are ``step`` words longer, from those of shorter runs."""
    n = max(0, len(values) - step)
    return mixed(values[:n] * _MIX + (values[step:] ^ np.uint64(step)))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; none for shorter sequences.

    Each length comes from two runs of the length before, which may overlap.
    """
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    values, have = mixed(hashes + _MIX), 1
    while have < size:
        step = min(have, size - have)
        values = extended(values, step)
        have += step
    return values


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle as a whole."""
    words = split(text, lower=True)
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(windows(word_hashes(words), min(size, len(words))))
