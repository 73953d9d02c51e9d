"""Hashed word and character n-gram features of a whole text, as numpy arrays of bucket numbers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MIX1, _MIX2, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point below the private planes: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x40000)), bool, 0x40000)


def is_letter(points: np.ndarray) -> np.ndarray:
    return letter_table()[np.minimum(points, 0x3FFFF)]


def ngram_buckets(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of each n-gram, in order of place."""
    if len(points) < n:
        return np.empty(0, np.int64)
    h = np.full(len(points) - n + 1, n, np.uint64)
    for k in range(n):
        h = h * _STEP + points[k: len(points) - n + 1 + k]
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def word_buckets(points: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each maximal run of characters other than ASCII white space."""
    word = ~((points == 32) | ((points >= 9) & (points <= 13)))
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
    if not len(starts):
        return np.empty(0, np.int64)
    at = np.arange(len(points), dtype=np.uint64)
    first = np.zeros(len(points), np.uint64)
    first[starts] = starts.astype(np.uint64)
    place = at - np.maximum.accumulate(first)
    each = np.where(word, mix(points + (place + np.uint64(1)) * _STEP), np.uint64(0))
    return (mix(np.add.reduceat(each, starts)) >> np.uint64(64 - bits)).astype(np.int64)
