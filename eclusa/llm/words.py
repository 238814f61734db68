"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of 0-9, a-z (after lower-casing A-Z) and non-ASCII
characters; a text's words never join those of its neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
# Odd, so that powers have inverses modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
# Bytes that are hashed together.
_SEGMENT = 1 << 20


@dataclass
class Words:
    """Byte ranges, text number and 64-bit hash of each word, in order."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    # First word of each text, and one past the last word of all.
    first: np.ndarray
    lowered: np.ndarray

    def joined(self, first: int, last: int) -> bytes:
        """The words from ``first`` up to ``last``, lower-case, with one space between."""
        return b" ".join(
            self.lowered[s:e].tobytes()
            for s, e in zip(self.start[first:last], self.end[first:last], strict=True)
        )


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; the ranges are in order and don't overlap."""
    out = np.zeros(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _SEGMENT, side="right")))
        low, high = int(start[i]), int(end[j - 1])
        up, down = _powers(max(_SEGMENT, high - low))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _STEP
        i = j
    return mix(out)


def bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of ``inside``; runs end where texts end."""
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def scan(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of the texts that lie between the offsets."""
    lowered = _LOWER[data]
    start, end = bounds(_IS_WORD[data], offsets)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, text, hash_ranges(lowered, start, end), first, lowered)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words of one text, and the number of its first word."""
    total = len(words.hash) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words.hash[:total].copy()
    for j in range(1, n):
        h *= _STEP
        h += words.hash[j : j + total]
    at = np.flatnonzero(words.text[:total] == words.text[n - 1 :])
    return mix(h[at]), at
