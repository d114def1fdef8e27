"""Word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

from hazardloom.llm.common import WHITE

_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in WHITE]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 - 2)  # odd, 3 modulo 8
_powers = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(2 * n, _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def word_hashes(text: str | None) -> np.ndarray:
    """A hash per word of the text, A-Z lower-cased, words as runs of anything but ASCII white space."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[data], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    inside = np.arange(len(data), dtype=np.int64)
    inside -= np.repeat(starts, np.diff(starts, append=len(data))) if starts[0] == 0 else np.concatenate([np.arange(starts[0]), np.repeat(starts, np.diff(starts, append=len(data)))])
    values = _BYTE[data] * _power(int((ends - starts).max()) + len(WHITE) + 1)[np.minimum(inside, int((ends - starts).max()))]
    values[_SPACE[data]] = 0
    return mix(np.add.reduceat(values, starts))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct shingles of ``words`` words, sorted; a shorter text is one shingle, one without words has none."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < words:
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for j, h in enumerate(w):
                total = total + h * _ODD[j]
            return mix(np.array([total + np.uint64(len(w)) * _ODD[words + len(w)]], dtype=np.uint64))
    n = len(w) - words + 1
    return np.unique(mix(sum(w[j : j + n] * _ODD[j] for j in range(words))))
