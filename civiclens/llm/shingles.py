"""Word shingle sets as arrays of 64-bit hashes, in numpy.

Words are runs of bytes other than ASCII white space, after A-Z are
lower-cased.  A word's hash is a polynomial over its bytes, taken from prefix
sums of the whole text, then mixed; a shingle's hash combines its words' hashes
by place.  A text with fewer words than a shingle has is one shingle; a text
without words has none.
"""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int):
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    if len(_POWERS[0]) < n:
        n = max(1 << 14, 1 << (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def _chunks(b: np.ndarray):
    """Pieces of some CHUNK bytes that end between words."""
    a = 0
    while a < len(b):
        e = a + CHUNK
        if e < len(b):
            back = np.flatnonzero(_SPACE[b[a:e]])
            if len(back):
                e = a + int(back[-1]) + 1
            else:
                while e < len(b) and not _SPACE[b[e]]:
                    e += 1
        yield b[a:e]
        a = e


def word_hashes(text: str) -> np.ndarray:
    out = []
    for b in _chunks(np.frombuffer(text.encode("utf-8", "replace"), np.uint8)):
        edge = np.diff(np.concatenate(([1], _SPACE[b].view(np.int8), [1])))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(start):
            continue
        power, inverse = _powers(len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_LOWER[b] * power[:len(b)], out=sums[1:])
        out.append(mix((sums[end] - sums[start]) * inverse[start]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        h = mix(h + w[j:len(w) - size + 1 + j])
    return np.unique(h)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union; empty sets are never linked."""
    if not len(a) or not len(b) or min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
