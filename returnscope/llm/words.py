"""Words of UTF-8 texts and their hashes, computed over whole Arrow buffers.

A word is a longest run of bytes other than space, \\t, \\n, \\v, \\f and \\r
(``[^\\x20\\x09-\\x0D]+``), within one text.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for x in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 1 << 20:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word's index per text (one more than texts)."""
    black = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off[:-1]] = True
    first, last = black.copy(), black.copy()
    first[1:] &= ~black[:-1] | edge[1:-1]
    edge[:] = False
    edge[off[1:]] = True
    last[:-1] &= ~black[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each [start, end) of ``buf`` (starts ascending), in byte chunks."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, a + chunk)))
        b = int(ends[i:j].max())
        up, down = powers(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((buf[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def windows(words: np.ndarray, k: int, base: int = BASE, chunk: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of every run of k consecutive word hashes (len - k + 1 of them)."""
    n = len(words) - k + 1
    out = np.empty(max(n, 0), np.uint64)
    for a in range(0, n, chunk):
        b = min(n, a + chunk)
        up, down = powers(b - a + k, base)
        total = np.zeros(b - a + k, np.uint64)
        np.cumsum(words[a : b + k - 1] * up[: b - a + k - 1], out=total[1:])
        out[a:b] = mix((total[k : b - a + k] - total[: b - a]) * down[: b - a])
    return out
