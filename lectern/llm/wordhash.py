"""Vectorised words and rolling hashes over a slice of texts.

Hashes are polynomial (Rabin-Karp) modulo 2**64 over prefix sums, so the hash
of any run of bytes or words costs O(1), followed by a bit mixer.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomials and of the bit mixer (splitmix64).
_BASE = 0x9E3779B97F4A7C15
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_WRAP = (1 << 64) - 1

#: ASCII white space: blank and \t to \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACE
#: 0-9, a-z and every byte of a character beyond ASCII (texts lower-cased before).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n. A table for an unusually
    long text is not kept."""
    global _powers, _inverse
    if n <= len(_powers):
        return _powers[:n], _inverse[:n]
    size = max(n, 1 << 16)
    up = np.full(size, np.uint64(_BASE))
    down = np.full(size, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if size <= 1 << 23:
        _powers, _inverse = up, down
    return up[:n], down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def find_words(buf: np.ndarray, off: np.ndarray, table: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words; ``first[d]:first[d+1]``
    are those of text d. A word never runs over the end of its text."""
    inside = np.zeros(len(buf) + 1, dtype=bool)
    inside[:-1] = table[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[off] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends, np.searchsorted(starts, off)


def run_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Mixed hash of each run values[lo:hi], length included."""
    n = len(values)
    up, down = _tables(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[hi] - total[lo]) * down[lo]
    return mix(h + (hi - lo).astype(np.uint64) * _SALT)


def run_hashes_of(values: np.ndarray, lo: np.ndarray, n: int) -> np.ndarray:
    """``run_hashes`` of the runs values[lo:lo + n] of one short length, without
    tables over all of ``values``."""
    up, _ = _tables(n)
    h = np.zeros(len(lo), dtype=np.uint64)
    for i in range(n):
        h += (values[lo + i].astype(np.uint64) + np.uint64(1)) * up[i]
    return mix(h + np.uint64(n * int(_SALT) & _WRAP))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """The sums that ``common_runs`` compares runs by."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _tables(len(values) + 1)[0][:len(values)], out=total[1:])
    return total


def common_runs(total_a: np.ndarray, a: np.ndarray, total_b: np.ndarray, b: np.ndarray,
                least: int, most: np.ndarray) -> np.ndarray:
    """Length of the longest run that both sequences share from a[i] and from b[i]
    on, known to be at least ``least`` and at most ``most[i]``; by halving."""
    _, down = _tables(max(len(total_a), len(total_b)) + 1)
    lo, hi = np.full(len(a), least, dtype=np.int64), np.maximum(most, least)
    while (lo < hi).any():
        n = (lo + hi + 1) // 2
        same = (total_a[a + n] - total_a[a]) * down[a] == (total_b[b + n] - total_b[b]) * down[b]
        lo, hi = np.where(same, n, lo), np.where(same, hi, n - 1)
    return lo


def windows(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the runs of k words inside one text."""
    counts = np.diff(first)
    full = np.maximum(counts - k + 1, 0)
    doc = np.repeat(np.arange(len(counts)), full)
    begin = np.zeros(len(counts), dtype=np.int64)
    np.cumsum(full[:-1], out=begin[1:])
    starts = np.arange(int(full.sum())) - begin[doc] + first[doc]
    return starts, run_hashes(words, starts, starts + k)
