"""Vectorised 64-bit word hashes over UTF-8 buffers (numpy only, used inside tasks).

A word's hash is a polynomial in its bytes modulo 2**64, taken from prefix sums
over the whole buffer, so that no Python object is made per word.
"""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        m = 1 << (n - 1).bit_length()
        p = np.full(m, _P, np.uint64)
        q = np.full(m, _P_INV, np.uint64)
        p[0] = q[0] = 1
        _powers, _inverse = np.multiply.accumulate(p), np.multiply.accumulate(q)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes (not mixed yet) of the byte runs [start, end)."""
    n = len(data)
    _grow(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    return (sums[end] - sums[start]) * _inverse[start]


def run_bounds(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the runs of one non-zero kind; a run never crosses rows."""
    n = len(kind)
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[offsets] = True
    at = np.flatnonzero(change)
    start, end = at[:-1], at[1:]
    some = kind[start] > 0
    return start[some], end[some]


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray,
          lower: np.ndarray | None = None, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per row the offset of its first word (n + 1).

    ``word_byte`` marks the bytes that words consist of; a word never crosses rows.
    With ``prefixes`` the hashes are (1 + len(prefixes)) x words: the words' first so many bytes too.
    """
    if len(data) == 0:
        return np.zeros((1 + len(prefixes), 0) if prefixes else 0, np.uint64), np.zeros(len(offsets), np.int64)
    if lower is not None:
        data = lower[data]
    start, end = run_bounds(word_byte[data].view(np.uint8), offsets)
    if not prefixes:
        h = run_hashes(data, start, end)
    else:  # prefixes are told apart from whole words by their length
        ends = np.stack([end, *[np.minimum(end, start + k) for k in prefixes]])
        h = run_hashes(data, np.broadcast_to(start, ends.shape), ends) + np.array([0, *prefixes], np.uint64)[:, None]
    return mix(h), np.searchsorted(start, offsets).astype(np.int64)
