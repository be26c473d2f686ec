"""Hashes of words and of runs of them, over whole texts at once. 64-bit arithmetic
wraps around on purpose."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))



def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for i, base in enumerate((ODD, _INVERSE)):
                _powers[i] = np.r_[np.uint64(1), np.cumprod(np.full(size - 1, base, np.uint64))]
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * down[: len(data)], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, hashes


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbours; of all at once if there are fewer."""
    n = min(n, len(hashes))
    if n < 2:
        return hashes
    with np.errstate(over="ignore"):
        grams, size = hashes, 1
        while size * 2 <= n:
            grams = mixed(grams[:-size] * ODD + grams[size:])
            size *= 2
        rest = n - size
        return mixed(grams[: len(grams) - rest] * ODD + grams[rest:] + np.uint64(n)) if rest else grams


def window_least(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` consecutive values; of all of them if there are fewer."""
    w = min(w, len(values))
    size = 1
    while size * 2 <= w:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = w - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values
