"""Length of the longest common subsequence of two token lists, by whichever of three
exact ways is cheapest for the pair."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np

#: Measured microseconds: of one step of a row of bits and of each of its bits, of one
#: match point, of one step along a diagonal.
_ROW, _BIT, _POINT, _STEP = 0.4, 7e-5, 0.15, 0.12
#: Pairs cheaper than this are not worth a try by differences.
_CHEAP = 2000.0


def by_rows(a: list, b: list) -> int:
    """One big integer is a whole row of the table, so a pair costs ``len(a)`` integer
    operations (Crochemore et al., 2001)."""
    places: dict[str, int] = {}
    for j, token in enumerate(b):
        places[token] = places.get(token, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for token in a:
        hit = row & places.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def by_points(a: list, b: list) -> int:
    """Longest increasing chain of match points (Hunt and Szymanski, 1977): the cost is
    that of the places where both lists hold the same token."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []  # the least place in b at which a chain of each length ends
    for token in a:
        for j in places.get(token, ()):
            k = bisect_left(ends, j)
            if k == len(ends):
                ends.append(j)
            else:
                ends[k] = j
    return len(ends)


def by_differences(a: list, b: list, budget: float = float("inf")) -> int | None:
    """Furthest reaching paths with 0, 1, 2, ... insertions and deletions (Myers, 1986);
    none if that takes more than ``budget`` steps."""
    n, m = len(a), len(b)
    reached = {1: 0}
    steps = 0
    for d in range(n + m + 1):
        # Diagonals that left the table cannot come back.
        for k in range(-d + 2 * max(0, d - m), d - 2 * max(0, d - n) + 1, 2):
            down = k == -d or (k != d and reached.get(k - 1, -1) < reached.get(k + 1, -1))
            x = start = reached[k + 1] if down else reached[k - 1] + 1
            while x < n and x - k < m and a[x] == b[x - k]:
                x += 1
            reached[k] = x
            steps += 2 + x - start
            if x >= n and x - k >= m:
                return (n + m - d) // 2
        if steps > budget:
            return None
    raise AssertionError("a path of n + m differences always exists")


def numbered(a: list, b: list) -> tuple[np.ndarray, np.ndarray, list]:
    """Both lists as numbers, and the different tokens by number."""
    numbers: dict = defaultdict()
    numbers.default_factory = numbers.__len__
    a, b = (np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)) for tokens in (a, b))
    return a, b, list(numbers)


def lcs(a: list, b: list) -> int:
    a, b, different = numbered(a, b)
    return lcs_of_numbers(a, b, len(different))


def lcs_of_numbers(a: np.ndarray, b: np.ndarray, size: int) -> int:
    """Of tokens as numbers below ``size``. Tokens that only one side has leave, as do equal
    beginnings and ends. What is left goes by match points or by rows of bits, after a try by
    differences that may take a quarter as long."""
    head = _equal_at_start(a, b)
    a, b = a[head:], b[head:]
    tail = _equal_at_start(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    in_a, in_b = np.bincount(a, minlength=size), np.bincount(b, minlength=size)
    points = int(in_a @ in_b)
    a, b = a[in_b[a] > 0].tolist(), b[in_a[b] > 0].tolist()
    if not a:
        return head + tail
    rows_cost, points_cost = len(a) * (_ROW + _BIT * len(b)), points * _POINT
    cost = min(rows_cost, points_cost)
    found = by_differences(a, b, cost / 4 / _STEP) if cost > _CHEAP else None
    if found is None:
        found = by_points(a, b) if points_cost < rows_cost else by_rows(a, b)
    return head + found + tail


def _equal_at_start(a: np.ndarray, b: np.ndarray) -> int:
    shorter = min(len(a), len(b))
    differs = a[:shorter] != b[:shorter]
    return int(differs.argmax()) if differs.any() else shorter
