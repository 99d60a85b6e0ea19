"""Edit distance of word sequences within a limit, by alignment in a band of diagonals."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np

#: Up to this distance diagonals are followed from mismatch to mismatch, beyond it the band is filled by columns.
FOLLOWED = 12


def _followed(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The distance if it is at most ``limit``: furthest point on each diagonal with 0, 1, 2 ... edits."""
    la, lb = len(a), len(b)
    goal = lb - la
    mismatches: dict[int, list[int]] = {}

    def slide(i: int, k: int) -> int:
        """Furthest i on diagonal j = i + k that is reached from i without an edit."""
        if k not in mismatches:
            low, high = max(0, -k), min(la, lb - k)
            found = (np.flatnonzero(a[low:high] != b[low + k : high + k]) + low).tolist()
            mismatches[k] = [*found, high]
        places = mismatches[k]
        at = bisect_left(places, i)
        return places[at] if at < len(places) else i

    furthest = {0: slide(0, 0)}
    if goal == 0 and furthest[0] == la:
        return 0
    for edits in range(1, limit + 1):
        fresh = {}
        for k in range(max(-edits, -la), min(edits, lb) + 1):
            i = max(furthest.get(k, -2) + 1, furthest.get(k + 1, -2) + 1, furthest.get(k - 1, -2))
            i = min(i, la, lb - k)
            if i >= max(0, -k):
                fresh[k] = slide(i, k)
        furthest = fresh
        if furthest.get(goal, -1) >= la:
            return edits
    return None


def _banded(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The distance if it is at most ``limit``: the band of 2 * limit + 1 diagonals, a column at a time.

    A column is held as bits, one per diagonal: where the distance rises (up) or falls (down) from one row to
    the next. Whole columns are worked out by a few operations on long integers.
    """
    if len(a) < len(b):
        a, b = b, a
    rows, columns = len(a), len(b)
    limit = min(limit, rows)
    width = (1 << (2 * limit + 1)) - 1
    at_word: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        at_word[word] = at_word.get(word, 0) | 1 << (i + limit)
    up, down = width ^ ((1 << limit) - 1), 0
    distance, last, bottom = limit, rows - limit, 1 << (2 * limit)
    most = limit + columns - last
    for j, word in enumerate(b.tolist()):
        match = (at_word.get(word, 0) >> j) & width
        free = ((((match & up) + up) ^ up) | match | down) & width
        right_up = down | (width ^ (free | up))
        right_down = free & up
        if j < last:  # along the lowest diagonal
            if not free & bottom:
                distance += 1
                if distance > most:
                    return None
        else:  # along the last row
            bottom >>= 1
            if right_up & bottom:
                distance += 1
            elif right_down & bottom:
                distance -= 1
        free >>= 1
        up = right_down | (width ^ (free | right_up))
        down = free & right_up
    return distance if distance <= limit else None


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance of two integer sequences if it is at most ``limit``, else None."""
    if abs(len(a) - len(b)) > limit:
        return None
    shorter = min(len(a), len(b))
    differ = np.flatnonzero(a[:shorter] != b[:shorter])
    start = int(differ[0]) if len(differ) else shorter
    a, b, shorter = a[start:], b[start:], shorter - start
    differ = np.flatnonzero(a[len(a) - shorter :][::-1] != b[len(b) - shorter :][::-1])
    end = int(differ[0]) if len(differ) else shorter
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not len(a) or not len(b):
        return len(a) + len(b) if len(a) + len(b) <= limit else None
    found = _followed(a, b, min(limit, FOLLOWED))
    if found is not None or limit <= FOLLOWED:
        return found
    return _banded(a, b, limit)
