"""Suffix arrays by linear grouping construction.

Suffixes are first grouped by their longest Lyndon prefix. Groups are taken from the highest to the
lowest; the members of a group point to the nearest position before them that lies in a lower group, and
whatever they point to is longer by as many copies of the group's prefix as point there, so it moves to a
new group right behind its old one. When all groups are done, one sweep from the smallest suffix up puts
every suffix in its place: a suffix is emitted once the suffix behind its Lyndon prefix has been. Nothing
is renamed and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of text in ascending order; text holds non-negative integers.

    A shorter suffix sorts before a longer one that it begins. Empty text gives an empty array.
    """
    n = len(text) + 1
    if n == 1:
        return np.zeros(0, np.int64)
    symbols = np.zeros(n, np.int64)
    symbols[:-1] = np.asarray(text, np.int64) + 1
    by_symbol = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(symbols[by_symbol]) != 0))
    sizes = np.diff(np.append(first, n))
    group_at = np.empty(n, np.int64)
    group_at[by_symbol] = np.repeat(first, sizes)
    place_at = np.empty(n, np.int64)
    place_at[by_symbol] = np.arange(n)
    end_at = np.zeros(n + 1, np.int64)
    end_at[first] = first + sizes
    held, group, place, end = by_symbol.tolist(), group_at.tolist(), place_at.tolist(), end_at.tolist()
    lower = [-1] * n

    top = n
    while top > 0:
        start = group[held[top - 1]]
        if top - start == 1:
            i = held[start]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = lower[j]
            lower[i] = j
            top = start
            if j >= 0:
                old = group[j]
                new = end[old] - 1
                if new > old:
                    other, at = held[new], place[j]
                    held[new], held[at] = j, other
                    place[j], place[other] = new, at
                    group[j], end[old], end[new] = new, new, new + 1
            continue
        members = sorted(held[start:top])
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        top = start
        by_times: dict[int, list[int]] = {}
        for j, c in times.items():
            by_times.setdefault(c, []).append(j)
        for c in sorted(by_times, reverse=True):
            moved: dict[int, int] = {}
            for j in by_times[c]:
                old = group[j]
                new = end[old] - 1
                other, at = held[new], place[j]
                held[new], held[at] = j, other
                place[j], place[other] = new, at
                end[old] = new
                moved[old] = moved.get(old, 0) + 1
            for old, k in moved.items():
                new = end[old]
                end[new] = new + k
                if new != old:
                    for p in range(new, new + k):
                        group[held[p]] = new

    free = list(range(n))
    emitted = bytearray(n)
    order = [0] * n
    order[0] = n - 1
    emitted[n - 1] = 1
    for r in range(n):
        j = order[r] - 1
        while j >= 0 and not emitted[j]:
            g = group[j]
            at = free[g]
            order[at] = j
            free[g] = at + 1
            emitted[j] = 1
            j = lower[j]
    return np.array(order[1:], np.int64)
