"""Suffix arrays by linear grouping.

Phase one sorts suffixes into groups by their Lyndon prefixes. Groups are visited from the highest down; each suffix of the visited
group finds the nearest suffix before it that stands in a lower group, its previous smaller one. Those that k suffixes
of the visited group point to have its Lyndon prefix k times more at the end of their own, so they leave their group for
a new one right above it, the more often pointed to the higher. Phase two reads the order off: whatever has the suffix
at hand as the next smaller one is the least of its group that is not placed yet. No ranks are renamed, no recursion is made.
"""

from __future__ import annotations

import numpy as np


UNSET = -2


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The order of all suffixes of symbols, whose last is the only least one."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    value = symbols[order]
    begins = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    sizes = np.diff(np.append(begins, n))
    group_at = np.empty(n, dtype=np.int64)
    group_at[order] = np.repeat(begins, sizes)
    place_at = np.empty(n, dtype=np.int64)
    place_at[order] = np.arange(n)
    size_at = np.zeros(n, dtype=np.int64)
    size_at[begins] = sizes
    at, place, group, size = order.tolist(), place_at.tolist(), group_at.tolist(), size_at.tolist()  # suffix of a place; place, and group's first place, of a suffix; size by a group's first place
    smaller = [UNSET] * n  # previous smaller suffix, -1 for none
    top = n - 1
    while top >= 0:
        low = group[at[top]]
        if low == top:  # most groups hold one suffix
            s = at[low]
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                own = group[p]
                m = size[own] - 1
                if m:  # a group of one needs no split
                    last, here = own + m, place[p]
                    other = at[last]
                    at[here], place[other] = other, here
                    at[last], place[p] = p, last
                    size[own] = m
                    group[p], size[last] = last, 1
            top = low - 1
            continue
        pointed: dict[int, int] = {}
        for first in at[low : top + 1]:
            waiting = [first]
            while waiting:
                s = waiting[-1]
                p = s - 1
                while p >= 0 and group[p] >= low:
                    if smaller[p] == UNSET:  # of the same group: its own comes first
                        waiting.append(p)
                        break
                    p = smaller[p]
                else:
                    waiting.pop()
                    if smaller[s] == UNSET:
                        smaller[s] = p
                        if p >= 0:
                            pointed[p] = pointed.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, times in pointed.items():
            by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            moved: dict[int, int] = {}  # how many leave each group
            for p in by_times[times]:
                own = group[p]
                last, here = own + size[own] - 1, place[p]
                other = at[last]
                at[here], place[other] = other, here
                at[last], place[p] = p, last
                size[own] -= 1
                moved[own] = moved.get(own, 0) + 1
            for own, count in moved.items():
                new = own + size[own]
                for k in range(new, new + count):
                    group[at[k]] = new
                size[new] = count
        top = low - 1
    free = list(range(n))  # the next place of a group, by its first place
    out = [-1] * n
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            own = group[s]
            out[free[own]] = s
            free[own] += 1
            placed[s] = 1
            s = smaller[s]
    return np.array(out, dtype=np.int64)
