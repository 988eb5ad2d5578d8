"""Suffix sorting by grouping, in linear time and without renaming.

Phase 1 keeps suffixes in groups, intervals of the array that begins as the suffixes by first
symbol, and takes the groups in descending order. For each suffix of a group the nearest smaller
suffix before it (in a lower group) is found by following pointers; those predecessors are split
off their groups, more often hit ones higher. A final group shares the Lyndon prefix its suffixes
begin with. Phase 2 runs over the emerging order from the smallest suffix: the text position before
each placed suffix, and the chain of its pointers, take the next free place of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of a sequence of positive numbers, in ascending order."""
    symbols = np.append(np.asarray(text, dtype=np.int64), 0)
    n = len(symbols)
    array_np = np.argsort(symbols, kind="stable")
    place_np = np.empty(n, np.int64)
    place_np[array_np] = np.arange(n)
    values, first, count = np.unique(symbols[array_np], return_index=True, return_counts=True)
    group_np = np.empty(n, np.int64)
    group_np[array_np] = np.repeat(first, count)
    size_np = np.zeros(n, np.int64)
    size_np[first] = count
    array, place, group, size = array_np.tolist(), place_np.tolist(), group_np.tolist(), size_np.tolist()
    before = [-1] * n  # the nearest smaller suffix to the left
    jump = list(range(-1, n - 1))  # a shortcut along it

    end = n - 1
    while end > 0:
        low = group[array[end]]
        hits: dict[int, int] = {}
        for i in sorted(array[low : end + 1]):
            p, path = jump[i], []
            while p >= 0 and group[p] >= low:
                path.append(p)
                p = jump[p]
            before[i] = jump[i] = p
            for x in path:
                jump[x] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, k in hits.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in by_count[k]:
                g = group[p]
                last = g + size[g] - 1
                other, at = array[last], place[p]
                array[at], array[last] = other, p
                place[other], place[p] = at, last
                size[g] -= 1
                moved.setdefault(g, []).append(p)
            for g, own in moved.items():
                new = g + size[g]
                for p in own:
                    group[p] = new
                size[new] = len(own)
        end = low - 1

    out, free, placed = [-1] * n, list(range(n)), bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return out[1:]
