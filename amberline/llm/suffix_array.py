"""Suffix arrays by linear grouping: groups of equal Lyndon prefixes, then their order, without recursion or renaming.

First phase: suffixes are grouped by their first symbol, and groups are taken from the highest down.  The previous smaller suffix of a
member is its nearest position to the left in a group not yet taken; positions with equally many members pointing to them
leave their group for a new one right above it.  In the end a group holds the suffixes of one Lyndon prefix.  Second phase: in
ascending order, each sorted suffix places the one before it, and that one's chain of previous smaller suffixes, at the front
of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``symbols`` (small non-negative integers) in ascending order."""
    n = len(symbols) + 1  # positions 1 to n; the last is an end mark below every symbol
    codes = np.concatenate((np.asarray(symbols, dtype=np.int64) + 1, [0]))
    order = np.argsort(codes, kind="stable")
    sorted_codes = codes[order]
    bounds = np.concatenate(([0], np.flatnonzero(sorted_codes[1:] != sorted_codes[:-1]) + 1, [n])).tolist()
    positions = (order + 1).tolist()
    members = [positions[a:b] for a, b in zip(bounds, bounds[1:])]
    count = len(members)
    group = [0, *(np.searchsorted(np.array(bounds), np.argsort(order, kind="stable"), side="right") - 1).tolist()]
    size = [len(m) for m in members]
    below, above = list(range(-1, count - 1)), list(range(1, count + 1))
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    smaller = [0] * (n + 1)  # previous smaller suffix, 0 if there is none
    taken: list[int] = []

    current = count - 1
    while current >= 0:
        here = members[current]
        if size[current] != len(here):
            here = members[current] = [i for i in here if group[i] == current]
        if len(here) == 1:
            i = here[0]
            j = left[i]
            r = right[i]
            right[j] = r
            left[r] = j
            smaller[i] = j
            holder = group[j]
            if size[holder] > 1 and j:
                moves = ((holder, [j]),)
            else:
                moves = ()
        else:
            pointed: dict[int, int] = {}
            for i in here:
                j = left[i]
                r = right[i]
                right[j] = r
                left[r] = j
                smaller[i] = j
                pointed[j] = pointed.get(j, 0) + 1
            pointed.pop(0, None)
            by_group: dict[tuple[int, int], list[int]] = {}
            for j, times in pointed.items():
                by_group.setdefault((-times, group[j]), []).append(j)
            # those that many point to move first, and so end up highest
            moves = [(holder, moved) for (_, holder), moved in sorted(by_group.items())] if len(by_group) > 1 else \
                    [(holder, moved) for (_, holder), moved in by_group.items()]
        for holder, moved in moves:
            n_moved = len(moved)
            if n_moved < size[holder]:  # else the whole group moves, which changes nothing
                new = len(below)
                over = above[holder]
                below.append(holder)
                above.append(over)
                above[holder] = below[over] = new
                members.append(moved)
                size.append(n_moved)
                size[holder] -= n_moved
                for j in moved:
                    group[j] = new
        taken.append(current)
        current = below[current]

    front = [0] * len(below)
    at = 0
    for g in reversed(taken):
        front[g] = at
        at += size[g]
    out = [0] * n
    placed = bytearray(n + 1)
    placed[0] = placed[n] = 1
    out[0] = n
    front[group[n]] = 1
    for k in range(n):
        j = out[k] - 1
        while not placed[j]:
            g = group[j]
            s = front[g]
            front[g] = s + 1
            out[s] = j
            placed[j] = 1
            j = smaller[j]
    return np.array(out[1:], dtype=np.int64) - 1


def equal_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, class) of the windows of ``length`` bytes inside the strings data[start:end]; equal windows have one class.

    The strings are sorted as one text with breaks between them; neighbours in the suffix array that share ``length`` bytes are one class.
    """
    sizes = ends - starts + 1
    base = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    symbols = np.zeros(total, dtype=np.int64)
    origin = np.repeat(starts - base, sizes) + np.arange(total)
    inner = np.ones(total, dtype=bool)
    inner[base + sizes - 1] = False
    symbols[inner] = data[origin[inner]].astype(np.int64) + 1
    owner_end = np.repeat(ends, sizes)
    order = suffix_array(symbols)
    order = order[origin[order] + length <= owner_end[order]]
    at = origin[order]
    same = np.zeros(len(at), dtype=bool)
    step = np.arange(length)
    for a in range(1, len(at), 65_536):
        b = min(len(at), a + 65_536)
        rows = data[at[a - 1:b, None] + step]
        same[a:b] = (rows[1:] == rows[:-1]).all(axis=1)
    return at, np.cumsum(~same) - 1
