"""Suffix orders by linear grouping: suffixes are grouped by their Lyndon prefixes, then each group is emitted in order.

Phase one starts with a group a symbol and takes the groups from the highest to the lowest. For every suffix of the group it finds the
previous smaller one, the last position before it whose group is lower. The positions found leave their groups for new ones right
after them, those found most often last. When all groups are done, suffixes are grouped by their Lyndon prefixes, in order. Phase
two walks through the order from its start and puts the suffix before each suffix, and those its previous-smaller pointers lead to, to
the next free place of their groups. No group is ever sorted and no symbol renamed again.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def suffix_order(text: list[int]) -> list[int]:
    """Starts of the suffixes of one text in order. Its last symbol is the smallest, and smaller than all but copies of it."""
    n = len(text)
    by_symbol: dict[int, list[int]] = defaultdict(list)
    for i, c in enumerate(text):
        by_symbol[c].append(i)
    group, size, opener, members, before = [0] * n, [0] * n, [0] * (n + 1), {}, [-1] * n
    at = 0
    for c in sorted(by_symbol):
        found = by_symbol[c]
        for i in found:
            group[i] = at
        size[at], members[at] = len(found), found
        opener[at + len(found)] = at
        at += len(found)
    end = n
    while end > 0:
        g = opener[end]
        times: dict[int, int] = defaultdict(int)
        for i in members.pop(g):
            if group[i] != g:
                continue
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                times[j] += 1
        classes: dict[tuple[int, int], list[int]] = defaultdict(list)
        for j in sorted(times):
            classes[group[j], -times[j]].append(j)
        for old, often in sorted(classes):
            moved = classes[old, often]
            stop = old + size[old]
            new = stop - len(moved)
            if new > old:
                size[old] = new - old
                opener[new] = old
                members[new] = moved
                size[new] = len(moved)
                for j in moved:
                    group[j] = new
            opener[stop] = new
        end = g
    order, free, placed = [0] * n, list(range(n)), [False] * n
    order[0], placed[n - 1] = n - 1, True
    free[group[n - 1]] += 1
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = before[s]
    return order


def suffix_orders(texts: np.ndarray) -> np.ndarray:
    """The same for many texts of one length at once, (texts, length): every step takes one group of each text."""
    rows, n = texts.shape
    if n == 0:
        return np.zeros((rows, 0), np.int64)
    base = np.arange(rows) * n
    order = np.argsort(texts, axis=1, kind="stable")
    ordered = np.take_along_axis(texts, order, axis=1)
    new = np.ones((rows, n), bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0), axis=1)
    group2 = np.zeros((rows, n), np.int32)
    np.put_along_axis(group2, order, begin.astype(np.int32), axis=1)
    group = group2.ravel()
    size, opener, before = np.zeros(rows * n, np.int32), np.zeros(rows * (n + 1), np.int32), np.full(rows * n, -1, np.int32)
    r, s = np.nonzero(new)
    stop = np.append(s[1:], 0)
    stop[np.append(r[1:] != r[:-1], True)] = n
    size[r * n + s] = stop - s
    opener[r * (n + 1) + stop] = s
    end = np.full(rows, n)
    live = np.arange(rows)
    while len(live):
        g = opener[live * (n + 1) + end[live]]
        table = group2 if len(live) == rows else group2[live]
        r, i = np.nonzero(table == g[:, None])
        at, mine = base[live[r]], g[r]
        j = i - 1
        todo = np.arange(len(j))
        while len(todo):
            jt = j[todo]
            todo = todo[(jt >= 0) & (group[at[todo] + np.maximum(jt, 0)] >= mine[todo])]
            jt = at[todo] + j[todo]
            # a position of a higher group has its pointer; one of this group is on its way to the same place
            j[todo] = np.where(group[jt] > mine[todo], before[jt], j[todo] - 1)
        before[at + i] = j
        hit = j >= 0
        moved, times = np.unique(at[hit] + j[hit], return_counts=True)
        if len(moved):
            row = moved // n
            old = row * n + group[moved]
            by = np.lexsort((-times, old))
            moved, times, old, row = moved[by], times[by], old[by], row[by]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (old[1:] != old[:-1]) | (times[1:] != times[:-1])
            first = np.nonzero(fresh)[0]
            count = np.diff(np.append(first, len(by)))
            head, home = old[first], row[first]
            lead = np.ones(len(first), bool)
            lead[1:] = head[1:] != head[:-1]
            upto = np.cumsum(count)
            below = np.where(lead, upto - count, 0)
            upto = upto - np.maximum.accumulate(below)
            start = head - home * n
            full = size[head].copy()
            fresh_start = start + full - upto
            last = np.append(lead[1:], True)
            left = (full - upto)[last]
            some = left > 0
            size[head[last][some]] = left[some]
            opener[home[last][some] * (n + 1) + start[last][some] + left[some]] = start[last][some]
            size[home * n + fresh_start] = count
            opener[home * (n + 1) + fresh_start + count] = fresh_start
            group[moved] = np.repeat(fresh_start, count)
        end[live] = g
        live = live[g > 0]
    result, free, placed = np.zeros(rows * n, np.int64), np.tile(np.arange(n), rows), np.zeros(rows * n, bool)
    result[base] = n - 1
    placed[base + n - 1] = True
    free[base + group[base + n - 1]] += 1
    for i in range(n):
        s = result[base + i] - 1
        at = base
        while True:
            ok = s >= 0
            ok[ok] = ~placed[at[ok] + s[ok]]
            if not ok.any():
                break
            s, at = s[ok], at[ok]
            home = at + group[at + s]
            result[at + free[home]] = s
            free[home] += 1
            placed[at + s] = True
            s = before[at + s].astype(np.int64)
    return result.reshape(rows, n)
