"""Linear-time suffix sorting by grouping."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of text in their order. The last symbol must be smaller than all others, and only there.

    Linear grouping construction (Baier 2016). First the suffixes are grouped by their Lyndon prefixes: groups, at first
    one for each symbol, are taken in descending order; each of their suffixes points to the nearest one before it in a
    lower group, and the suffixes pointed to, whose prefix goes on with the group's, move to a higher group of their own
    right behind the one they were in (the oftener pointed to, the higher). Then the order inside the groups: a suffix
    whose turn has come puts those in front of it, along the pointers, next in their groups. Nothing is renamed or recursed.
    """
    n = len(text)
    symbols = np.asarray(text)
    by_symbol = np.argsort(symbols, kind="stable")
    ordered = symbols[by_symbol]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(new)
    start_of = np.repeat(first, np.diff(np.r_[first, n]))
    sa = by_symbol.tolist()
    where, group = np.empty(n, np.int64), np.empty(n, np.int64)
    where[by_symbol], group[by_symbol] = np.arange(n), start_of
    where, group = where.tolist(), group.tolist()
    end, lower = [0] * (n + 1), [-1] * n  # a group is known by its first place in sa; lower: the pointers
    for a, b in zip(first.tolist(), [*first[1:].tolist(), n], strict=True):
        end[a] = b
    high = n
    while high:
        low = group[sa[high - 1]]
        met: dict[int, int] = {}
        for i in sorted(sa[low:high]) if high - low > 1 else (sa[low],):
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = lower[p]
            lower[i] = p
            if p >= 0:
                met[p] = met.get(p, 0) + 1
        for times in sorted(set(met.values()), reverse=True) if len(met) > 1 else met.values():
            moved: dict[int, int] = {}
            for p, k in met.items():
                if k == times:
                    g = group[p]
                    if g not in moved:
                        moved[g] = end[g]
                    end[g] = to = end[g] - 1
                    q, at = sa[to], where[p]
                    sa[at], sa[to], where[q], where[p] = q, p, at, to
            for g, was in moved.items():
                if (a := end[g]) == g:
                    end[g] = was
                else:
                    end[a] = was
                    for p in sa[a:was]:
                        group[p] = a
        high = low
    out, front, placed = [n - 1] * n, list(range(n)), bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            placed[p] = 1
            g = group[p]
            out[front[g]] = p
            front[g] += 1
            p = lower[p]
    return out
