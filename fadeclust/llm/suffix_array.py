"""Suffix array by linear grouping over Lyndon prefixes (numpy-free core).

The first phase splits suffixes into groups by their longest Lyndon prefix.
Groups are handled from the highest down: each member's nearest position to the
left that lies in a lower group (its previous-smaller pointer) gets its prefix
extended by the handled group's prefix, and moves into a new group just above
its old one; positions extended more often move higher.  The second phase walks
the suffix array from the empty suffix up and puts, for every suffix, the
positions whose Lyndon prefix ends there into the next free slot of their group,
so no names are recomputed and no recursion takes place.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of non-negative integers.

    The empty sequence has an empty order; a suffix that is a prefix of another
    one comes before it.
    """
    n = len(symbols)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    cuts = np.flatnonzero(sorted_symbols[1:] != sorted_symbols[:-1]) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    size = [1] * len(members)           # length of the group's Lyndon prefix
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1] = -1
    group = [0] * n
    for g, part in enumerate(members):
        for i in part:
            group[i] = g
    live = [len(part) for part in members]  # members that have not moved on
    left = list(range(n))               # nearest unhandled position, itself included
    gone: list[tuple[int, list[int]]] = []  # handled groups, highest first
    top = len(members) - 1
    while top >= 0:
        count = live[top]
        if count:
            part = members[top]
            if len(part) != count:
                part = [i for i in part if group[i] == top]
            gone.append((top, part))
            length = size[top]
            for i in part:
                left[i] = i - 1
            times: dict[int, int] = {}
            for i in part:
                p = i - 1
                while p >= 0 and left[p] != p:
                    q = left[p]
                    if q >= 0:
                        left[p] = left[q]
                    p = q
                left[i] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            if len(times) == 1:
                moves = [(group[p], k, [p]) for p, k in times.items()]
            else:
                split: dict[tuple[int, int], list[int]] = {}
                for p, k in times.items():
                    split.setdefault((group[p], k), []).append(p)
                # more extensions come higher; each new group goes directly above its old one
                moves = [(h, k, ps) for (h, k), ps in sorted(split.items(), reverse=True)]
            for h, k, ps in moves:
                if live[h] == len(ps):
                    size[h] += k * length   # all that is left of it: it stays in place
                    continue
                live[h] -= len(ps)
                new = len(members)
                members.append(ps)
                live.append(len(ps))
                size.append(size[h] + k * length)
                below.append(h)
                up = above[h]
                above.append(up)
                if up >= 0:
                    below[up] = new
                above[h] = new
                for p in ps:
                    group[p] = new
        top = below[top]

    start = {}
    at = 0
    ends = [0] * n                      # where each position's Lyndon prefix ends
    for g, part in reversed(gone):
        start[g] = at
        at += len(part)
        length = size[g]
        for i in part:
            ends[i] = i + length
    ends_array = np.asarray(ends)
    by_end = np.argsort(ends_array, kind="stable")
    first = np.searchsorted(ends_array[by_end], np.arange(n + 2)).tolist()
    by_end = by_end.tolist()
    out = [0] * n
    for j in by_end[first[n]:first[n + 1]]:
        g = group[j]
        out[start[g]] = j
        start[g] += 1
    for i in range(n):
        s = out[i]
        for j in by_end[first[s]:first[s + 1]]:
            g = group[j]
            out[start[g]] = j
            start[g] += 1
    return np.asarray(out, dtype=np.int64)

