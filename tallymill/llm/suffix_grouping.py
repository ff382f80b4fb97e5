"""Suffix sorting by grouping, without renaming the symbols. All steps are linear but for
sorting the first symbols, and the places of a group's members, by the language's own sort.

First phase: suffixes are grouped by their first symbol, then the groups are
processed in descending order. When a group is processed, each of its suffixes
finds its previous smaller one by following the pointers of greater suffixes; the
suffixes found share a longer prefix from now on and move, together with those of
their group that were found equally often, into a group of their own right behind
the rest. In the end a group holds the suffixes with the same longest Lyndon prefix.

Second phase: suffixes are emitted in ascending order. Each one emitted lets the
suffixes that it is the next smaller one of take the next places of their groups;
these are found along the pointers to previous smaller suffixes.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of ``symbols`` (integers) in ascending order."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    group, previous = _lyndon_groups(symbols)
    return np.array(_emitted(group, previous), np.int64)


def _lyndon_groups(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """For each suffix, where its group starts in the suffix array, and the previous smaller suffix or -1."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    first = np.flatnonzero(np.r_[True, sorted_symbols[1:] != sorted_symbols[:-1]])
    counts = np.diff(np.r_[first, n])
    start_of = np.empty(n, np.int64)
    start_of[order] = np.repeat(first, counts)
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    size_at = np.zeros(n, np.int64)
    size_at[first] = counts
    members, group, place, size = order.tolist(), start_of.tolist(), place_of.tolist(), size_at.tolist()
    previous = [-1] * n

    end = n
    while end:
        start = group[members[end - 1]]
        if start == end - 1:
            suffix = members[start]
            p = suffix - 1
            while p >= 0 and group[p] > start:
                p = previous[p]
            previous[suffix] = p
            if p >= 0:
                old = group[p]
                left = size[old] - 1
                if left:
                    last = old + left
                    at, other = place[p], members[last]
                    members[at], place[other] = other, at
                    members[last], place[p] = p, last
                    size[old], size[last], group[p] = left, 1, last
        else:
            times: dict[int, int] = {}
            for suffix in sorted(members[start:end]):
                p = suffix - 1
                while p >= 0 and group[p] > start:
                    p = previous[p]
                if p >= 0 and group[p] == start:
                    p = previous[p]
                previous[suffix] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            if not times:
                end = start
                continue
            if max(times.values()) == 1:
                rounds = [list(times)]
            else:
                by_times: dict[int, list[int]] = {}
                for p, n_times in times.items():
                    by_times.setdefault(n_times, []).append(p)
                rounds = [by_times[n_times] for n_times in sorted(by_times, reverse=True)]
            for found in rounds:
                together: dict[int, list[int]] = {}
                for p in found:
                    old = group[p]
                    if size[old] > 1:  # a suffix alone in its group stays where it is
                        if old in together:
                            together[old].append(p)
                        else:
                            together[old] = [p]
                for old, moved in together.items():
                    left = size[old] - len(moved)
                    if left:
                        tail = old + size[old]
                        for p in moved:
                            tail -= 1
                            at, other = place[p], members[tail]
                            members[at], place[other] = other, at
                            members[tail], place[p] = p, tail
                            group[p] = old + left
                        size[old], size[tail] = left, len(moved)
        end = start
    return group, previous


def _emitted(group: list[int], previous: list[int]) -> list[int]:
    n = len(group)
    result, free, done = [-1] * n, list(range(n)), bytearray(n)
    rank = -1
    while rank < n:
        # Position n, the empty suffix, comes first.
        p = n - 1 if rank < 0 else result[rank] - 1
        while p >= 0 and not done[p]:
            done[p] = 1
            at = group[p]
            result[free[at]] = p
            free[at] += 1
            p = previous[p]
        rank += 1
    return result
