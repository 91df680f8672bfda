"""Suffix arrays by grouping (Lyndon-prefix groups), and common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of a sequence of integers in ascending order.

    Phase 1: suffixes begin in groups of equal first symbol. Groups are taken
    in descending order. Each member points to the nearest place before it that
    is still in a lower group (its previous smaller one, found by path halving
    over the places already taken). A place that k members of the group point to
    is followed by the group's prefix k times, so the places of equal k leave
    their groups for new ones right above these, the largest k highest. In the
    end each group holds the suffixes of one Lyndon prefix.

    Phase 2: in ascending order every placed suffix emits the one before it and
    on along the pointers, each to the next free place of its group, up to one
    that has its place. Nothing is renamed and sorted again."""
    n = len(symbols)
    members: list[list[int]] = []
    below: list[int] = []  # next lower group
    by_symbol: dict[int, int] = {}
    for s in sorted(set(symbols)):
        by_symbol[s] = len(members)
        below.append(len(members) - 1)
        members.append([])
    group = [by_symbol[s] for s in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    taken = list(range(-1, n))  # taken[i + 1]: the nearest free place at or before i, once taken
    pointer = [-1] * n
    above = [*range(1, len(members)), -1]
    now, order = len(members) - 1, []
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        order.append((now, len(own)))
        for i in own:
            taken[i + 1] = i - 1
        count: dict[int, int] = {}
        for i in own:
            at = i - 1
            while True:  # the nearest place at or before i - 1 that is not taken
                to = taken[at + 1]
                if to == at:
                    break
                beyond = taken[to + 1]
                taken[at + 1] = beyond
                at = beyond
            pointer[i] = at
            if at >= 0:
                count[at] = count.get(at, 0) + 1
        if count:
            times: dict[int, list[int]] = {}
            for p, k in count.items():
                times.setdefault(k, []).append(p)
            for k in sorted(times, reverse=True):
                fresh: dict[int, int] = {}
                for p in times[k]:
                    old = group[p]
                    g = fresh.get(old)
                    if g is None:
                        g = fresh[old] = len(members)
                        members.append([])
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = g
                        if up >= 0:
                            below[up] = g
                    group[p] = g
                    members[g].append(p)
        now = below[now]
    free = [0] * len(members)
    at = 1  # place 0 is the empty suffix
    for g, size in reversed(order):
        free[g] = at
        at += size
    out = [n] + [-1] * n
    placed = [False] * (n + 1)
    for k in range(n + 1):
        i = out[k] - 1
        while i >= 0 and not placed[i]:
            placed[i] = True
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            i = pointer[i]
    return out[1:]


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """Symbols that each suffix of ``order`` shares with the one before it."""
    n = len(symbols)
    before = [-1] * n
    for a, b in zip(order, order[1:], strict=False):
        before[b] = a
    shared = [0] * n
    length = 0
    for i in range(n):
        j = before[i]
        if j < 0:
            length = 0
            continue
        while i + length < n and j + length < n and symbols[i + length] == symbols[j + length]:
            length += 1
        shared[i] = length
        if length:
            length -= 1
    return [shared[i] for i in order]


class RangeMinimum:
    """Minimum of any range of an array, after n log n preparation."""

    def __init__(self, values: np.ndarray) -> None:
        self.level = [np.asarray(values, np.int32)]
        while 2 << (len(self.level) - 1) <= len(values):
            last, step = self.level[-1], 1 << (len(self.level) - 1)
            self.level.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of values[lo:hi]; ranges are not empty."""
        depth = np.log2(hi - lo).astype(np.int64)
        out = np.zeros(len(lo), np.int32)
        for d in np.unique(depth):
            own = depth == d
            out[own] = np.minimum(self.level[d][lo[own]], self.level[d][hi[own] - (1 << int(d))])
        return out
