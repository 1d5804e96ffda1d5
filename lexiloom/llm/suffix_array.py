"""Suffix arrays in linear time by grouping.

Suffixes are first sorted into groups by their longest Lyndon prefix, then each
group is put in order; nothing is renamed and nothing recurses.

First phase: groups start as the first symbols and are taken from the largest
down. Every member points to the nearest earlier suffix of a smaller group. The
suffixes pointed at are extended by the group's prefix: those that were pointed
at more often, and those with larger prefixes, move to new groups just above
their old ones. Second phase: in ascending order, a suffix whose place is known
places the suffixes that end, with their Lyndon prefix, where it begins.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of non-negative ``symbols`` in ascending order."""
    text = np.append(np.asarray(symbols, np.int64) + 1, 0)  # a smallest symbol of its own at the end
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.flatnonzero(np.diff(text[order], prepend=-1))  # where each group begins in the order
    sizes = np.diff(np.append(first, n))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, sizes)
    last = np.zeros(n, np.int64)
    last[first] = first + sizes - 1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sa, group, last, place = order.tolist(), group.tolist(), last.tolist(), place.tolist()
    smaller = _group_suffixes(n, sa, group, last, place)
    return np.array(_order_groups(n, sa, group, smaller)[1:], np.int64)


def _group_suffixes(n: int, sa: list, group: list, last: list, place: list) -> list:
    """First phase, in place. A group is the range of ``sa`` from its name ``g`` to
    ``last[g]``; returns each suffix's pointer to an earlier one of a smaller group."""
    smaller = [-1] * n
    jump = [-1] * n  # the same pointers, shortened as groups below them are reached
    high = n - 1
    while high > 0:
        g = group[sa[high]]
        members = sa[g : high + 1]
        if high > g:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            p = i - 1
            if p >= 0 and group[p] >= g:
                walked = []
                while p >= 0 and group[p] >= g:
                    walked.append(p)
                    p = jump[p]
                if len(walked) > 1:
                    for q in walked:
                        jump[q] = p
            smaller[i] = jump[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            if len(pointed) == 1 or max(pointed.values()) == 1:
                _raise(list(pointed), sa, group, last, place)
            else:
                by_count: dict[int, list] = {}
                for p, count in pointed.items():
                    by_count.setdefault(count, []).append(p)
                for count in sorted(by_count, reverse=True):
                    _raise(by_count[count], sa, group, last, place)
        high = g - 1
    return smaller


def _raise(chosen: list, sa: list, group: list, last: list, place: list) -> None:
    """Move the chosen suffixes of every group to a new group just above it."""
    if len(chosen) == 1:
        p = chosen[0]
        g = group[p]
        end = last[g]
        if end > g:
            other, at = sa[end], place[p]
            sa[at], place[other] = other, at
            sa[end], place[p] = p, end
            group[p] = last[end] = end
            last[g] = end - 1
        return
    moved: dict[int, list] = {}
    for p in chosen:
        moved.setdefault(group[p], []).append(p)
    for g, own in moved.items():
        end = last[g]
        start = end - len(own) + 1
        if start == g:
            continue  # the whole group: its place among the others stays
        at = end
        for p in own:
            other, was = sa[at], place[p]
            sa[was], place[other] = other, was
            sa[at], place[p] = p, at
            group[p] = start
            at -= 1
        last[start] = end
        last[g] = start - 1


def _order_groups(n: int, sa: list, group: list, smaller: list) -> list:
    """Second phase: ``sa`` in its final order."""
    free = list(range(n))  # next free place of each group
    placed = bytearray(n)
    sa[0] = n - 1
    for i in range(n):
        j = sa[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            sa[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = smaller[j]
    return sa
