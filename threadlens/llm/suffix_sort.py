"""Suffix arrays by linear grouping.

Phase one groups suffixes by their longest Lyndon prefix.  Groups are taken in descending
order; the suffix before a member that lies in a lower group (found through pointers to
previous smaller suffixes) has its prefix extended by that of the member, once per member
that points at it, and moves to a new group right above its old one.  Phase two runs
through the suffixes in ascending order and places those whose Lyndon prefix ends where
the current suffix begins at the front of their groups.  Neither phase renames the text or
calls itself.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order; a prefix comes first."""
    low = min(text, default=0)
    symbols = [c - low + 1 for c in text]
    symbols.append(0)  # the sentinel below all others
    order = _emit(*_group(symbols))
    return order[1:]


def _group(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Phase one: (start of the group of every suffix, pointer to the previous smaller one)."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n
    start = [0] * n  # of the group of a suffix
    size = [0] * n  # of the group that starts here
    first, last = 0, None
    for at, i in enumerate(order):
        if symbols[i] != last:
            first, last = at, symbols[i]
        place[i] = at
        start[i] = first
        size[first] += 1
    previous = [-1] * n
    end = n
    while end:
        low = start[order[end - 1]]
        if end - low == 1:
            i = order[low]
            p = i - 1
            while p >= 0 and start[p] >= low:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                at = start[p]
                count = size[at]
                if count > 1:
                    _move(p, at, count, order, place)
                    size[at] = count - 1
                    at += count - 1
                    start[p] = at
                    size[at] = 1
        else:
            # in text order the pointers of earlier members are known to later ones
            votes: dict[int, int] = {}
            for i in sorted(order[low:end]):
                p = i - 1
                while p >= 0 and start[p] >= low:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    votes[p] = votes.get(p, 0) + 1
            split = defaultdict(list)
            for p, n_votes in votes.items():
                split[start[p], n_votes].append(p)
            # of one group, those with more votes go above those with fewer
            for at, n_votes in sorted(split, reverse=True):
                members = split[at, n_votes]
                count = size[at]
                for p in members:
                    _move(p, at, count, order, place)
                    count -= 1
                if count:
                    size[at] = count
                    at += count
                    for p in members:
                        start[p] = at
                    size[at] = len(members)
        end = low
    return start, previous


def _move(p: int, at: int, count: int, order: list[int], place: list[int]) -> None:
    """Swap suffix p to the end of its group, which starts at ``at`` and has ``count`` suffixes."""
    here, there = place[p], at + count - 1
    other = order[there]
    order[here], order[there] = other, p
    place[other], place[p] = here, there


def _emit(start: list[int], previous: list[int]) -> list[int]:
    """Phase two: the suffix array, the sentinel first."""
    n = len(start)
    order = [-1] * n
    front = list(range(n))  # next free place of the group that starts here
    done = bytearray(n)
    order[0] = n - 1
    done[n - 1] = 1
    for x in range(n):
        j = order[x] - 1
        while j >= 0 and not done[j]:
            at = start[j]
            order[front[at]] = j
            front[at] += 1
            done[j] = 1
            j = previous[j]
    return order
