"""Suffix arrays in linear time by grouping suffixes with equal Lyndon prefixes."""

from __future__ import annotations

from itertools import groupby


def _group(text: list[int]) -> tuple[list[int], list[int]]:
    """First place of each suffix's final group, and the previous smaller suffix of each.

    Groups start from first symbols and are processed from the highest down. A
    member's previous smaller suffix is the nearest before it in a lower group;
    such a suffix goes on, after what it shares with its own group, with the
    members that point to it, so among its group those pointed to most often
    come last, each number of pointers a group of its own.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, start, size, previous = [0] * n, [0] * n, [0] * n, [-1] * n
    first = 0
    for at, suffix in enumerate(order):
        if text[suffix] != text[order[first]]:
            first = at
        place[suffix], start[suffix] = at, first
        size[first] += 1

    high = n - 1
    while high >= 0:
        low = start[order[high]]
        members = order[low : high + 1]
        members.sort()
        pointers: dict[int, int] = {}
        for suffix in members:
            before = suffix - 1
            while before >= 0 and start[before] >= low:
                before = previous[before]
            previous[suffix] = before
            if before >= 0:
                pointers[before] = pointers.get(before, 0) + 1
        high = low - 1
        if len(pointers) == 1:
            moves = [(start[s], k, s) for s, k in pointers.items()]
        else:
            moves = sorted(((start[s], k, s) for s, k in pointers.items()), reverse=True)
        for (group, _), same in groupby(moves, key=lambda move: move[:2]):
            end = group + size[group]
            count = 0
            for _, _, suffix in same:
                count += 1
                here, there = place[suffix], end - count
                other = order[there]
                order[here], order[there] = other, suffix
                place[other], place[suffix] = here, there
            fresh = end - count
            if fresh != group:
                size[group] -= count
                size[fresh] = count
                for at in range(fresh, end):
                    start[order[at]] = fresh
    return start, previous


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in order.

    The last symbol must be less than all others and come once. After grouping,
    each suffix in turn gives the one before it, and then along previous
    smaller suffixes, the next place of its group; no symbols are renamed.
    """
    n = len(text)
    if not n:
        return []
    if n > 1 and min(text[:-1]) <= text[-1]:
        raise ValueError("the last symbol must be the least and come once")
    start, previous = _group(text)
    following, placed, out = list(range(n)), bytearray(n), [0] * n
    out[0] = n - 1
    placed[n - 1] = 1
    for at in range(n):
        suffix = out[at] - 1
        while suffix >= 0 and not placed[suffix]:
            group = start[suffix]
            out[following[group]] = suffix
            following[group] += 1
            placed[suffix] = 1
            suffix = previous[suffix]
    return out


def neighbour_matches(text: list[int], suffixes: list[int]) -> list[int]:
    """For each start, the symbols its suffix shares with the nearer of its neighbours in order."""
    n = len(text)
    rank = [0] * n
    for at, suffix in enumerate(suffixes):
        rank[suffix] = at
    best, shared = [0] * n, 0
    for suffix in range(n):
        at = rank[suffix]
        if not at:
            shared = 0
            continue
        other = suffixes[at - 1]
        most = n - max(suffix, other)
        while shared < most and text[suffix + shared] == text[other + shared]:
            shared += 1
        if shared > best[suffix]:
            best[suffix] = shared
        if shared > best[other]:
            best[other] = shared
        if shared:
            shared -= 1
    return best
