"""Suffix sorting by grouping Lyndon prefixes, and longest earlier matches."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """The suffixes of a sequence of non-negative integers in order, in linear time.

    Phase 1 puts suffixes into ordered groups that end up holding equal longest
    Lyndon prefixes. Groups are taken from the highest down; each suffix of a
    group extends the prefix of its previous smaller suffix, found by pointers
    that skip what has been taken; suffixes extended by more copies move to
    higher new groups above their old one. Phase 2 fills the groups from left
    to right: a suffix's place within its group follows from the suffix after
    its Lyndon prefix, which is smaller and so already placed.
    """
    n = len(symbols)
    if n == 0:
        return []
    order = np.argsort(symbols, kind="stable")
    first = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    numbers = np.cumsum(first) - 1
    group_np = np.empty(n, dtype=np.int64)
    group_np[order] = numbers
    group: list[int] = group_np.tolist()
    members: list[list[int]] = [part.tolist() for part in np.split(order, np.nonzero(first)[0][1:])]
    # The groups as a linked list; every group that gets new ones above it lies below the current one.
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    skip = list(range(-1, n - 1))  # nearest candidate to the left; taken ones are skipped
    taken = bytearray(n)
    end = list(range(1, n + 1))  # where the prefix found so far ends
    top = len(members) - 1
    descending: list[list[int]] = []
    while top >= 0:
        current = [i for i in members[top] if group[i] == top]
        if current:
            for i in current:
                taken[i] = 1
            extended: dict[int, list[int]] = {}
            for i in current:
                p = skip[i]
                while p >= 0 and taken[p]:
                    q = skip[p]
                    if q >= 0 and taken[q]:
                        skip[p] = skip[q]  # halve the path
                    p = q
                skip[i] = p
                if p >= 0:
                    found = extended.get(p)
                    if found is None:
                        extended[p] = [1, end[i]]
                    else:
                        found[0] += 1
                        if end[i] > found[1]:
                            found[1] = end[i]
            moves: dict[int, dict[int, list[int]]] = {}
            for p, (copies, stop) in extended.items():
                end[p] = stop
                moves.setdefault(group[p], {}).setdefault(copies, []).append(p)
            descending.append(current)
            for old, by_copies in moves.items():
                upper, beneath = above[old], old
                for copies in sorted(by_copies):
                    new = len(members)
                    members.append(by_copies[copies])
                    below.append(beneath)
                    above.append(upper)
                    above[beneath] = new
                    for p in by_copies[copies]:
                        group[p] = new
                    beneath = new
                below[upper] = beneath
        top = below[top]
    return _emit(descending, end, n)


def _emit(descending: list[list[int]], end: list[int], n: int) -> list[int]:
    """Place every suffix in its group, by the place of the suffix after its prefix."""
    slot = [0] * n
    free: list[int] = []
    at = 0
    for number, current in enumerate(reversed(descending)):
        free.append(at)
        at += len(current)
        for i in current:
            slot[i] = number
    waiting = [-1] * (n + 1)
    after = [-1] * n
    for i in range(n):
        e = end[i]
        after[i] = waiting[e]
        waiting[e] = i
    placed = [0] * n
    k, e = 0, n
    while True:
        i = waiting[e]
        while i >= 0:
            g = slot[i]
            placed[free[g]] = i
            free[g] += 1
            i = after[i]
        if k == n:
            return placed
        e = placed[k]
        k += 1


def longest_earlier_match(symbols: np.ndarray, block: np.ndarray | None = None) -> list[int]:
    """For each position, the length of the longest match that starts at an earlier position.

    With ``block``, a number per position that never falls, only positions of
    smaller blocks are earlier.
    """
    text: list[int] = symbols.tolist()
    n = len(text)
    order = suffix_array(symbols)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    # Common prefix of each suffix with the one before it in order.
    common = [0] * (n + 1)
    h = 0
    for i in range(n):
        r = rank[i]
        if r == 0:
            h = 0
            continue
        j = order[r - 1]
        limit = n - (i if i > j else j)
        while h < limit and text[i + h] == text[j + h]:
            h += 1
        common[r] = h
        if h:
            h -= 1
    # Take positions from the last to the first; what is left are earlier positions.
    before, after = list(range(-1, n)), list(range(1, n + 2))
    longest = [0] * n

    def take(i: int) -> tuple[int, int, int, int]:
        """Neighbours of the suffix among those left, and what it shares with them; it goes."""
        r = rank[i]
        up, down = before[r], after[r]
        x, y = common[r], common[down] if down <= n else 0
        if down <= n:
            common[down] = x if x < common[down] else common[down]
            before[down] = up
        if up >= 0:
            after[up] = down
        return up, x, down, y

    if block is None:
        for i in range(n - 1, -1, -1):
            _, x, _, y = take(i)
            longest[i] = x if x > y else y
        return longest
    numbers = block.tolist()
    stop = n
    while stop:
        first = stop - 1
        while first and numbers[first - 1] == numbers[stop - 1]:
            first -= 1
        taken = [(i, *take(i)) for i in range(stop - 1, first - 1, -1)]
        # A neighbour of the same block went later: what lies behind it is known before.
        above: dict[int, int] = {}
        beneath: dict[int, int] = {}
        for i, up, x, down, y in reversed(taken):
            x, y = min(x, above.get(up, x)), min(y, beneath.get(down, y))
            above[rank[i]], beneath[rank[i]] = x, y
            longest[i] = max(x, y)
        stop = first
    return longest
