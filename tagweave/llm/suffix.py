"""Suffix arrays of many short texts at once, by grouping suffixes by their Lyndon prefix.

Phase 1 starts from groups by first symbol and handles the groups of a text in
descending order. For every suffix of the group at hand it follows pointers to
the previous suffix of a lower group; that suffix's Lyndon prefix goes on with
the group's, once for each suffix that points to it. So the suffixes pointed to
move to the end of their own groups, the more often the further up, as groups of
their own. Phase 2 walks the finished order from below: each suffix it meets puts
the suffix before it, and those its pointers lead to, into the next free places
of their groups. Nothing is renamed and there is no recursion.

The texts are independent and advance together, one group (then one place) each
at a time, so that every step is a few array operations over all of them.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the half-open ranges, one range after the other."""
    sizes = ends - starts
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return np.arange(sizes.sum()) + shift


def suffix_arrays(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffixes of each text in order, as places in ``symbols``, text after text.

    Text ``k`` is ``symbols[starts[k]:starts[k + 1]]``; ``starts`` ends with the
    total length. The last symbol of each text must be its smallest and occur only
    there; symbols are numbers from 0.
    """
    texts, total = len(starts) - 1, int(starts[-1])
    if not total:
        return np.zeros(0, np.int64)
    sizes = np.diff(starts)
    # A place before each text, in no group, ends the pointers of that text.
    low = starts[:-1] + np.arange(texts)
    n = total + texts
    own = np.ones(n, bool)
    own[low] = False
    places = np.flatnonzero(own)
    text_of = np.repeat(np.arange(texts), sizes)
    key = text_of * (int(symbols.max()) + 1) + symbols
    by_key = np.argsort(key, kind="stable")
    order = np.zeros(n, np.int64)  # slots share the numbering of places
    order[places] = places[by_key]
    at = np.zeros(n, np.int64)
    at[order[places]] = places
    new = np.concatenate(([True], key[by_key][1:] != key[by_key][:-1]))
    first = places[new]
    group = np.full(n, -1, np.int64)  # the first slot of a suffix's group
    group[order[places]] = np.repeat(first, np.diff(np.concatenate((np.flatnonzero(new), [total]))))
    size = np.zeros(n, np.int64)
    size[first] = np.diff(np.concatenate((np.flatnonzero(new), [total])))
    back = np.arange(n) - 1
    marked = np.zeros(n, bool)

    begin, end = low + 1, low + 1 + sizes
    while len(end):
        top = group[order[end - 1]]
        slots = _ranges(top, end)
        members, level = order[slots], np.repeat(top, end - top)
        # Previous suffix of a lower group: those passed have pointers already, or share this group.
        to = back[members]
        todo = np.flatnonzero(group[to] >= level)
        while len(todo):
            to[todo] = back[to[todo]]
            todo = todo[group[to[todo]] >= level[todo]]
        back[members] = to
        to = to[group[to] >= 0]
        if len(to):
            found, times = np.unique(to, return_counts=True)
            old = group[found]
            by = np.lexsort((times, old))
            found, times, old = found[by], times[by], old[by]
            heads = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            moved = np.diff(np.concatenate((heads, [len(old)])))
            groups = old[heads]
            tails = groups + size[groups] - moved
            target = _ranges(tails, tails + moved)
            marked[found] = True
            there = order[target]
            leaving = there[~marked[there]]
            vacated = at[found][at[found] < np.repeat(tails, moved)]
            marked[found] = False
            order[vacated], at[leaving] = leaving, vacated
            order[target], at[found] = found, target
            starts_new = np.concatenate(([True], (old[1:] != old[:-1]) | (times[1:] != times[:-1])))
            where = np.flatnonzero(starts_new)
            count = np.diff(np.concatenate((where, [len(old)])))
            size[groups] -= moved
            size[target[where]] = count
            group[found] = np.repeat(target[where], count)
        end = top
        left = end > begin
        end, begin = end[left], begin[left]

    # Phase 2: the last place of a text is its smallest suffix.
    result = np.zeros(n, np.int64)
    free = np.arange(n)
    placed = np.zeros(n, bool)
    placed[low] = True
    last = low + sizes
    result[low + 1] = last
    placed[last] = True
    slot, stop = low + 1, low + 1 + sizes
    while len(slot):
        to = result[slot] - 1
        to = to[~placed[to]]
        while len(to):
            here = group[to]
            result[free[here]] = to
            free[here] += 1
            placed[to] = True
            to = back[to]
            to = to[~placed[to]]
        slot = slot + 1
        left = slot < stop
        slot, stop = slot[left], stop[left]
    found = result[places]
    return found - np.repeat(np.arange(texts), sizes) - 1
