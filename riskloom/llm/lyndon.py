"""Linear suffix grouping, for many small texts side by side.

A problem is a set of texts whose suffixes are sorted together. A suffix belongs to the
group of its Lyndon prefix, the text up to its next smaller suffix. Groups of a problem
are finalised from the highest to the lowest. When a group with context u is, the
previous smaller suffix of each member (the nearest not yet final one to its left) is
looked up; where m members share that pointer, its own context grows by m copies of u, and
it moves to a new group right above those of its old group that did not grow, by m. A
suffix is touched once for each of its children, so the work is linear and nothing is
renamed and sorted again. Then groups are emitted from the lowest to the highest: members
are ordered by how often their context repeats and by the place of the suffix that
follows, which is smaller and so has its place already.

Each step handles the next group of every problem at once.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def suffix_order(texts: list[bytes], problem: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, data, begins): the places of ``data`` by problem and suffix order.

    ``problem`` numbers the problem of each text, ascending. ``data`` joins the texts, a
    separator of 0 before each and after the last; other bytes are raised by one.
    Suffixes end at the separator, which is below all bytes; equal suffixes are neighbours.
    Separators come first within their problem.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum()) + len(texts) + 1
    begins = np.cumsum(sizes + 1) - sizes
    data = np.zeros(total, np.int16)
    if len(texts):
        data[_ranges(begins, sizes)] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    owner = np.zeros(total, np.int64)
    if len(texts):
        owner[:-1] = np.repeat(problem, sizes + 1)
        owner[-1] = problem[-1] + 1  # the last separator is a problem of its own
    order = np.argsort(owner * 512 + data, kind="stable")
    where = np.empty(total, np.int64)
    where[order] = np.arange(total)
    level = (owner * 512 + data)[order]
    fresh = np.ones(total, bool)
    fresh[1:] = level[1:] != level[:-1]
    starts = np.flatnonzero(fresh)
    count = np.diff(np.append(starts, total))
    group = np.empty(total, np.int64)
    group[order] = np.repeat(starts, count)
    size = np.zeros(total + 1, np.int64)
    size[starts] = count
    length = np.ones(total, np.int64)
    _group(order, where, group, size, length, data, owner)
    _emit(order, group, size, length, data, owner)
    return order, data, begins


def _group(order, where, group, size, length, data, owner) -> None:
    total = len(order)
    left = np.arange(total)  # itself while not final, else something further left
    mark = np.zeros(total, bool)
    bounds = np.flatnonzero(np.diff(owner[order])) + 1
    first = np.concatenate([[0], bounds])
    top = np.append(bounds, total)
    floor = first + size[first]  # the separators are the lowest group and never final
    while True:
        live = top > floor
        if not live.all():
            top, floor = top[live], floor[live]
            if not len(top):
                return
        start = group[order[top - 1]]
        n = top - start
        top = start
        member = order[_ranges(start, n)]
        left[member] = member - 1
        at = left[member - 1]
        while True:
            further = left[at]
            if (further == at).all():
                break
            at = left[further]
        left[member] = at
        inside = data[at] != 0
        if not inside.all():
            at, member = at[inside], member[inside]
            if not len(at):
                continue
        # m members on a pointer: m copies of the context
        by = np.argsort(at, kind="stable")
        at, member = at[by], member[by]
        head = np.ones(len(at), bool)
        head[1:] = at[1:] != at[:-1]
        heads = np.flatnonzero(head)
        grown, child = at[heads], member[heads]
        copies = np.diff(np.append(heads, len(at)))
        length[grown] += copies * length[child]
        old = group[grown]
        by = np.lexsort((copies, old))
        grown, copies, old = grown[by], copies[by], old[by]
        head = np.ones(len(old), bool)
        head[1:] = old[1:] != old[:-1]
        heads = np.flatnonzero(head)
        moved = np.diff(np.append(heads, len(old)))
        base = old[heads] + size[old[heads]] - moved
        target = _ranges(base, moved)
        # those in the way take the places that the moving ones leave
        mark[grown] = True
        sitting = order[target]
        sitting = sitting[~mark[sitting]]
        mark[grown] = False
        place = where[grown]
        vacated = place[place < np.repeat(base, moved)]
        order[vacated] = sitting
        where[sitting] = vacated
        order[target] = grown
        where[grown] = target
        size[old[heads]] -= moved
        head[1:] |= copies[1:] != copies[:-1]
        heads = np.flatnonzero(head)
        runs = np.diff(np.append(heads, len(old)))
        group[grown] = np.repeat(target[heads], runs)
        size[target[heads]] = runs


def _emit(order, group, size, length, data, owner) -> None:
    total = len(order)
    rank = np.empty(total, np.int64)
    rank[order] = np.arange(total)
    rank[data == 0] = -1
    starts = np.flatnonzero(size[:total] > 1)
    starts = starts[(group[order[starts]] == starts) & (data[order[starts]] != 0)]
    if not len(starts):
        return
    whose = owner[order[starts]]
    # the k-th group of every problem is emitted in step k
    new = np.ones(len(starts), bool)
    new[1:] = whose[1:] != whose[:-1]
    base = np.flatnonzero(new)
    step = np.arange(len(starts)) - np.repeat(base, np.diff(np.append(base, len(starts))))
    by = np.argsort(step, kind="stable")
    cuts = np.flatnonzero(np.diff(step[by])) + 1
    for some in np.split(starts[by], cuts):
        some = np.sort(some)
        n = size[some]
        slots = _ranges(some, n)
        member = order[slots]
        after = member + length[member]
        times = np.zeros(len(member), np.int64)
        again = np.flatnonzero(group[after] == group[member])
        while len(again):
            times[again] += 1
            after[again] += length[member[again]]
            again = again[group[after[again]] == group[member[again]]]
        by = np.lexsort((rank[after], times, np.repeat(some, n)))
        order[slots] = member[by]
        rank[order[slots]] = slots
