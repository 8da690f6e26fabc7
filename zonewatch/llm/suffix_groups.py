"""Suffix arrays of many small collections of strings at once, by linear grouping.

A collection holds strings over 1.., each closed by a 0 of its own; the zeros of a collection are smaller than all
else, in the order of their places. Nothing spans two strings, since a Lyndon word cannot hold a smaller letter
than its first.

1. Suffixes are grouped by first letter, then the groups are processed from the highest down. For each suffix of a
   group its previous smaller suffix is found, the last place before it whose group is lower; the pointers of
   higher groups lead there. Suffixes pointed at move to new groups right behind what is left of their own, by how often
   they are pointed at: their Lyndon prefix has grown by that of the group. In the end a group holds the suffixes
   with one Lyndon prefix, and groups are in order.
2. From the lowest suffix up, each suffix fixes the next places in their groups of those whose Lyndon prefix ends
   where it begins. All suffixes of a group that have their places are taken at once, in their order.

Groups are intervals of the array named by their first place, and members change places inside an interval, so nothing
is renamed or sorted again. The collections take their steps side by side, one group of each at a time; what many
strings of a collection have in common is one group.
"""

from __future__ import annotations

import numpy as np


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class Groups:
    """The suffix groups of ``text``; collection k is text[bounds[k]:bounds[k + 1]]. text[0] is a 0 before the first."""

    def __init__(self, text: np.ndarray, bounds: np.ndarray):
        n = len(text)
        self.text, self.bounds = text, bounds
        owner = np.repeat(np.arange(len(bounds)), np.diff(np.concatenate([[0], bounds])))
        self.slot = _sorted(owner, text)
        letter = owner * (int(text.max()) + 1) + text
        self.place = np.empty(n, np.int64)
        self.place[self.slot] = np.arange(n)
        first = runs(letter[self.slot])
        self.end = np.zeros(n, np.int64)
        self.end[first] = np.append(first[1:], n)
        self.group = np.empty(n, np.int64)
        self.group[self.slot] = np.repeat(first, self.end[first] - first)
        self.before = np.arange(n) - 1
        self.pointed = np.zeros(n, bool)
        #: Lengths of the Lyndon prefixes as far as they are known.
        self.size = np.ones(n, np.int64)

    def refine(self) -> None:
        top = self.bounds[1:].copy()
        top = top[top > self.bounds[:-1]]
        while True:
            highest = self.slot[top - 1]
            live = self.text[highest] != 0
            top, highest = top[live], highest[live]
            if not len(top):
                return
            start = self.group[highest]
            self._process(start, top - start)
            top = start

    def _process(self, start: np.ndarray, members: np.ndarray) -> None:
        """The groups that begin at ``start``, one of each collection."""
        group = self.group
        at = self.slot[ragged(start, members)]
        own = np.repeat(start, members)
        cur = at - 1
        todo = np.flatnonzero(group[cur] >= own)
        while len(todo):
            there = self.before[cur[todo]]
            cur[todo] = there
            todo = todo[group[there] >= own[todo]]
        self.before[at] = cur
        cur = cur[self.text[cur] != 0]
        if not len(cur):
            return
        cur = np.sort(cur)
        first = runs(cur)
        moved, times = cur[first], np.diff(np.append(first, len(cur)))
        home = group[moved]
        if times.max() > 1:
            order = np.lexsort((times, home))
            moved, times, home = moved[order], times[order], home[order]
        elif (home[1:] < home[:-1]).any():
            order = np.argsort(home, kind="stable")
            moved, home = moved[order], home[order]
        # all that point at one suffix have one Lyndon prefix
        self.size[moved] += times * self.size[self.next_of(moved)]
        head = runs(home)
        count = np.diff(np.append(head, len(home)))
        homes = home[head]
        back = self.end[homes] - count  # the moved ones go to the back of their interval
        target = ragged(back, count)
        self.pointed[moved] = True
        there = self.slot[target]
        there = there[~self.pointed[there]]
        self.pointed[moved] = False
        if len(there):
            holes = self.place[moved]
            holes = holes[holes < np.repeat(back, count)]
            self.slot[holes], self.place[there] = there, holes
        self.slot[target], self.place[moved] = moved, target
        new = runs(home, times)
        begin, size = target[new], np.diff(np.append(new, len(home)))
        group[moved] = np.repeat(begin, size)
        left = back > homes
        self.end[homes[left]] = back[left]
        self.end[begin] = begin + size

    def next_of(self, at: np.ndarray) -> np.ndarray:
        """Where the Lyndon prefixes known so far end; what follows there points at its suffix next."""
        return at + self.size[at]

    def emit(self) -> np.ndarray:
        """The suffix array: collection k's suffixes in order at [bounds[k], bounds[k + 1])."""
        n = len(self.text)
        out = np.zeros(n, np.int64)
        zero = self.text == 0
        zeros, others = np.flatnonzero(zero), np.flatnonzero(~zero)
        group = self.group[zeros]
        first = runs(group)
        out[ragged(group[first], np.diff(np.append(first, len(group))))] = zeros
        # those whose prefix ends at a place, by place
        follows = self.next_of(others)
        behind = others[np.argsort(follows, kind="stable")]
        many = np.bincount(follows, minlength=n)
        begin = np.cumsum(many) - many
        free = np.arange(n)
        free[group[first]] = self.end[group[first]]
        at, end = self.bounds[:-1].copy(), self.bounds[1:]
        while True:
            live = at < end
            at, end = at[live], end[live]
            if not len(at):
                return out
            # the places of the present group that are taken
            to = free[self.group[out[at]]]
            popped = out[ragged(at, to - at)]
            at = to
            cur = behind[ragged(begin[popped], many[popped])]
            if len(cur):
                home = self.group[cur]
                if (home[1:] < home[:-1]).any():
                    order = np.argsort(home, kind="stable")
                    cur, home = cur[order], home[order]
                first = runs(home)
                count = np.diff(np.append(first, len(home)))
                own = home[first]
                out[ragged(free[own], count)] = cur
                free[own] += count


def _sorted(owner: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places by owner, then letter; owners are in order already."""
    order = np.argsort(text.astype(np.uint16), kind="stable")
    if owner[-1] < 1 << 16:
        return order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    return order[np.argsort(owner[order], kind="stable")]


def suffix_array(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    groups = Groups(text, bounds)
    groups.refine()
    return groups.emit()
