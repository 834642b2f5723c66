"""Suffix sorting with prefix hashes.

A prefix polynomial hash (modulo 2**64) gives the hash of any span at once, so a binary search over
lengths finds how far two suffixes agree.  A mergesort over suffixes with that comparison orders
groups of suffixes, all groups at a time in numpy.  Orders and extents found by hash are checked
on the bytes; where a collision shows, the group is done again by plain comparison."""

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Hashed:
    """A text of bytes with its prefix hashes."""

    def __init__(self, raw):
        self.raw = raw
        n = len(raw)
        with np.errstate(over="ignore"):
            power = np.full(n + 1, BASE)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            self.down = np.full(n + 1, BASE_INVERSE)
            self.down[0] = 1
            np.multiply.accumulate(self.down, out=self.down)
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.prefix[1:])

    def span(self, start, length):
        """Hashes of spans, equal for equal spans wherever they are."""
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def agreement(self, a, b, most, back=False):
        """How many bytes agree from places a and b on (or, ``back``, before them), at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) >> 1
            x, y = a[open_], b[open_]
            if back:
                x, y = x - middle, y - middle
            same = self.span(x, middle) == self.span(y, middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)


def merge_sorted(text, place, room, first, size, back=False):
    """The order of suffixes within groups.

    Suffix i starts at ``place[i]`` and has ``room[i]`` bytes (before the place, read backwards, with
    ``back``).  Groups are runs of suffixes: ``first[g]``, ``size[g]``.  A prefix of another suffix comes
    before it; equal suffixes stay in their order."""
    order = np.arange(len(place))
    group = np.repeat(np.arange(len(size)), size)
    inside = order - first[group]
    width = 1
    while width < (size.max() if len(size) else 0):
        run = inside // width
        sibling = (run ^ 1) * width
        other = np.minimum(width, size[group] - sibling)
        active = np.flatnonzero(other > 0)
        g, mine, s = first[group[active]], order[active], sibling[active]
        earlier = (run[active] & 1) == 0
        low, high = np.zeros(len(active), np.int64), other[active].copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            a, b = mine[open_], order[g[open_] + s[open_] + middle]
            most = np.minimum(room[a], room[b])
            same = text.agreement(place[a], place[b], most, back)
            ended = same == most
            step = -1 - same if back else same
            last = len(text.raw) - 1
            x = text.raw[np.clip(place[a] + step, 0, last)]
            y = text.raw[np.clip(place[b] + step, 0, last)]
            less = np.where(ended, room[b] < room[a], y < x)  # b before a
            tie = ended & (room[a] == room[b])
            goes = less | (tie & ~earlier[open_])
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        to = order.copy()
        pair = (run[active] & ~1) * width
        to[g + pair + (inside[active] - run[active] * width) + low] = mine
        order = to
        width *= 2
    return order
