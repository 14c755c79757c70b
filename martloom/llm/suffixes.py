"""Polynomial prefix hashes of bytes and a suffix sort that compares by them."""

from __future__ import annotations

import numpy as np

#: Bytes two suffixes are compared on; longer common starts count as equal.
SPAN = 50
#: Bytes of the grams that anchor a window of ``SPAN`` bytes.
GRAM = 16
#: Bytes of a suffix that are compared as one number before any hash is.
HEAD = 8
#: Windows whose keys are made at a time.
CHUNK = 1 << 18

_BASE = 0x5851F42D4C957F2D


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** i`` modulo ``2 ** 64`` for i below n."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_UP = powers(CHUNK + SPAN + 1)
_DOWN = powers(CHUNK + SPAN + 1, pow(_BASE, -1, 1 << 64))


def prefix_sums(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * base ** place`` over every prefix, the empty one first."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


def window_runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and keys of the runs of windows of ``SPAN`` bytes that share a key.

    The key of a window is the least mixed hash of the grams in it, so it depends on its bytes alone: equal windows have
    equal keys wherever they stand. Ends are those of the windows' first bytes, exclusive.
    """
    total = len(data) - SPAN + 1
    starts, keys = [], []
    octets = np.frombuffer(data, np.uint8)
    for at in range(0, max(total, 0), CHUNK):
        n = min(CHUNK, total - at)
        sums = prefix_sums(octets[at : at + n + SPAN - 1], _UP)
        grams = len(sums) - GRAM
        least = _mixed((sums[GRAM:] - sums[:-GRAM]) * _DOWN[:grams])
        width, wanted = 1, SPAN - GRAM + 1
        while width * 2 <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if wanted > width:
            least = np.minimum(least[: -(wanted - width)], least[wanted - width :])
        fresh = np.append(True, least[1:] != least[:-1])
        if keys and keys[-1][-1] == least[0]:
            fresh[0] = False
        if fresh.any():
            starts.append(np.flatnonzero(fresh) + at)
            keys.append(least[fresh])
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    begins = np.concatenate(starts)
    return begins, np.append(begins[1:], total), np.concatenate(keys)


class Suffixes:
    """Suffixes at ``places`` of ``buffer``, each with ``SPAN`` bytes to compare."""

    def __init__(self, buffer: bytes, places: np.ndarray):
        self.octets = np.frombuffer(buffer, np.uint8)
        self.places = places
        self.sums = prefix_sums(self.octets, powers(len(self.octets)))
        self.before = self.sums[places]
        self.scale = powers(len(self.octets) + 1, pow(_BASE, -1, 1 << 64))[places]
        self.whole = (self.sums[places + SPAN] - self.before) * self.scale
        heads = np.lib.stride_tricks.sliding_window_view(self.octets, HEAD)[places] if len(places) else np.zeros((0, HEAD), np.uint8)
        self.heads = np.ascontiguousarray(heads).view(">u8").ravel().astype(np.uint64)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common start of suffixes x and y of equal heads, by binary search over equal prefix hashes."""
        px, py, bx, by, sx, sy = self.places[x], self.places[y], self.before[x], self.before[y], self.scale[x], self.scale[y]
        low, high = np.full(len(x), HEAD), np.full(len(x), SPAN)
        for _ in range((SPAN - HEAD).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[px + middle] - bx) * sx == (self.sums[py + middle] - by) * sy
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def precedes(self, x: np.ndarray, y: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix x sorts before suffix y; equal ones as ``ties`` says.

        Different heads decide at once, equal hashes of all bytes are a tie, and only the rest is searched.
        """
        hx, hy = self.heads[x], self.heads[y]
        before = hx < hy
        even = np.flatnonzero(hx == hy)
        tied = self.whole[x[even]] == self.whole[y[even]]
        before[even[tied]] = ties
        rest = even[~tied]
        if len(rest):
            xr, yr = x[rest], y[rest]
            length = self.common(xr, yr)
            at = np.minimum(length, SPAN - 1)
            smaller = self.octets[self.places[xr] + at] < self.octets[self.places[yr] + at]
            before[rest] = np.where(length == SPAN, ties, smaller)
        return before

    def windows(self, x: np.ndarray) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.octets, SPAN)[self.places[x]]

    def order(self, groups: np.ndarray) -> np.ndarray:
        """Suffixes sorted within their groups (given in order, each contiguous): a merge sort of all groups at once.

        A pass merges neighbouring runs of every group: the rank of a suffix in the other run is found by binary
        search, with one hash-compared suffix comparison a step.
        """
        n = len(groups)
        order = np.arange(n)
        fresh = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(fresh, n))
        first, size = np.repeat(fresh, sizes), np.repeat(sizes, sizes)
        width = 1
        while n and width < sizes.max():
            slots = np.flatnonzero(size > width)
            base, local = first[slots], slots - first[slots]
            run = local // width
            other = run ^ 1
            low = np.minimum(other * width, size[slots])
            high = np.minimum(low + width, size[slots])
            begin, left = low.copy(), run % 2 == 0
            mine = order[slots]
            active = np.flatnonzero(low < high)
            while len(active):
                middle = (low[active] + high[active]) >> 1
                theirs = order[base[active] + middle]
                # Of equal suffixes those of the left run come first.
                before = np.empty(len(active), bool)
                from_left = left[active]
                before[from_left] = self.precedes(theirs[from_left], mine[active][from_left], ties=False)
                before[~from_left] = self.precedes(theirs[~from_left], mine[active][~from_left], ties=True)
                low[active] = np.where(before, middle + 1, low[active])
                high[active] = np.where(before, high[active], middle)
                active = active[low[active] < high[active]]
            target = (run & ~1) * width + (local - run * width) + (low - begin)
            order[base + target] = mine
            width *= 2
        return order


def repeated_windows(buffer: bytes, places: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Whether the hash of a window's ``SPAN`` bytes comes again within its group."""
    octets = np.frombuffer(buffer, np.uint8)
    sums = prefix_sums(octets, powers(len(octets)))
    hashes = (sums[places + SPAN] - sums[places]) * powers(len(octets) + 1, pow(_BASE, -1, 1 << 64))[places]
    named = _mixed(hashes) ^ (groups.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, many = np.unique(named, return_inverse=True, return_counts=True)
    return many[back] > 1


def equal_classes(buffer: bytes, places: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the suffixes and the number of the class of each place in it; equal ``SPAN`` bytes, one class.

    Hashes decide while sorting. Then all neighbours are compared byte by byte: a group in which a collision has put
    suffixes out of order is sorted again by its bytes, and classes are told apart by bytes alone.
    """
    suffixes = Suffixes(buffer, places)
    order = suffixes.order(groups)
    if not len(order):
        return order, order
    same, wrong = np.empty(len(order) - 1, bool), []
    for at in range(0, len(order) - 1, CHUNK):
        part = suffixes.windows(order[at : at + CHUNK + 1])
        differ = part[1:] != part[:-1]
        place = differ.argmax(axis=1)
        rows = np.arange(len(place))
        same[at : at + len(place)] = ~differ[rows, place]
        down = differ[rows, place] & (part[1:][rows, place] < part[:-1][rows, place])
        wrong.extend((np.flatnonzero(down) + at).tolist())
    inside = groups[1:] == groups[:-1]
    bad = {int(groups[w]) for w in wrong if inside[w]}
    for group in bad:
        slots = np.flatnonzero(groups == group)
        key = {int(s): buffer[places[s] : places[s] + SPAN] for s in order[slots]}
        order[slots] = sorted(key, key=key.__getitem__)
        texts = [key[int(s)] for s in order[slots]]
        same[slots[:-1]] = [a == b for a, b in zip(texts, texts[1:], strict=False)]
    return order, np.append(0, np.cumsum(~(same & inside)))
