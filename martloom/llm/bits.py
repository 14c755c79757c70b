"""Near pairs among fingerprints by bit-sliced comparison."""

from __future__ import annotations

import numpy as np

ONES = ~np.uint64(0)
#: Fingerprints that are compared with all others of their group at a time.
QUERIES = 256
#: Bit planes between two looks at which blocks can be abandoned.
STEP = 8


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints (n, words): row b holds bit b of all of them, 64 to a word."""
    bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little").T
    padded = np.zeros((bits.shape[0], -(-bits.shape[1] // 64) * 64), np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class CarrySave:
    """Counters of many lanes, held bit by bit; a word at each level waits for a second one, then a full adder takes both."""

    def __init__(self, shape: tuple[int, int], limit: int):
        self.limit, self.levels = limit, limit.bit_length()
        self.sums = [np.zeros(shape, np.uint64) for _ in range(self.levels)]
        self.waiting: list[np.ndarray | None] = [None] * self.levels
        self.over = np.zeros(shape, np.uint64)

    def add(self, word: np.ndarray) -> None:
        for level in range(self.levels):
            other = self.waiting[level]
            if other is None:
                self.waiting[level] = word
                return
            self.waiting[level] = None
            half = self.sums[level] ^ other
            word, self.sums[level] = (self.sums[level] & other) | (half & word), half ^ word
        self.over |= word

    def settle(self) -> None:
        """Add in the words that still wait."""
        for level in range(self.levels):
            word, self.waiting[level] = self.waiting[level], None
            for up in range(level, self.levels):
                if word is None:
                    break
                word, self.sums[up] = self.sums[up] & word, self.sums[up] ^ word
            else:
                if word is not None:
                    self.over |= word

    def exceeded(self) -> np.ndarray:
        """Lanes surely above the limit; exact once settled."""
        above, equal = self.over.copy(), np.full_like(self.over, ONES)
        for level in reversed(range(self.levels)):
            if self.limit >> level & 1:
                equal &= self.sums[level]
            else:
                above |= equal & self.sums[level]
                equal &= ~self.sums[level]
        return above

    def keep(self, columns: np.ndarray) -> None:
        self.sums = [s[:, columns] for s in self.sums]
        self.waiting = [None if w is None else w[:, columns] for w in self.waiting]
        self.over = self.over[:, columns]


def near(queries: np.ndarray, sliced: np.ndarray, radius: int) -> np.ndarray:
    """A bit for each query and fingerprint at a distance of at most ``radius``.

    The distances of a query to 64 fingerprints are updated by each bit plane at once; a block of 64 is abandoned when
    all of it is beyond the radius of all queries.
    """
    asked = np.unpackbits(queries.view(np.uint8), axis=1, bitorder="little").astype(np.uint64) * ONES
    result = np.zeros((len(queries), sliced.shape[1]), np.uint64)
    alive, counts = np.arange(sliced.shape[1]), CarrySave(result.shape, radius)
    for plane in range(sliced.shape[0]):
        counts.add(sliced[plane, alive][None, :] ^ asked[:, plane][:, None])
        if plane % STEP == STEP - 1 and plane >= radius:
            hopeful = (counts.exceeded() != ONES).any(axis=0)
            if not hopeful.all():
                alive = alive[hopeful]
                counts.keep(hopeful)
                if not len(alive):
                    return result
    counts.settle()
    result[:, alive] = ~counts.exceeded()
    return result


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A link from one member to every other of each component of near fingerprints: a star, whatever path joins them."""
    n, sliced = len(prints), planes(prints)
    adjacent = np.concatenate([near(prints[at : at + QUERIES], sliced, radius) for at in range(0, n, QUERIES)])
    lanes = np.zeros(sliced.shape[1] * 64, np.uint8)
    lanes[:n] = 1
    unseen = np.packbits(lanes, bitorder="little").view(np.uint64)
    adjacent &= unseen
    own = np.arange(n)
    adjacent[own, own // 64] &= ~(np.uint64(1) << (own % 64).astype(np.uint64))
    links = []
    for start in np.flatnonzero(adjacent.any(axis=1)).tolist():
        if not int(unseen[start // 64]) >> (start % 64) & 1:
            continue
        unseen[start // 64] &= ~(np.uint64(1) << np.uint64(start % 64))
        todo = [start]
        while todo:
            node = todo.pop()
            fresh = adjacent[node] & unseen
            if fresh.any():
                unseen &= ~fresh
                found = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little")).tolist()
                links.extend((start, other) for other in found)
                todo.extend(found)
    return links
