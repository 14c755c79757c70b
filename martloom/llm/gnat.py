"""Nearest entries by a geometric near-neighbour access tree, exact for integer points."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Entries from which a node is split, and the split points it then has.
LEAF, SPLITS = 8, 8
#: Relative margin around square roots and differences, far above their rounding errors.
MARGIN = 1e-9


@dataclass(frozen=True)
class Node:
    """``entries`` are the split points; child j holds the entries nearest to split point j, and every split point i
    knows the least and largest distance to split point j and its child (``low[i, j]``, ``high[i, j]``). A leaf has entries only."""

    entries: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: tuple[Node | None, ...] = ()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points (n, d) and (m, d), summed by component so that no (n, m, d) array is held."""
    total = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        total += gap * gap
    return total


def build(points: np.ndarray, entries: np.ndarray | None = None) -> Node:
    """A tree over the rows ``entries`` of ``points``. Split points are drawn far from one another, from the first entry on."""
    entries = np.arange(len(points)) if entries is None else entries
    if len(entries) <= LEAF:
        return Node(entries)
    chosen, gap = [0], squared(points[entries], points[entries[:1]])[:, 0]
    while len(chosen) < SPLITS and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(points[entries], points[entries[chosen[-1:]]])[:, 0])
    if len(chosen) == 1:  # all entries are one point: the first decides every tie
        return Node(entries[:1])
    splits, rest = entries[chosen], np.delete(entries, chosen)
    distances = squared(points[splits], points[entries])
    owner = squared(points[splits], points[rest]).argmin(axis=0)
    low, high, children = np.empty((len(splits),) * 2), np.empty((len(splits),) * 2), []
    place = {e: k for k, e in enumerate(entries.tolist())}
    for j, split in enumerate(splits):
        members = rest[owner == j]
        held = np.sqrt(distances[:, [place[e] for e in [int(split), *members.tolist()]]].astype(float))
        low[:, j], high[:, j] = held.min(axis=1), held.max(axis=1)
        children.append(build(points, members) if len(members) else None)
    return Node(splits, low * (1 - MARGIN), high * (1 + MARGIN), tuple(children))


def nearest(root: Node, points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every query the nearest entry, the lowest number among equally near ones, and the squared distance.

    A child is left out for the queries whose ball of the best distance so far lies strictly outside of the ring that
    some split point knows around it, with all roots widened by ``MARGIN``; so an entry at the same distance is always
    compared, and compared as an integer.
    """
    best = np.full(len(queries), np.iinfo(np.int64).max)
    found = np.full(len(queries), len(points), np.int64)

    def search(node: Node, asked: np.ndarray) -> None:
        distances = squared(queries[asked], points[node.entries])
        for column, entry in enumerate(node.entries.tolist()):
            d = distances[:, column]
            better = (d < best[asked]) | ((d == best[asked]) & (entry < found[asked]))
            best[asked[better]], found[asked[better]] = d[better], entry
        if not node.children:
            return
        roots = np.sqrt(distances.astype(float))
        for j in np.argsort(distances.sum(axis=0)).tolist():
            child = node.children[j]
            if child is not None:
                radius = np.sqrt(best[asked].astype(float))[:, None] * (1 + MARGIN)
                outside = (roots * (1 - MARGIN) - radius > node.high[:, j]) | (roots * (1 + MARGIN) + radius < node.low[:, j])
                left = asked[~outside.any(axis=1)]
                if len(left):
                    search(child, left)

    if len(queries):
        search(root, np.arange(len(queries)))
    return found, best
