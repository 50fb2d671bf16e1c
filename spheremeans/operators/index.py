"""A tree over centroid positions, searched for many points at once.

Positions are halved at the median of their widest axis until ``LEAF`` or fewer share a leaf,
so the tree is complete and lies in arrays by level. A batch of points first goes down to
the leaf whose box is nearer at each level, which gives every point a distance to beat.
Then pairs of (point, node) move down level by level, dropping those whose box lies beyond
that distance; what arrives at a leaf is measured. No step loops over points or nodes.

Distances are those of a full scan, operation by operation, and equal ones go to the lowest
id, so labels are the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF = 12

# Points searched, and pairs of points and nodes held, at once.
_POINTS_AT_ONCE = 4096
_MOST_PAIRS = 1 << 17

# Kilometres that rounding may add to a distance, with a wide margin.
_ROUNDING_KM = 1e-6


def tree_search(
    positions: np.ndarray, leaf: int = LEAF
) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, int]]:
    """A function from points (finite rows of x, y, z) to the row of the nearest position,
    its distance, and how many distances were computed.

    The function refers to nothing in this package, for workers that may not have it.
    """
    k = len(positions)
    depth = max(0, int(np.ceil(np.log2(k / leaf))))
    width = -(-k // (1 << depth))
    order = np.minimum(np.arange(width << depth), k - 1)  # the last fills up
    boxes = []
    for level in range(depth + 1):
        members = order.reshape(1 << level, -1)
        at = positions[members]
        low, high = at.min(axis=1), at.max(axis=1)
        boxes.append((low, high))
        if level < depth:
            widest = (high - low).argmax(axis=1)
            along = np.take_along_axis(at, widest[:, None, None], axis=2)[:, :, 0]
            order = np.take_along_axis(members, along.argsort(axis=1, kind="stable"), axis=1).ravel()
    leaves = np.sort(order.reshape(1 << depth, width), axis=1)
    axes = [np.ascontiguousarray(positions[leaves][:, :, a]) for a in range(3)]
    at_once, most_pairs, margin = _POINTS_AT_ONCE, _MOST_PAIRS, _ROUNDING_KM

    def square_to_box(level, node, points):
        low, high = boxes[level]
        out = np.maximum(np.maximum(low[node] - points, points - high[node]), 0.0)
        return np.einsum("ij,ij->i", out, out)

    def measure(points, node):
        squares = 0.0
        for a in range(3):
            squares = squares + np.square(points[:, a, None] - axes[a][node])
        distance = np.sqrt(squares)
        first = distance.argmin(axis=1)  # leaves list their members by row
        rows = np.arange(len(points))
        return leaves[node, first], distance[rows, first]

    def widen(points, node, label, best):
        """Looks beyond the first leaf; betters ``label`` and ``best``, returns the pairs measured."""
        limit = np.square(best * (1 + 1e-12) + margin)
        who, at = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        for level in range(1, depth + 1):
            who, at = np.concatenate([who, who]), np.concatenate([2 * at, 2 * at + 1])
            near = square_to_box(level, at, points[who]) <= limit[who]
            who, at = who[near], at[near]
            if len(who) > most_pairs and len(points) > 1:  # points far from all positions
                half = len(points) // 2
                return sum(widen(points[c], node[c], label[c], best[c]) for c in (slice(half), slice(half, None)))
        others = at != node[who]
        who, at = who[others], at[others]
        if len(who):
            found, distance = measure(points[who], at)
            ranked = np.lexsort((found, distance, who))
            ranked = ranked[np.flatnonzero(np.diff(who[ranked], prepend=-1))]
            whose, found, distance = who[ranked], found[ranked], distance[ranked]
            better = (distance < best[whose]) | ((distance == best[whose]) & (found < label[whose]))
            label[whose[better]], best[whose[better]] = found[better], distance[better]
        return len(who)

    def search(points):
        labels, distances, measured = np.zeros(len(points), dtype=np.int64), np.empty(len(points)), 0
        for start in range(0, len(points), at_once):
            cut = slice(start, start + at_once)
            some = points[cut]
            node = np.zeros(len(some), dtype=np.int64)
            for level in range(1, depth + 1):
                left = 2 * node
                right_nearer = square_to_box(level, left + 1, some) < square_to_box(level, left, some)
                node = left + right_nearer
            labels[cut], distances[cut] = measure(some, node)
            measured += width * (len(some) + widen(some, node, labels[cut], distances[cut]))
        return labels, distances, measured

    return search
