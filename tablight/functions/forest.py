"""Labels and spanning forests of bounded edge lists, in numpy, for use inside tasks.

A spanning forest of a part of a graph may stand for that part: what it drops
closes a cycle of edges that are no heavier, so components at every weight stay
the same (the cycle property). Tasks use this to send on at most one edge a node
instead of all pairs they have seen.
"""

from __future__ import annotations

import numpy as np


def min_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b): the smallest node of each node's component,
    by hooking and pointer jumping."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        low = np.minimum(ra, rb)
        np.minimum.at(root, np.maximum(ra, rb), low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) with the same components."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = min_labels(at[: len(a)], at[len(a) :], len(nodes))
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def level_forest(a: np.ndarray, b: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest (a, b, level) of weighted edges: for every level, the edges
    up to it join the same nodes as all edges up to it."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    out_a, out_b, out_l = [], [], []
    for e in np.unique(level):
        use = level == e
        la, lb = label[ia[use]], label[ib[use]]
        root = min_labels(la, lb, len(nodes))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        out_a.append(nodes[moved])
        out_b.append(nodes[root[moved]])
        out_l.append(np.full(len(moved), e, level.dtype))
        label = root[label]
    if not out_a:
        return a[:0], b[:0], level[:0]
    return np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_l)
