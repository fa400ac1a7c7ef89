"""Vectorised tree walk over one Arrow batch; shared by scoring and training."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTree:
    """One tree as arrays indexed by node id; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    default_left: np.ndarray
    value: np.ndarray
    depth: int

    @classmethod
    def from_nodes(cls, nodes: Sequence[dict]) -> FlatTree:
        size = max(n["node"] for n in nodes) + 1
        tree = cls(
            np.full(size, -1, np.int64), np.zeros(size), np.zeros(size, np.int64),
            np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size), 0,
        )
        for n in nodes:
            i = n["node"]
            tree.depth = max(tree.depth, n["depth"])
            if n["is_leaf"]:
                tree.value[i] = n["leaf_value"]
            else:
                tree.feature[i], tree.threshold[i] = n["feature"], n["threshold"]
                tree.left[i], tree.right[i] = n["left"], n["right"]
                tree.default_left[i] = n["default_left"]
        return tree


def dense_columns(owner: np.ndarray, column: np.ndarray, value: np.ndarray,
                  n_columns: int, n_rows: int) -> np.ndarray:
    """Column-major matrix of the entries with ``column >= 0``; NaN where there is none."""
    matrix = np.full((n_columns, n_rows), np.nan)
    keep = column >= 0
    matrix[column[keep], owner[keep]] = value[keep]
    return matrix


def walk_tree(tree: FlatTree, matrix: np.ndarray, column_of: np.ndarray) -> np.ndarray:
    """Node at which each row ends. ``column_of`` maps a feature id to its matrix row."""
    n_rows = matrix.shape[1]
    node = np.zeros(n_rows, np.int64)
    if tree.depth == 0:
        return node
    flat, rows = matrix.ravel(), np.arange(n_rows)
    column = np.where(tree.feature >= 0, column_of[tree.feature], 0)
    for _ in range(tree.depth):
        x = flat[column[node] * n_rows + rows]
        go_left = np.where(np.isnan(x), tree.default_left[node], x < tree.threshold[node])
        below = np.where(go_left, tree.left[node], tree.right[node])
        node = np.where(tree.feature[node] >= 0, below, node)
    return node


def used_features(trees: Sequence[FlatTree]) -> np.ndarray:
    """Sorted distinct split features."""
    if not trees:
        return np.zeros(0, np.int64)
    found = np.unique(np.concatenate([t.feature for t in trees]))
    return found[found >= 0]
