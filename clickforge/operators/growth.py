"""One level of several trees at once, from binned rows to the best split of every open node.

Trees of several models and classes (``outputs``) grow over the same rows in the same pass. Tasks walk their rows to the open nodes and add up
partial histograms: gradient, hessian and number of rows for each cell, that is node and code. Of two siblings only the one with less
hessian is counted; the other is what the parent's histogram has left, so half the cells travel.

Cells go to the owner of their feature range. An owner adds up the partial histograms as they come in, takes the
siblings from the histogram that it kept of the level before, and searches the splits of its range. Only the best split of
each node and range leaves it, so the driver receives nodes x owners rows, and the shuffle is at most tasks x cells,
however many rows there are. Where many tasks send, owners are salted: cells are added up by owner and salt first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators.binning import Cuts
from clickforge.operators.histogram import ROUND_DIGITS
from clickforge.operators.sparse import list_owner
from clickforge.operators.walk import FlatTree, dense_columns, used_features, walk_tree

CELLS_SCHEMA = "owner int, kind int, cell array<long>, g array<double>, h array<double>, n array<long>, gain array<double>"
PARTIAL, KEPT, SPLIT, TOTAL = range(4)
# A task keeps one dense histogram up to this many cells (24 bytes each); beyond it, it keeps the cells it met,
# and sends them on when there are as many.
DENSE_CELLS = 4_000_000
# Cells of one row of the exchange, and of one padded block of the split search.
EMIT_CELLS = 65_536
SEARCH_CELLS = 1_000_000
# Codes of the rows that a task walks at once; each takes some 100 bytes there.
ROW_CODES = 1_000_000
# An owner's share of a level's cells, and how many tasks may send to it before it is salted.
OWNER_CELLS = 4_000_000
SALT_FROM = 64


@dataclass(frozen=True)
class Layout:
    """Codes and who owns them: owner ``i`` has the codes from ``bounds[i]`` up to ``bounds[i + 1]``, whole features."""

    code_start: np.ndarray
    feature_of: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, cuts: Cuts, nodes: int, at_least: int) -> Layout:
        """As many owners as keep a level of ``nodes`` nodes within ``OWNER_CELLS`` cells each, at least ``at_least``, one feature each at most."""
        starts = cuts.code_start
        owners = max(1, min(cuts.num_features, max(at_least, math.ceil(cuts.num_codes * nodes / OWNER_CELLS))))
        ends = np.searchsorted(starts, np.arange(1, owners) * cuts.num_codes / owners)
        bounds = np.concatenate([[0], starts[np.unique(ends)], [cuts.num_codes]]).astype(np.int64)
        feature_of = np.repeat(np.arange(cuts.num_features, dtype=np.int32), np.diff(starts))
        return cls(starts, feature_of, np.unique(bounds) if cuts.num_codes else np.array([0, 0]))

    @property
    def num_codes(self) -> int:
        return len(self.feature_of)

    @property
    def owners(self) -> int:
        return len(self.bounds) - 1

    @property
    def width(self) -> int:
        """Cells of one node: its codes, and one for all of its rows."""
        return self.num_codes + 1

    def owner_of(self, code: np.ndarray) -> np.ndarray:
        return np.clip(np.searchsorted(self.bounds, code, side="right") - 1, 0, self.owners - 1)


@dataclass
class Level:
    """What one level needs besides the rows.

    ``trees`` has the tree so far of each output (None: not growing). ``counted`` lists the (output, node) whose cells are
    added up; ``siblings`` the node that is taken from the parent's rest, or -1, and ``parents`` the place of the parent among
    the nodes kept from the level before. The kept nodes are the counted ones (``place``) and the siblings (``place + len(counted)``).
    ``limits`` has for each kept node: reg_lambda, alpha, min_child_weight, and, below the roots, the sums g and h of its rows.
    """

    trees: list[FlatTree | None]
    counted: list[tuple[int, int]]
    siblings: list[int]
    parents: list[int]
    limits: np.ndarray
    root: bool
    keep: Broadcast[np.ndarray] | None = None
    last: bool = False
    nodes: list[tuple[int, int]] = field(init=False)

    def __post_init__(self) -> None:
        self.nodes = self.counted + [(o, s) for (o, _), s in zip(self.counted, self.siblings) if s >= 0]


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts' cells, each once, in order, with their sums."""
    cell, g, h, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1)) if len(cell) else np.zeros(0, np.int64)
    if not len(cell):
        return cell, g, h, n
    return cell[first], np.add.reduceat(g[order], first), np.add.reduceat(h[order], first), np.add.reduceat(n[order], first)


def _record(owner: int, kind: int, cell: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, gain: np.ndarray | None = None) -> pa.RecordBatch:
    gain = np.zeros(0) if gain is None else gain
    one = lambda x, t: pa.array([x], pa.list_(t))
    return pa.RecordBatch.from_arrays(
        [pa.array([owner], pa.int32()), pa.array([kind], pa.int32()), one(cell, pa.int64()), one(g, pa.float64()), one(h, pa.float64()), one(n, pa.int64()), one(gain, pa.float64())],
        names=["owner", "kind", "cell", "g", "h", "n", "gain"])


def _records(owner: int, kind: int, sums: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(sums[0]), EMIT_CELLS):
        yield _record(owner, kind, *[x[i: i + EMIT_CELLS] for x in sums])


def _to_owners(layout: Layout, sums: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """The cells of a task, to the owner of each; the cells of all rows of a node to every owner."""
    code = sums[0] % layout.width
    whole = np.flatnonzero(code == layout.num_codes)
    if len(whole):
        for i in range(layout.owners):
            yield from _records(i, PARTIAL, tuple(x[whole] for x in sums))
    some = np.flatnonzero(code < layout.num_codes)
    owner = layout.owner_of(code[some])
    order = np.argsort(owner, kind="stable")
    first = np.flatnonzero(np.diff(owner[order], prepend=-1))
    for i, j in zip(first, np.append(first[1:], len(order))):
        mine = some[order[i:j]]
        yield from _records(int(owner[order[i]]), PARTIAL, tuple(x[mine] for x in sums))


def _row_blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch (codes first), as many at a time as have ``ROW_CODES`` codes, or one."""
    ends = np.cumsum(batch.column(0).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + ROW_CODES, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def partial_cells(rows: DataFrame, shared: Broadcast[Layout], level: Level) -> DataFrame:
    """The partial histograms of ``rows`` (codes, g array, h array: one entry for each output), addressed to owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        keep = None if level.keep is None else level.keep.value
        width, size = layout.width, len(level.counted) * layout.width
        dense = [np.zeros(size), np.zeros(size), np.zeros(size, np.int64)] if size <= DENSE_CELLS else None
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        place = []  # of each output's nodes
        for o, tree in enumerate(level.trees):
            mine = np.full(1 if tree is None else len(tree.feature), -1, np.int64)
            for i, (output, node) in enumerate(level.counted):
                if output == o:
                    mine[node] = i
            place.append(mine)
        growing = [t for t in level.trees if t is not None]
        used = used_features(growing)
        column_of = np.full(max(len(layout.code_start) - 1, 1), -1, np.int64)
        column_of[used] = np.arange(len(used))

        for batch in (block for whole in batches for block in _row_blocks(whole)):
            lists = batch.column(0)
            owner = list_owner(lists)
            codes = lists.flatten().to_numpy(zero_copy_only=False)
            n_rows = batch.num_rows
            g_all, h_all = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n_rows, -1) for i in (1, 2))
            feature = layout.feature_of[codes]
            matrix = dense_columns(owner, column_of[feature], codes - layout.code_start[feature], len(used), n_rows)
            sampled = slice(None) if keep is None else keep[feature]
            codes, owner = codes[sampled], owner[sampled]
            for o, tree in enumerate(level.trees):
                if tree is None:
                    continue
                at = place[o][walk_tree(tree, matrix, column_of)]
                here = at[owner]
                row = owner[here >= 0]
                cell = here[here >= 0] * width + codes[here >= 0]
                if level.root:
                    cell, row = np.concatenate([cell, at * width + layout.num_codes]), np.concatenate([row, np.arange(n_rows)])
                held.append((cell, g_all[row, o], h_all[row, o], np.ones(len(cell), np.int64)))
                waiting += len(cell)
                if waiting <= max(DENSE_CELLS // 4, 250_000):  # asked for each output: many of them would wait together
                    continue
                if dense:
                    _pour(dense, held)
                    held = []
                else:
                    held = [_added(held)]
                    if len(held[0][0]) > DENSE_CELLS // 2:
                        yield from _to_owners(layout, held.pop())
                waiting = 0
        if dense:
            _pour(dense, held)
            filled = np.flatnonzero(dense[2])
            yield from _to_owners(layout, (filled, *[x[filled] for x in dense]))
        elif held:
            yield from _to_owners(layout, _added(held))

    return rows.select("codes", "g", "h").mapInArrow(run, CELLS_SCHEMA)


def _pour(dense: list[np.ndarray], held: list[tuple[np.ndarray, ...]]) -> None:
    for cell, g, h, n in held:
        dense[0] += np.bincount(cell, weights=g, minlength=len(dense[0]))
        dense[1] += np.bincount(cell, weights=h, minlength=len(dense[1]))
        dense[2] += np.bincount(cell, minlength=len(dense[2]))


def _by_owner(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list]]]:
    """The rows of each owner in turn, from batches sorted by owner, added up as they come, by kind."""
    owner, parts, waiting = None, {}, 0

    def done() -> dict[int, list]:
        return {kind: _added(x) for kind, x in parts.items()}

    for batch in batches:
        lists = [batch.column(i) for i in range(2, 6)]
        for i, (o, kind) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if o != owner:
                if owner is not None:
                    yield owner, done()
                owner, parts, waiting = o, {}, 0
            part = tuple(x[i].values.to_numpy(zero_copy_only=False) for x in lists)
            parts.setdefault(kind, []).append(part)
            waiting += len(part[0])
            if waiting > SEARCH_CELLS:
                parts = {k: [x] for k, x in done().items()}
                waiting = 0
    if owner is not None:
        yield owner, done()


def _dealt(cells: DataFrame, parts: int, *keys: str) -> DataFrame:
    return cells.repartition(parts, *keys).sortWithinPartitions(*keys)


def _salted(cells: DataFrame, owners: int, tasks: int) -> DataFrame:
    """The partial histograms, added up by owner and salt where many tasks send."""
    if tasks <= SALT_FROM:
        return cells
    salts = math.isqrt(tasks - 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Owner and salt in one number, so that both deal and order the rows.
        for both, parts in _by_owner(batches):
            yield from _records(both // salts, PARTIAL, parts[PARTIAL])

    marked = cells.withColumn("owner", F.col("owner") * salts + F.pmod(F.spark_partition_id(), F.lit(salts)))
    return _dealt(marked, owners * salts, "owner").mapInArrow(run, CELLS_SCHEMA)


def _segments(cell: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of cells of one node and feature: where they begin, and how long they are; and each cell's feature."""
    feature = layout.feature_of[cell % layout.width].astype(np.int64)
    key = cell // layout.width * len(layout.code_start) + feature
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return first, np.diff(np.append(first, len(cell))), feature


def best_in_range(sums: tuple[np.ndarray, ...], layout: Layout, limits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The best split of each node among the features of some cells: (cell, g left, h left, default left, gain).

    A split is named by the first cell on its right. Running sums go through one feature of one node, whatever stands beside it.
    Ties go to the lowest feature, then the lowest bin, then to missing values on the left.
    """
    cell, g, h, _ = sums
    first, size, feature = _segments(cell, layout)
    found = []
    order = np.argsort(size, kind="stable")
    begin = 0
    while begin < len(order):
        longest = int(size[order[min(begin + max(1, SEARCH_CELLS // int(size[order[begin]])), len(order)) - 1]])
        end = min(begin + max(1, SEARCH_CELLS // longest), len(order))
        some = order[begin:end]
        longest = int(size[some].max())
        inside = np.arange(longest)[None, :] < size[some][:, None]
        at = (first[some][:, None] + np.arange(longest)[None, :])[inside]
        node = cell[first[some]] // layout.width
        gs, hs = np.zeros(inside.shape), np.zeros(inside.shape)
        gs[inside], hs[inside] = g[at], h[at]
        reg, alpha, least, g_all, h_all = limits[node].T[:, :, None]

        def score(x, y):
            shrunk = np.sign(x) * np.maximum(np.abs(x) - alpha, 0.0)  # noqa: B023
            below = y + reg  # noqa: B023
            return np.where(below == 0, 0.0, shrunk * shrunk / np.where(below == 0, 1.0, below))

        up_to_g, up_to_h = np.cumsum(gs, axis=1), np.cumsum(hs, axis=1)
        for default_left in (True, False):
            left_g, left_h = np.zeros_like(gs), np.zeros_like(hs)
            left_g[:, 1:], left_h[:, 1:] = up_to_g[:, :-1], up_to_h[:, :-1]
            if default_left:
                left_g, left_h = left_g + g_all - up_to_g[:, -1:], left_h + h_all - up_to_h[:, -1:]
            gain = np.round(score(left_g, left_h) + score(g_all - left_g, h_all - left_h) - score(g_all, h_all), ROUND_DIGITS)
            gain = np.where(inside & (left_h >= least) & (h_all - left_h >= least), gain, -np.inf)
            best = np.argmax(gain, axis=1)
            row = np.arange(len(some))
            there = np.flatnonzero(np.isfinite(gain[row, best]))
            b = best[there]
            found.append((cell[first[some][there] + b], left_g[there, b], left_h[there, b], np.full(len(there), int(default_left)), gain[there, b]))
        begin = end
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, float, float, np.int64, float))
    cell, g, h, left, gain = (np.concatenate(x) for x in zip(*found))
    node, code = cell // layout.width, cell % layout.width
    order = np.lexsort((-left, code, -gain, node))  # codes rise with feature and bin
    top = order[np.flatnonzero(np.diff(node[order], prepend=-1))]
    return cell[top], g[top], h[top], left[top], gain[top]


def _kept(level: Level, layout: Layout, counted: tuple[np.ndarray, ...], before: tuple[np.ndarray, ...] | None) -> tuple[np.ndarray, ...]:
    """The cells of the counted nodes and, from the parents' cells, those of their siblings."""
    if before is None or not len(before[0]):
        return counted
    of_parent = np.full(max(int(before[0][-1] // layout.width), *level.parents) + 1, -1, np.int64)
    for place, (parent, sibling) in enumerate(zip(level.parents, level.siblings)):
        if sibling >= 0:
            of_parent[parent] = place
    number = np.cumsum([s >= 0 for s in level.siblings]) - 1 + len(level.counted)
    place = of_parent[before[0] // layout.width]
    mine = place >= 0
    parent = (number[place[mine]] * layout.width + before[0][mine] % layout.width, *[x[mine] for x in before[1:]])
    small = (number[counted[0] // layout.width] * layout.width + counted[0] % layout.width, *[-x for x in counted[1:]])
    rest = _added([parent, small])
    there = rest[3] > 0  # sums of no rows are no cell, whatever rounding left of them
    return tuple(np.concatenate([a, b[there]]) for a, b in zip(counted, rest))


def grown_level(rows: DataFrame, shared: Broadcast[Layout], level: Level, before: DataFrame | None, tasks: int) -> DataFrame:
    """The level's splits (kind SPLIT), its nodes' cells for the next one (KEPT) and, at the roots, the sums of all rows (TOTAL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        empty = tuple(np.zeros(0, t) for t in (np.int64, float, float, np.int64))
        for owner, parts in _by_owner(batches):
            counted = parts.get(PARTIAL, empty)
            whole = counted[0] % layout.width == layout.num_codes
            limits = level.limits
            if level.root:
                totals = tuple(x[whole] for x in counted)
                counted = tuple(x[~whole] for x in counted)
                limits = limits.copy()
                limits[totals[0] // layout.width, 3:] = np.stack(totals[1:3], axis=1)
                if owner == 0:
                    yield _record(owner, TOTAL, totals[0] // layout.width, *totals[1:])
            cells = counted if level.root else _kept(level, layout, counted, parts.get(KEPT))
            best = best_in_range(cells, layout, limits)
            yield _record(owner, SPLIT, *best)
            if not level.last:
                yield from _records(owner, KEPT, cells)

    owners = shared.value.owners
    cells = _salted(partial_cells(rows, shared, level), owners, tasks)
    if before is not None:
        cells = cells.unionByName(before.where(F.col("kind") == KEPT))
    return _dealt(cells, owners, "owner").mapInArrow(run, CELLS_SCHEMA)


@dataclass
class NodeSplit:
    """The best split of a node, in bin space."""

    output: int
    node: int
    feature: int
    bin: int
    default_left: bool
    gain: float
    g_left: float
    h_left: float


def read_level(found: DataFrame, layout: Layout, level: Level) -> tuple[list[NodeSplit], dict[int, tuple[float, float]]]:
    """The best split of each node over all owners, and the sums of each root by output. At most nodes x owners entries come in."""
    best: dict[int, tuple] = {}
    totals: dict[int, tuple[float, float]] = {}
    for r in found.where(F.col("kind") >= SPLIT).select("kind", "cell", "g", "h", "n", "gain").collect():
        if r.kind == TOTAL:
            totals |= {level.nodes[place][0]: (g, h) for place, g, h in zip(r.cell, r.g, r.h)}
            continue
        for cell, g, h, left, gain in zip(r.cell, r.g, r.h, r.n, r.gain):
            place, code = divmod(cell, layout.width)
            key = (-gain, code)  # an owner has a code to itself
            if place not in best or key < best[place][0]:
                best[place] = (key, g, h, left)
    splits = []
    for place, ((loss, code), g, h, left) in best.items():
        feature = int(layout.feature_of[code])
        splits.append(NodeSplit(*level.nodes[place], feature, int(code - layout.code_start[feature]), bool(left), -loss, g, h))
    return splits, totals


class RoundGrower:
    """Grows one tree for each growing output over one round's rows, level by level."""

    def __init__(self, rows: DataFrame, shared: Broadcast[Layout], tasks: int, keep: Broadcast[np.ndarray] | None = None):
        self.rows, self.shared, self.tasks, self.keep = rows, shared, tasks, keep

    def grow(self, depths: Sequence[int | None], limits: Sequence[tuple[float, float, float]], start: Callable[[int, float, float], object]) -> list:
        """The trees by output (None where the depth is None): ``start`` makes a tree from the output and its root's sums.

        A tree has ``nodes``, ``open``, ``flat()`` and ``grow(splits)``; ``limits`` are reg_lambda, alpha and min_child_weight.
        """
        growing = [o for o, d in enumerate(depths) if d is not None]
        trees: list = [None] * len(depths)
        root = FlatTree.from_nodes([{"node": 0, "depth": 0, "is_leaf": True, "leaf_value": 0.0}])
        level = Level(
            [root if d is not None else None for d in depths], [(o, 0) for o in growing], [-1] * len(growing), [-1] * len(growing),
            np.array([[*limits[o], 0.0, 0.0] for o in growing]).reshape(-1, 5), True, self.keep, last=all(d < 2 for d in depths if d is not None))
        depth, before = 0, None
        try:
            while level.counted:
                found = grown_level(self.rows, self.shared, level, before, self.tasks).persist(StorageLevel.MEMORY_AND_DISK)
                splits, totals = read_level(found, self.shared.value, level)
                if before is not None:
                    before.unpersist()
                before = found
                if level.root:
                    for o in growing:
                        trees[o] = start(o, *totals.get(o, (0.0, 0.0)))
                for o in growing:
                    if trees[o].open:
                        trees[o].grow([s for s in splits if s.output == o] if depth < depths[o] else [])
                depth += 1
                for o in growing:
                    if depth >= depths[o]:
                        trees[o].open = []
                level = self._next(level, trees, growing, depths, limits, depth)
        finally:
            if before is not None:
                before.unpersist()
        return trees

    def _next(self, level: Level, trees: list, growing: list[int], depths: Sequence[int | None], limits, depth: int) -> Level:
        places = {n: i for i, n in enumerate(level.nodes)}
        counted, siblings, parents, small_sums, rest_sums = [], [], [], [], []
        for o in growing:
            nodes = trees[o].nodes
            for left, right in zip(trees[o].open[::2], trees[o].open[1::2]):
                small, rest = (left, right) if nodes[left]["h"] <= nodes[right]["h"] else (right, left)
                counted.append((o, small))
                siblings.append(rest)
                parents.append(places[o, nodes[left]["parent"]])
                small_sums.append([*limits[o], nodes[small]["g"], nodes[small]["h"]])
                rest_sums.append([*limits[o], nodes[rest]["g"], nodes[rest]["h"]])
        flat = [trees[o].flat() if trees[o] is not None and trees[o].open else None for o in range(len(trees))]
        last = all(depth + 1 >= depths[o] for o in growing if trees[o].open)
        return Level(flat, counted, siblings, parents, np.array(small_sums + rest_sums).reshape(-1, 5), False, self.keep, last)
