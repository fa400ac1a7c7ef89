"""Logistic regressions for a whole grid of penalties in the same passes.

A pass computes loss, gradient and second derivatives of every setting's coefficients at once: a task multiplies its rows with the matrix of
all coefficients (rows of few entries, such as one-hot leaves, entry by entry and pair by pair, whatever the width) and sends, for each setting and feature, one row of sums. Rows of one setting and feature are added up by whoever
gets them; the driver receives settings x features rows of that length and solves each setting's penalised quadratic model by
coordinate descent. A handful of passes serves the grid, whatever its size. The objective is that of the elastic-net classifier:
mean loss plus penalties on coefficients of features scaled to unit deviation, intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from clickforge.operators.sparse import feats_column, list_owner

# Widest feature space of a pass: second derivatives are settings x width x width numbers.
MAX_WIDTH = 512
SUMS_SCHEMA = "place int, sums array<double>"
ROWS_AT_ONCE = 2048
# A block whose rows' pairs of entries, times this, are fewer than its rows' cells of second derivatives goes pair by pair.
DENSE_FROM = 16


@dataclass(frozen=True)
class LinearSetting:
    reg: float
    elastic_net: float
    max_iter: int = 100


@dataclass
class LinearFit:
    """Coefficients on the features' own scale; ``objective`` is the penalised mean loss, ``violation`` how far its optimum conditions are missed."""

    setting: LinearSetting
    coefficients: np.ndarray
    intercept: float
    objective: float
    violation: float
    passes: int


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, feature, value, labels) of some rows at a time: their entries by row and feature, the last value of a repeated one; NaN is 0."""
    for i in range(0, batch.num_rows, ROWS_AT_ONCE):
        lists = batch.column(1).slice(i, ROWS_AT_ONCE)
        entries = lists.flatten()
        ids = entries.field("f").to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= width):
            raise ValueError("a feature id lies outside the feature space")
        values = entries.field("v").to_numpy(zero_copy_only=False)
        owner = list_owner(lists)
        key = owner * width + ids
        if np.any(np.diff(key) <= 0):
            _, back = np.unique(key[::-1], return_index=True)
            last = len(key) - 1 - back
            owner, ids, values = owner[last], ids[last], values[last]
        yield owner, ids, np.nan_to_num(values, nan=0.0), batch.column(0).slice(i, ROWS_AT_ONCE).to_numpy(zero_copy_only=False)


def _pairs(owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of every two entries of one row, the first not behind the second; entries stand by row, ``size`` is how many each has."""
    left = np.cumsum(size)[owner] - np.arange(len(owner))  # entries of the row from this one on
    first = np.repeat(np.arange(len(owner)), left)
    return first, first + np.arange(len(first)) - np.repeat(np.cumsum(left) - left, left)


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sums of each place over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = sums.values.to_numpy(zero_copy_only=False)
                total[place] = total[place] + x if place in total else x.copy()
        yield _sums(total)

    return {r.place: np.array(r.sums) for r in parts.repartition("place").mapInArrow(run, SUMS_SCHEMA).collect()}


def _sums(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["place", "sums"])


def _moments(rows: DataFrame, width: int) -> tuple[float, float, np.ndarray]:
    """The number of rows, the sum of labels, and each feature's unbiased deviation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width + 2)
        for batch in batches:
            for _, ids, x, y in _blocks(batch, width):
                total += np.concatenate([[len(y), y.sum()], np.bincount(ids, x, width), np.bincount(ids, x * x, width)])
        yield _sums({0: total})

    total = _added(rows.mapInArrow(run, SUMS_SCHEMA)).get(0, np.zeros(2 * width + 2))
    n, mean = total[0], total[2: 2 + width] / max(total[0], 1)
    return n, total[1], np.sqrt(np.maximum(total[2 + width:] - n * mean * mean, 0.0) / max(n - 1, 1))


def _derivatives(rows: DataFrame, scale: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives, summed over all rows, of each row of ``at`` (scaled coefficients, then the intercept)."""
    width, models = len(scale), len(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, grad, second = np.zeros(models), np.zeros((models, width + 1)), np.zeros((models, width + 1, width + 1))
        upper = np.zeros((models, width * width))  # from blocks of few entries, features in rising order
        for batch in batches:
            for owner, ids, values, y in _blocks(batch, width):
                x, n = values * scale[ids], len(y)
                size = np.bincount(owner, minlength=n)
                if sparse := DENSE_FROM * int((size * (size + 1) // 2).sum()) < n * width * width:
                    margin = np.stack([np.bincount(owner, b[ids] * x, n) for b in at]) + at[:, -1:]
                else:
                    z = np.vstack([np.zeros((width, n)), np.ones(n)])
                    z[ids, owner] = x
                    margin = at @ z
                p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
                loss += (np.logaddexp(0, margin) - y * margin).sum(axis=1)
                weight = p * (1 - p)
                if sparse:
                    a, b = _pairs(owner, size)
                    row, cell, product = owner[a], ids[a] * width + ids[b], x[a] * x[b]
                    for m in range(models):
                        grad[m] += np.append(np.bincount(ids, (p[m] - y)[owner] * x, width), (p[m] - y).sum())
                        upper[m] += np.bincount(cell, weight[m][row] * product, width * width)
                        border = np.bincount(ids, weight[m][owner] * x, width)
                        second[m, -1] += np.append(border, weight[m].sum())
                        second[m, :-1, -1] += border
                else:
                    grad += (p - y) @ z.T
                    for m in range(models):
                        second[m] += (z * weight[m]) @ z.T
        for m in range(models):
            half = upper[m].reshape(width, width)
            second[m, :-1, :-1] += half + np.triu(half, 1).T
        for m in range(models):  # a place for each row of the second derivatives; the loss and the gradient come with the first
            head = np.concatenate([[loss[m]], grad[m]])
            yield _sums({m * (width + 1) + i: np.concatenate([second[m, i], head if i == 0 else []]) for i in range(width + 1)})

    found = _added(rows.mapInArrow(run, SUMS_SCHEMA))
    loss, grad, second = np.zeros(models), np.zeros((models, width + 1)), np.zeros((models, width + 1, width + 1))
    for place, sums in found.items():
        m, i = divmod(place, width + 1)
        second[m, i] = sums[: width + 1]
        if i == 0:
            loss[m], grad[m] = sums[width + 1], sums[width + 2:]
    return loss, grad, second


def _penalty(b: np.ndarray, s: LinearSetting) -> float:
    return s.reg * (s.elastic_net * np.abs(b[:-1]).sum() + (1 - s.elastic_net) / 2 * (b[:-1] ** 2).sum())


def _violation(b: np.ndarray, grad: np.ndarray, s: LinearSetting) -> float:
    """The largest distance of a zero from the subgradient of the objective."""
    l1, l2 = s.reg * s.elastic_net, s.reg * (1 - s.elastic_net)
    g = grad[:-1] + l2 * b[:-1]
    inside = np.where(b[:-1] == 0, np.maximum(np.abs(g) - l1, 0.0), np.abs(g + l1 * np.sign(b[:-1])))
    return float(max(inside.max(initial=0.0), abs(grad[-1])))


def _step(b: np.ndarray, grad: np.ndarray, second: np.ndarray, free: np.ndarray, s: LinearSetting) -> np.ndarray:
    """The minimum of the penalised quadratic model around ``b``, by coordinate descent; ``free`` marks coefficients that may move."""
    l1, l2 = s.reg * s.elastic_net, s.reg * (1 - s.elastic_net)
    new, slope = b.copy(), grad.copy()  # slope: of the model at ``new``
    curve = np.diag(second)
    for _ in range(1000):
        most = 0.0
        for j in np.flatnonzero(free):
            if curve[j] <= 0:
                continue
            last = j == len(b) - 1
            aim = curve[j] * new[j] - slope[j]
            value = aim / curve[j] if last else np.sign(aim) * max(abs(aim) - l1, 0.0) / (curve[j] + l2)
            if (change := value - new[j]) != 0.0:
                slope += second[:, j] * change
                new[j] = value
                most = max(most, abs(change) * np.sqrt(curve[j]))
        if most < 1e-12:
            break
    return new


def fit_linear_grid(df: DataFrame, settings: Sequence[LinearSetting], features="features", label: str = "label", width: int | None = None,
                    tolerance: float = 1e-9) -> list[LinearFit]:
    """A fit for each of ``settings``, all from the same passes over ``df``.

    ``features`` is a vector, map or sparse column or a list of columns, null and absent entries 0; ``width`` is the number
    of features where a sparse column does not tell. Settings that differ in ``max_iter`` only, which bounds the passes, are one
    fit until the smaller bound. Feature spaces wider than ``MAX_WIDTH`` are an error: they are for the estimator, one setting at a time.
    Rows without a label are left out. Without rows of both labels coefficients are 0 and the intercept is infinite or, without rows, 0.
    """
    feats = feats_column(df, features)
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), feats.alias("feats")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if width is None:
            width = len(features) if not isinstance(features, str) else int(rows.agg(F.max(F.array_max(F.transform("feats", lambda e: e["f"])))).first()[0] or 0) + 1
        if width > MAX_WIDTH:
            raise ValueError(f"{width} features are more than {MAX_WIDTH}")
        n, positives, deviation = _moments(rows, width)
        free = np.append(deviation > 0, True)
        scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1.0), 0.0)
        if positives in (0, n):
            sure = 0.0 if not n else (np.inf if positives else -np.inf)
            return [LinearFit(s, np.zeros(width), sure, 0.0, 0.0, 0) for s in settings]
        problems = sorted({(s.reg, s.elastic_net) for s in settings})
        bare = [LinearSetting(*p, max(s.max_iter for s in settings if (s.reg, s.elastic_net) == p)) for p in problems]
        bounds = [sorted({s.max_iter for s in settings if (s.reg, s.elastic_net) == p}) for p in problems]
        start = np.append(np.zeros(width), np.log(positives / (n - positives)))
        at = np.tile(start, (len(problems), 1))
        best: list[tuple | None] = [None] * len(problems)  # (coefficients, objective, violation, derivatives)
        reached: list[dict[int, tuple]] = [{} for _ in problems]
        open_ = list(range(len(problems)))
        for passes in range(1, max(s.max_iter for s in settings) + 2):
            loss, grad, second = _derivatives(rows, scale, at[open_])
            for i, m in enumerate(list(open_)):
                value = loss[i] / n + _penalty(at[m], bare[m])
                if best[m] is None or value <= best[m][1] + 1e-15:
                    gain = np.inf if best[m] is None else best[m][1] - value
                    best[m] = (at[m].copy(), value, _violation(at[m], grad[i] / n, bare[m]), passes - 1)
                    at[m] = _step(at[m], grad[i] / n, second[i] / n, free, bare[m])
                    done = best[m][2] < tolerance or gain < 1e-15
                else:  # too long a step: half of it
                    at[m] = (at[m] + best[m][0]) / 2
                    done = np.abs(at[m] - best[m][0]).max() < 1e-12
                for bound in bounds[m]:
                    if passes - 1 <= bound:
                        reached[m][bound] = best[m]
                if done or passes > bare[m].max_iter:
                    open_.remove(m)
            if not open_:
                break
        place = {p: m for m, p in enumerate(problems)}
        fits = []
        for s in settings:
            b, value, violation, passes = reached[place[s.reg, s.elastic_net]][s.max_iter]
            fits.append(LinearFit(s, b[:-1] * scale, float(b[-1]), float(value), violation, passes))
        return fits
    finally:
        rows.unpersist()


def grid_scores(df: DataFrame, fits: Sequence[LinearFit], features="features") -> Column:
    """``array<double>``: the probability under each fit."""
    weights = np.array([f.coefficients for f in fits]).reshape(len(fits), -1)
    intercept = np.array([f.intercept for f in fits])

    @arrow_udf("array<double>")
    def scores(lists: pa.Array) -> pa.Array:
        entries = lists.flatten()
        ids = entries.field("f").to_numpy(zero_copy_only=False)
        values = entries.field("v").to_numpy(zero_copy_only=False)
        owner = list_owner(lists)
        known = (ids >= 0) & (ids < weights.shape[1])
        margin = np.array([np.bincount(owner[known], weights=w[ids[known]] * values[known], minlength=len(lists)) + b for w, b in zip(weights, intercept)])
        flat = (1 / (1 + np.exp(-np.clip(margin, -700, 700)))).T.ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * len(weights)), pa.array(flat))

    return scores(feats_column(df, features))
