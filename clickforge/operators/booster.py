"""Gradient-boosted trees grown level by level from Spark aggregations, one model or a whole grid of them in the same passes.

Rows are binned once and cached as ``codes`` (see ``binning``). Each level of a round is one pass over the cache for all models and
classes together (see ``growth``); only the winning splits reach the driver. Margins, one for each model and class, are
updated once per round by a walk over the codes.

Settings that differ in rounds only are prefixes of one model, so they share its growth as well. Every few rounds the rows are written to the
shared folder with their margins and read again: plans stay short, a lost executor costs a read of its rows and a few walks, and
the work grows in proportion to the rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from clickforge.functions import sigmoid
from clickforge.operators.binning import Cuts, bin_codes, find_cuts
from clickforge.operators.growth import Layout, NodeSplit, RoundGrower
from clickforge.operators.metrics import ScoreHistogram
from clickforge.operators.sparse import feats_column, list_owner
from clickforge.operators.trees import MATRIX_CELLS, TreeEnsemble, softmax
from clickforge.operators.walk import FlatTree, dense_columns, used_features, walk_tree
from clickforge.shared import drop_scratch, scratch_path

# (margin, label) -> (gradient, hessian)
Objective = Callable[[Column, Column], tuple[Column, Column]]
# (label, score) -> aggregate, or a histogram of the scores
Metric = Callable[[Column, Column], Column] | ScoreHistogram

MIN_GAIN = 1e-6
MIN_HESSIAN = 1e-16


@dataclass(frozen=True)
class BoostOptions:
    """Training options under their customary names and defaults."""

    num_round: int = 100
    max_depth: int = 8
    eta: float = 0.1
    reg_lambda: float = 1.0
    alpha: float = 0.0
    gamma: float = 0.2
    min_child_weight: float = 2.0
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    scale_pos_weight: float = 1.0
    num_class: int = 1
    max_bins: int = 256
    missing: float | None = None
    seed: int = 123
    rebuild_interval: int = 20
    partitions: int | None = None

    @property
    def shared(self) -> tuple:
        """What settings must have in common to grow over the same rows, cuts and samples."""
        return (self.subsample, self.colsample_bytree, self.num_class, self.max_bins, self.missing, self.seed, self.rebuild_interval, self.partitions)


def logistic_gradient(margin: Column, label: Column) -> tuple[Column, Column]:
    """Gradient and hessian of the logistic loss."""
    p = sigmoid(margin)
    return p - label, F.greatest(p * (1 - p), F.lit(MIN_HESSIAN))


def weighted_gradient(margin: Column, label: Column, scale_pos_weight: float = 1.0,
                      objective: Objective = logistic_gradient) -> tuple[Column, Column]:
    """Gradient pair with the positives' weight applied."""
    g, h = objective(margin, label)
    if scale_pos_weight == 1.0:
        return g, h
    weight = F.when(label == 1, scale_pos_weight).otherwise(1.0)
    return g * weight, h * weight


def _gradient_arrays(models: Sequence[BoostOptions], objective: Objective) -> tuple[Column, Column]:
    """The gradient pairs of all outputs, model by model."""
    label, k = F.col("label"), models[0].num_class
    if k == 1:
        pairs = [weighted_gradient(F.get("margins", F.lit(i)), label, o.scale_pos_weight, objective) for i, o in enumerate(models)]
        return F.array(*[g for g, _ in pairs]), F.array(*[h for _, h in pairs])
    p = F.col("p")
    g = F.transform(p, lambda q, o: q - F.when(label == o % k, 1.0).otherwise(0.0))
    h = F.transform(p, lambda q: F.greatest(2.0 * q * (1 - q), F.lit(MIN_HESSIAN)))
    return g, h


def _sampled(options: BoostOptions, round_: int) -> Column:
    """Deterministic row sample of the round."""
    if options.subsample >= 1:
        return F.lit(True)
    draw = F.pmod(F.xxhash64("row_id", F.lit(round_), F.lit(options.seed)), F.lit(1_000_000))
    return draw < int(options.subsample * 1_000_000)


def _sampled_features(options: BoostOptions, count: int, round_: int) -> np.ndarray:
    keep = np.ones(count, bool)
    if options.colsample_bytree < 1:
        take = max(1, int(options.colsample_bytree * count))
        order = np.random.default_rng([options.seed, round_]).permutation(count)
        keep[order[take:]] = False
    return keep


class _GrowingTree:
    """One class's tree in bin space; features are positions in the cut table."""

    def __init__(self, class_id: int, g: float, h: float):
        self.class_id = class_id
        self.nodes = [self._leaf(0, -1, 0, g, h)]
        self.open = [0]

    @staticmethod
    def _leaf(node: int, parent: int, depth: int, g: float, h: float) -> dict:
        return {"node": node, "parent": parent, "depth": depth, "is_leaf": True, "g": g, "h": h, "leaf_value": 0.0}

    def flat(self) -> FlatTree:
        return FlatTree.from_nodes(self.nodes)

    def grow(self, splits: list[NodeSplit]) -> None:
        """Split the open nodes; nodes without a gaining split stay leaves. ``open`` then lists the children, pair by pair."""
        grown: list[int] = []
        for s in sorted(splits, key=lambda s: s.node):
            if s.node not in self.open or s.gain <= MIN_GAIN:
                continue
            parent = self.nodes[s.node]
            left, right = len(self.nodes), len(self.nodes) + 1
            parent.update(is_leaf=False, feature=s.feature, threshold=float(s.bin), left=left, right=right,
                          default_left=s.default_left, gain=s.gain)
            depth = parent["depth"] + 1
            self.nodes.append(self._leaf(left, s.node, depth, s.g_left, s.h_left))
            self.nodes.append(self._leaf(right, s.node, depth, parent["g"] - s.g_left, parent["h"] - s.h_left))
            grown += [left, right]
        self.open = grown

    def prune(self, gamma: float) -> None:
        """Undo, from the bottom up, splits of two leaves whose gain is not above ``gamma``."""
        for n in reversed(self.nodes):
            if not n["is_leaf"] and n["gain"] <= gamma and all(self.nodes[n[s]]["is_leaf"] for s in ("left", "right")):
                self.nodes[n["left"]]["gone"] = self.nodes[n["right"]]["gone"] = True
                n["is_leaf"] = True
        kept = [n for n in self.nodes if not n.get("gone")]
        number = {n["node"]: i for i, n in enumerate(kept)}
        self.nodes = [
            n | {"node": number[n["node"]], "parent": number.get(n["parent"], -1)}
            | ({} if n["is_leaf"] else {"left": number[n["left"]], "right": number[n["right"]]})
            for n in kept
        ]

    def set_leaf_values(self, options: BoostOptions) -> None:
        for n in self.nodes:
            if n["is_leaf"]:
                shrunk = np.sign(n["g"]) * max(abs(n["g"]) - options.alpha, 0.0)
                below = n["h"] + options.reg_lambda
                n["leaf_value"] = float(-shrunk / below * options.eta) if below > 0 else 0.0

    def model_rows(self, tree: int, cuts: Cuts) -> list[dict]:
        rows = []
        for n in self.nodes:
            row = {"tree": tree, "class_id": self.class_id, "node": n["node"], "parent": n["parent"],
                   "depth": n["depth"], "is_leaf": n["is_leaf"], "sum_hess": float(n["h"])}
            if n["is_leaf"]:
                row["leaf_value"] = n["leaf_value"]
            else:
                row |= {"feature": int(cuts.ids[n["feature"]]), "left": n["left"], "right": n["right"],
                        "threshold": cuts.threshold(n["feature"], int(n["threshold"])),
                        "default_left": n["default_left"], "gain": float(n["gain"])}
            rows.append(row)
        return rows


def _add_round(trees: list[FlatTree | None], shared: Broadcast[Layout]) -> Column:
    """The margins after adding the leaf values of a round, one tree for each output that grew."""
    used = used_features([t for t in trees if t is not None])

    @arrow_udf("array<double>")
    def added(lists: pa.Array, margins: pa.Array) -> pa.Array:
        layout = shared.value
        column_of = np.full(max(len(layout.code_start) - 1, 1), -1, np.int64)
        column_of[used] = np.arange(len(used))
        step = max(1, MATRIX_CELLS // max(1, len(used)))
        total = margins.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).copy()
        for i in range(0, len(lists), step):
            block = lists.slice(i, step)
            codes = block.flatten().to_numpy(zero_copy_only=False)
            feature = layout.feature_of[codes]
            matrix = dense_columns(list_owner(block), column_of[feature], codes - layout.code_start[feature], len(used), len(block))
            for o, tree in enumerate(trees):
                if tree is not None:
                    total[i:i + step, o] += tree.value[walk_tree(tree, matrix, column_of)]
        offsets = np.arange(len(lists) + 1, dtype=np.int32) * total.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))

    return added("codes", "margins")


@dataclass
class BoostResult:
    """The fitted model and, when metrics were asked for, ``(round, split, metric, value)`` rows.

    ``partitions``: the number in which the training rows came.
    """

    model: TreeEnsemble
    history: list[tuple[int, str, str, float | None]]
    partitions: int = 0

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, split string, metric string, value double")


def prepare_rows(df: DataFrame, features, label: str, options: BoostOptions, split: str | None = None,
                 row_id: str | None = None, margin: str | None = None, models: int = 1) -> tuple[DataFrame, Cuts]:
    """Bin the rows: ``(row_id, label, split, codes, margins)``. Cut points come from training rows; margins stand model by model."""
    k = options.num_class
    zero = F.array(*[F.lit(0.0)] * k)
    if margin is None:
        start = zero
    else:
        start = F.col(margin) if k > 1 else F.array(F.col(margin).cast("double"))
    if models > 1:
        start = F.flatten(F.array_repeat(start, models))
    rows = df.select(
        F.col(label).cast("double").alias("label"),
        (F.col(split) if split else F.lit("train")).alias("split"),
        feats_column(df, features).alias("feats"),
        start.alias("margins"),
        *([F.col(row_id).alias("row_id")] if row_id else []),
    )
    if row_id is None:
        rows = rows.withColumn("row_id", F.xxhash64("label", "feats"))
    cuts = find_cuts(rows.filter(F.col("split") == "train"), "feats", options.max_bins, missing=options.missing)
    binned = rows.select("row_id", "label", "split", bin_codes(F.col("feats"), cuts, options.missing).alias("codes"), "margins")
    return even_out(binned, cuts.input_partitions, options.partitions), cuts


def even_out(rows: DataFrame, partitions: int, wanted: int | None = None) -> DataFrame:
    """Deal rows out evenly, into ``wanted`` partitions or where they came in fewer than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if wanted or partitions < cores:
        return rows.repartition(wanted or cores)
    return rows


def _reread(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The binned table in cached partitions, and how many there are.

    Every task sends one partial histogram, so small partitions go together: as many as two for each core, or, where
    there is more data than that, four splits of the files each.
    """
    rows = spark.read.parquet(path)
    splits = rows.rdd.getNumPartitions()
    parts = min(splits, max(2 * spark.sparkContext.defaultParallelism, -(-splits // 4)))
    return rows.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK), parts


def fit_boosted_trees(df: DataFrame, features, label: str = "label", options: BoostOptions | None = None, *,
                      split: str | None = None, row_id: str | None = None, margin: str | None = None,
                      objective: Objective = logistic_gradient,
                      metrics: dict[str, Metric] | None = None) -> BoostResult:
    """Fit boosted trees on the rows whose ``split`` is ``train`` (all rows when not given).

    ``features`` is a vector, map or sparse column, or a list of numeric columns. ``row_id`` keys
    the row sample; without it equal rows are sampled together, so pass one where rows repeat.
    ``margin`` continues from an earlier model's raw output. ``metrics`` are
    evaluated on every split after every round, on the probability (binary models).
    """
    return fit_boosted_grid(df, features, label, [options or BoostOptions()], split=split, row_id=row_id, margin=margin, objective=objective, metrics=metrics)[0]


def fit_boosted_grid(df: DataFrame, features, label: str, settings: Sequence[BoostOptions], *,
                     split: str | None = None, row_id: str | None = None, margin: str | None = None,
                     objective: Objective = logistic_gradient,
                     metrics: dict[str, Metric] | None = None, last_only: bool = False) -> list[BoostResult]:
    """One result for each of ``settings``, each what ``fit_boosted_trees`` gives for it alone.

    All settings that share rows, cuts and samples grow in the same passes over one binned table; those that differ in
    ``num_round`` only are one model, cut at their rounds. With ``last_only``, metrics are taken after rounds that are the
    last of some setting only. Further arguments are those of ``fit_boosted_trees``.
    """
    results: list[BoostResult | None] = [None] * len(settings)
    for shared in dict.fromkeys(o.shared for o in settings):
        mine = [i for i, o in enumerate(settings) if o.shared == shared]
        models: dict[BoostOptions, int] = {}
        for i in mine:
            bare = replace(settings[i], num_round=0)
            models[bare] = max(models.get(bare, 0), settings[i].num_round)
        grown = _fit_together(df, features, label, [replace(o, num_round=n) for o, n in models.items()], split, row_id, margin, objective, metrics, {settings[i].num_round for i in mine} if last_only else None)
        found = dict(zip(models, grown))
        for i in mine:
            o = settings[i]
            whole = found[replace(o, num_round=0)]
            nodes = [n for n in whole.model.nodes if n["tree"] < o.num_round * o.num_class]
            results[i] = BoostResult(TreeEnsemble(nodes, o.num_class, o.missing), [h for h in whole.history if h[0] < o.num_round], whole.partitions)
    return results


def _fit_together(df: DataFrame, features, label: str, models: list[BoostOptions], split, row_id, margin, objective: Objective,
                  metrics: dict[str, Metric] | None, judged: set[int] | None = None) -> list[BoostResult]:
    """Models over the same rows, cuts and samples, each with its own rounds, depth and penalties."""
    first, k = models[0], models[0].num_class
    spark = df.sparkSession
    rows, cuts = prepare_rows(df, features, label, first, split, row_id, margin, len(models))
    path = scratch_path(spark, "boost")
    rows.write.parquet(path)
    current, tasks = _reread(spark, path)
    held = [current]
    widest = sum(k << max(o.max_depth - 1, 0) for o in models)
    shared = spark.sparkContext.broadcast(Layout.of(cuts, min(widest, 1 << 16), spark.sparkContext.defaultParallelism))
    nodes: list[list[dict]] = [[] for _ in models]
    history: list[list[tuple]] = [[] for _ in models]
    rounds = max(o.num_round for o in models)
    try:
        for round_ in range(rounds):
            trees = _grow_round(current, cuts, models, objective, round_, shared, tasks)
            for o, tree in enumerate(trees):
                if tree is not None:
                    nodes[o // k] += tree.model_rows(round_ * k + tree.class_id, cuts)
            if round_ + 1 == rounds and not metrics:
                break
            updated = current.withColumn("margins", _add_round([t.flat() if t is not None else None for t in trees], shared))
            if (round_ + 1) % first.rebuild_interval == 0:
                after = scratch_path(spark, "boost")
                updated.write.parquet(after)
                current, tasks = _reread(spark, after)
                current.count()  # filled before its source goes
                for copy in held:
                    copy.unpersist()
                drop_scratch(spark, path)
                path, held = after, [current]
            else:
                current = updated.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(current)
            if metrics and (judged is None or round_ + 1 in judged):
                for m, found in enumerate(_evaluate(current, round_, metrics, len(models))):
                    history[m] += found
            # The copy before the newest is still what the newest is filled from.
            while len(held) > 2:
                held.pop(0).unpersist()
    finally:
        for copy in held:
            copy.unpersist()
        drop_scratch(spark, path)
        shared.unpersist()
    return [BoostResult(TreeEnsemble(nodes[m], k, o.missing), history[m], cuts.input_partitions) for m, o in enumerate(models)]


def _evaluate(rows: DataFrame, round_: int, metrics: dict[str, Metric], models: int) -> list[list[tuple]]:
    """``(round, split, metric, value)`` of each model, all from one aggregation, and one for the score histograms."""
    plain = {name: m for name, m in metrics.items() if not isinstance(m, ScoreHistogram)}
    score = [sigmoid(F.get("margins", F.lit(m))) for m in range(models)]
    out: list[list[tuple]] = [[] for _ in range(models)]
    values: dict[tuple, float | None] = {}
    splits: set[str] = set()
    if plain:
        sums = [m(F.col("label"), score[i]).alias(f"{i} {name}") for i in range(models) for name, m in plain.items()]
        for r in rows.groupBy("split").agg(*sums).collect():
            splits.add(r["split"])
            values |= {(i, r["split"], name): r[f"{i} {name}"] for i in range(models) for name in plain}
    for name, m in metrics.items():
        if isinstance(m, ScoreHistogram):
            for (split, i), (value, bound) in m.evaluate_many(rows, F.col("label"), score, F.col("split")).items():
                splits.add(split)
                values |= {(i, split, name): value, (i, split, f"{name}_bound"): bound}
    names = [n for name, m in metrics.items() for n in ((name, f"{name}_bound") if isinstance(m, ScoreHistogram) else (name,))]
    for i in range(models):
        out[i] = [(round_, split, name, values.get((i, split, name))) for split in sorted(splits) for name in names]
    return out


def _grow_round(base: DataFrame, cuts: Cuts, models: list[BoostOptions], objective: Objective, round_: int,
                shared: Broadcast[Layout], tasks: int) -> list[_GrowingTree | None]:
    """The round's tree of each output: models in order, their classes in order; None where a model has its rounds."""
    first, k = models[0], models[0].num_class
    rows = base.filter((F.col("split") == "train") & _sampled(first, round_))
    if k > 1:
        parts = [softmax(F.slice("margins", 1 + k * m, k)) for m in range(len(models))]
        rows = rows.withColumn("p", F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0])
    g, h = _gradient_arrays(models, objective)
    rows = rows.select("codes", g.alias("g"), h.alias("h"))
    options = [o for o in models for _ in range(k)]
    keep = None
    if first.colsample_bytree < 1:
        keep = base.sparkSession.sparkContext.broadcast(_sampled_features(first, cuts.num_features, round_))
    grower = RoundGrower(rows, shared, tasks, keep)
    trees = grower.grow(
        [o.max_depth if round_ < o.num_round else None for o in options],
        [(o.reg_lambda, o.alpha, o.min_child_weight) for o in options], lambda o, g, h: _GrowingTree(o % k, g, h))
    if keep is not None:
        keep.unpersist()
    for o, tree in zip(options, trees):
        if tree is not None:
            tree.prune(o.gamma)
            tree.set_leaf_values(o)
    return trees
