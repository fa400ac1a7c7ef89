"""Whole searches: all settings trained together, compared on one split, the best trained again and judged on rows no search has seen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators.booster import BoostOptions, fit_boosted_grid, fit_boosted_trees
from clickforge.operators.linear_grid import LinearFit, LinearSetting, fit_linear_grid, grid_scores
from clickforge.operators.metrics import ScoreHistogram, evaluate_splits, per_label_rates
from clickforge.operators.sparse import feats_column
from clickforge.operators.trees import (
    TreeEnsemble,
    encode_leaves,
    encode_leaves_by_node,
    node_leaf_vocabulary,
    ordinal_leaf_vocabulary,
    string_leaf_vocabulary,
    tree_leaf,
    tree_predict,
)

REPORT_SCHEMA = "setting int, params string, auc double, auc_bound double"


@dataclass
class TreeSearch:
    """``report`` has one row for each setting; ``evaluation`` is of the model trained again, on the held-out split."""

    report: DataFrame
    best: BoostOptions
    model: TreeEnsemble
    evaluation: DataFrame


@dataclass
class LinearSearch:
    report: DataFrame
    fits: list[LinearFit]
    best: LinearFit
    scored: DataFrame
    evaluation: DataFrame
    rates: DataFrame


def tree_settings(depths: Sequence[int] = (6, 7, 8, 9), rounds: Sequence[int] = (50, 100, 150), etas: Sequence[float] = (0.05, 0.10, 0.15, 0.20),
                  **common) -> list[BoostOptions]:
    """The cross product of depths, rounds and step sizes."""
    return [BoostOptions(max_depth=d, num_round=n, eta=e, **common) for d, n, e in product(depths, rounds, etas)]


def linear_settings(regs: Sequence[float] = (0.2, 0.1, 0.01), iterations: Sequence[int] = (500, 1000, 1500),
                    nets: Sequence[float] = (0.5, 0.8, 1.0)) -> list[LinearSetting]:
    """The cross product of penalties, bounds on passes and shares of the absolute penalty."""
    return [LinearSetting(r, e, n) for r, n, e in product(regs, iterations, nets)]


def _best(found: list[tuple[float | None, float | None]]) -> int:
    """The setting with the highest AUC; of equal ones the first."""
    return max(range(len(found)), key=lambda i: (found[i][0] if found[i][0] is not None else -1.0, -i))


def tree_search(df: DataFrame, features, settings: Sequence[BoostOptions], label: str = "label", split: str = "split", row_id: str | None = None,
                train: str = "train", valid: str = "eval", test: str = "test", classes: int = 16384, path: str | None = None) -> TreeSearch:
    """Train every setting on ``train``, compare them by AUC on ``valid``, train the best on both and judge it on ``test``.

    The AUC of each setting comes from the training passes themselves, with its error bound. The model is saved to ``path`` if given.
    """
    results = fit_boosted_grid(df.where(F.col(split).isin(train, valid)).withColumn(split, F.when(F.col(split) == train, "train").otherwise(F.col(split))),
                               features, label, settings, split=split, row_id=row_id, metrics={"auc": ScoreHistogram(classes)}, last_only=True)
    found = []
    for o, r in zip(settings, results):
        last = {name: value for round_, part, name, value in r.history if part == valid and round_ == o.num_round - 1}
        found.append((last.get("auc"), last.get("auc_bound")))
    spark = df.sparkSession
    rows = [(i, f"depth={o.max_depth}, rounds={o.num_round}, eta={o.eta}", *found[i]) for i, o in enumerate(settings)]
    best = settings[_best(found)]
    whole = df.withColumn(split, F.when(F.col(split).isin(train, valid), "train").otherwise(F.col(split)))
    model = fit_boosted_trees(whole, features, label, best, split=split, row_id=row_id).model
    if path is not None:
        model.save(spark, path)
    scored = tree_predict(df.where(F.col(split) == test), model, features)
    return TreeSearch(spark.createDataFrame(rows, REPORT_SCHEMA), best, model, evaluate_splits(scored, label, "probability", [split]))


def linear_search(df: DataFrame, settings: Sequence[LinearSetting], features="features", label: str = "label", split: str = "split",
                  train: str = "train", valid: str = "eval", test: str = "test", width: int | None = None, classes: int = 16384) -> LinearSearch:
    """As ``tree_search``, for the penalties of a logistic regression; ``rates`` are those of the test split by label."""
    held = df.withColumn("__feats", feats_column(df, features))
    fits = fit_linear_grid(held.where(F.col(split) == train), settings, "__feats", label, width)
    judged = held.where(F.col(split) == valid).withColumn("__scores", grid_scores(held, fits, "__feats"))
    scores = [F.get("__scores", F.lit(i)) for i in range(len(fits))]
    by = ScoreHistogram(classes).evaluate_many(judged, F.col(label), scores, F.lit(valid))
    found = [by.get((valid, i), (None, None)) for i in range(len(fits))]
    spark = df.sparkSession
    rows = [(i, f"reg={s.reg}, iterations={s.max_iter}, net={s.elastic_net}", *found[i]) for i, s in enumerate(settings)]
    chosen = settings[_best(found)]
    best = fit_linear_grid(held.where(F.col(split).isin(train, valid)), [chosen], "__feats", label, len(fits[0].coefficients))[0]
    scored = held.where(F.col(split) == test).withColumn("probability", F.get(grid_scores(held, [best], "__feats"), F.lit(0)))
    scored = scored.withColumn("prediction", (F.col("probability") > 0.5).cast("double")).drop("__feats")
    return LinearSearch(spark.createDataFrame(rows, REPORT_SCHEMA), fits, best, scored,
                        evaluate_splits(scored, label, "probability", [split]), per_label_rates(scored, label, "prediction"))


def leaf_features(df: DataFrame, model: TreeEnsemble, features, encoding: str = "node", known: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``leaf_features`` (sparse, one 1 for each tree), and their number.

    ``encoding`` is node (the node id is the category), ordinal (leaves numbered by node id, from the model alone) or string
    (leaves by falling frequency). For node and string, ``known`` are the rows whose leaves make the vocabulary, by default all.
    """
    leaved = tree_leaf(df, model, features)
    base = leaved if known is None else tree_leaf(known, model, features)
    if encoding == "node":
        vocabulary = node_leaf_vocabulary(base)
        size = vocabulary.agg(F.max(F.col("offset") + F.col("size"))).first()[0] or 0
        hot = encode_leaves_by_node(leaved, vocabulary)
    elif encoding in ("ordinal", "string"):
        vocabulary = ordinal_leaf_vocabulary(df.sparkSession, model) if encoding == "ordinal" else string_leaf_vocabulary(base)
        size = vocabulary.count()
        hot = encode_leaves(leaved, vocabulary)
    else:
        raise ValueError(f"unknown encoding {encoding}")
    feats = F.transform("onehot", lambda p: F.struct(p.cast("int").alias("f"), F.lit(1.0).alias("v")))
    return hot.withColumn("leaf_features", feats).drop("onehot"), int(size)


def leaf_search(df: DataFrame, features, options: BoostOptions, settings: Sequence[LinearSetting], encoding: str = "node", label: str = "label",
                split: str = "split", row_id: str | None = None) -> LinearSearch:
    """Fixed trees from the training split, their leaves one-hot, and a search over the penalties of the regression on top."""
    model = fit_boosted_trees(df, features, label, options, split=split, row_id=row_id).model
    encoded, size = leaf_features(df, model, features, encoding, df.where(F.col(split) == "train"))
    encoded = encoded.persist(StorageLevel.MEMORY_AND_DISK)
    return linear_search(encoded, settings, "leaf_features", label, split, width=size)
