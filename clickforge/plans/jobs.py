"""Training jobs from rows to an evaluation table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators.booster import BoostOptions, even_out, fit_boosted_trees
from clickforge.operators.features import hashing_tf, index_to_string, tokenizer
from clickforge.operators.linear import logistic_regression
from clickforge.operators.metrics import evaluate_splits
from clickforge.operators.sparse import feats_column, feats_to_vector
from clickforge.operators.trees import (
    TreeEnsemble,
    leaf_vector,
    string_leaf_vocabulary,
    tree_leaf,
    tree_predict,
)
from clickforge.plans.estimator import BoostedTreesClassifier


@dataclass
class LinearJob:
    model: LogisticRegressionModel
    scored: DataFrame
    evaluation: DataFrame


@dataclass
class TreesJob:
    model: TreeEnsemble
    scored: DataFrame
    evaluation: DataFrame


@dataclass
class TreesLinearJob:
    trees: TreeEnsemble
    linear: LogisticRegressionModel
    vocabulary: DataFrame
    scored: DataFrame
    evaluation: DataFrame


def train_linear(df: DataFrame, features: str = "features", label: str = "label", split: str = "split",
                 **options) -> LinearJob:
    """Logistic regression on the rows of split ``train``, evaluated on every split."""
    estimator = logistic_regression(features=features, label=label, **options)
    model = estimator.fit(df.filter(F.col(split) == "train"))
    scored = model.transform(df)
    return LinearJob(model, scored, evaluate_splits(scored, label, "probability", [split]))


def train_trees(df: DataFrame, features, label: str = "label", split: str = "split", row_id: str | None = None,
                options: BoostOptions | None = None) -> TreesJob:
    """Boosted trees on the rows of split ``train``, evaluated on every split."""
    model = fit_boosted_trees(df, features, label, options, split=split, row_id=row_id).model
    scored = tree_predict(df, model, features)
    return TreesJob(model, scored, evaluate_splits(scored, label, "probability", [split]))


def train_trees_linear(df: DataFrame, features, label: str = "label", split: str = "split",
                       row_id: str | None = None, options: BoostOptions | None = None,
                       stack_raw: bool = False, raw_size: int | None = None,
                       vocabulary_splits: tuple[str, ...] = ("train",), **linear) -> TreesLinearJob:
    """Trees, their leaves as one-hot features, and a logistic regression on top.

    ``stack_raw`` puts the raw features beside the leaves (``raw_size`` is their number).
    ``vocabulary_splits`` chooses the splits whose leaves are known to the encoding.
    """
    grown = fit_boosted_trees(df, features, label, options, split=split, row_id=row_id)
    trees = grown.model
    # A few large files would leave every pass of the regression, and the scoring, to as few tasks.
    leaved = tree_leaf(even_out(df, grown.partitions), trees, features).persist(StorageLevel.MEMORY_AND_DISK)
    vocabulary = string_leaf_vocabulary(leaved.filter(F.col(split).isin(*vocabulary_splits)))
    encoded = leaf_vector(leaved, vocabulary, output="leaf_features")
    inputs = "leaf_features"
    if stack_raw:
        size = raw_size or (len(features) if not isinstance(features, str) else None)
        if size is None:
            raise ValueError("raw_size is needed to stack a sparse feature column")
        encoded = encoded.withColumn("raw_features", feats_to_vector(feats_column(encoded, features), size))
        encoded = VectorAssembler(inputCols=["leaf_features", "raw_features"], outputCol="stacked").transform(encoded)
        inputs = "stacked"
    estimator = logistic_regression(features=inputs, label=label, **linear)
    model = estimator.fit(encoded.filter(F.col(split) == "train"))
    leaved.unpersist()
    scored = model.transform(encoded)
    return TreesLinearJob(trees, model, vocabulary, scored, evaluate_splits(scored, label, "probability", [split]))


def tabular_pipeline(columns: list[str], target: str, labels: list[str], **boost) -> Pipeline:
    """Assembler, label index, boosted trees, and the predicted label as text."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"),
        StringIndexer(inputCol=target, outputCol="target_index"),
        BoostedTreesClassifier(featuresCol="features", labelCol="target_index", **boost),
        index_to_string("prediction", "predicted_label", labels),
    ])


def text_pipeline(num_features: int = 1000, max_iter: int = 10, reg: float = 0.01, text: str = "text",
                  label: str = "label") -> Pipeline:
    """Tokenizer, term hashing and logistic regression."""
    return Pipeline(stages=[
        tokenizer(text, "words"),
        hashing_tf(num_features, "words", "features"),
        logistic_regression(max_iter, reg, 0.0, "features", label),
    ])
