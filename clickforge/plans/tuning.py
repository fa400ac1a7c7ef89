"""Grids, train-validation split, cross-validation and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.operators.booster import BoostOptions, fit_boosted_trees
from clickforge.operators.metrics import error_at_half
from clickforge.operators.splits import k_fold
from clickforge.plans.estimator import BoostedTreesClassifier


def tree_grid(trees: BoostedTreesClassifier, depths: Sequence[int] = (6, 7, 8, 9),
              rounds: Sequence[int] = (50, 100, 150), etas: Sequence[float] = (0.05, 0.10, 0.15, 0.20)) -> list[dict]:
    return (
        ParamGridBuilder().addGrid(trees.maxDepth, list(depths)).addGrid(trees.numRound, list(rounds))
        .addGrid(trees.eta, list(etas)).build()
    )


def linear_grid(lr: LogisticRegression, regs: Sequence[float] = (0.2, 0.1, 0.01),
                iterations: Sequence[int] = (500, 1000, 1500),
                nets: Sequence[float] = (0.5, 0.8, 1.0)) -> list[dict]:
    return (
        ParamGridBuilder().addGrid(lr.regParam, list(regs)).addGrid(lr.maxIter, list(iterations))
        .addGrid(lr.elasticNetParam, list(nets)).build()
    )


def auc_evaluator(label: str = "label", score: str = "probability") -> BinaryClassificationEvaluator:
    """Binned area under ROC, quick enough to rank settings; reports use the exact one."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName="areaUnderROC")


def train_validation(estimator: Estimator, grid: list[dict], evaluator: Evaluator, ratio: float = 0.99,
                     parallelism: int = 4, seed: int = 123) -> TrainValidationSplit:
    return TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                                trainRatio=ratio, parallelism=parallelism, seed=seed)


def cross_validation(estimator: Estimator, grid: list[dict], evaluator: Evaluator, folds: int = 3,
                     fold_col: str = "", parallelism: int = 2, seed: int = 123) -> CrossValidator:
    """``fold_col`` takes fold numbers from the data, e.g. from a key, so that runs can be repeated."""
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                          foldCol=fold_col, parallelism=parallelism, seed=seed)


def grid_report(spark: SparkSession, grid: list[dict], metrics: Sequence[float]) -> DataFrame:
    """``(setting, params, metric)`` of a search, in grid order."""
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda e: e[0].name)), float(m))
            for i, (g, m) in enumerate(zip(grid, metrics))]
    return spark.createDataFrame(rows, "setting int, params string, metric double")


def best_params(spark: SparkSession, model) -> DataFrame:
    """``(param, value)`` of a fitted model."""
    rows = [(p.name, str(v)) for p, v in model.extractParamMap().items()]
    return spark.createDataFrame(sorted(rows), "param string, value string")


def objective_history(spark: SparkSession, summary) -> DataFrame:
    """``(iteration, objective)`` of a fitted linear model's training summary."""
    rows = [(i, float(v)) for i, v in enumerate(summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, objective double")


def boosted_cross_validation(df: DataFrame, features, key: str, label: str = "label", folds: int = 5,
                             options: BoostOptions | None = None, metrics: dict | None = None) -> DataFrame:
    """Train and test metrics per round, averaged over the folds.

    Returns ``(round, metric, train_mean, train_std, test_mean, test_std)``.
    """
    metrics = metrics or {"error": error_at_half}
    history = []
    for fold in range(folds):
        part = df.withColumn("__split", F.when(k_fold(key, folds) == fold, "test").otherwise("train"))
        history += fit_boosted_trees(part, features, label, options, split="__split", row_id=key, metrics=metrics).history
    rows = df.sparkSession.createDataFrame(history, "round int, split string, metric string, value double")
    of = lambda name: F.when(F.col("split") == name, F.col("value"))
    return rows.groupBy("round", "metric").agg(
        F.avg(of("train")).alias("train_mean"), F.stddev_pop(of("train")).alias("train_std"),
        F.avg(of("test")).alias("test_mean"), F.stddev_pop(of("test")).alias("test_std"),
    )
