"""Logistic regression and scoring with a saved linear model."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from clickforge.functions import predicted_class, sigmoid
from clickforge.operators.sparse import FEATS_TYPE, entry_rows, list_owner
from clickforge.shared import cut_lineage
from clickforge.sources.writers import INTERCEPT_INDEX

# Weights that a driver and every task may hold as an array, 8 bytes each.
DENSE_WEIGHTS = 4_000_000
# Places of a wide model's weight, so that an id of every row is spread.
SALTS = 16
# A round that has not lowered the loss after this many halvings of its step changes nothing.
HALVINGS = 20


def logistic_regression(max_iter: int = 100, reg: float = 0.3, elastic_net: float = 0.2,
                        features: str = "features", label: str = "label") -> LogisticRegression:
    """The elastic-net classifier with the training jobs' defaults."""
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net,
                              featuresCol=features, labelCol=label)


def _dense_margin(dense: np.ndarray, intercept: float, feats: str | Column) -> Column:
    """Intercept plus the dot product of a sparse row with the weights; ids beyond them count nothing, one below 0 is an error."""
    size = len(dense)

    @arrow_udf(T.DoubleType())
    def margin(lists: pa.Array) -> pa.Array:
        entries = lists.flatten()
        ids = entries.field("f").to_numpy(zero_copy_only=False)
        values = entries.field("v").to_numpy(zero_copy_only=False)
        if len(ids) and ids.min() < 0:
            raise ValueError(f"feature id {ids.min()} below 0")
        known = ids < size
        products = np.zeros(len(ids))
        products[known] = dense[ids[known]] * values[known]
        return pa.array(np.bincount(list_owner(lists), weights=products, minlength=len(lists)) + intercept)

    return margin(F.col(feats) if isinstance(feats, str) else feats)


def linear_score(df: DataFrame, weights: DataFrame, feats: str = "feats", dense_limit: int = DENSE_WEIGHTS) -> DataFrame:
    """Append ``margin``, ``probability`` and ``prediction`` from ``(index, weight)`` rows.

    Up to ``dense_limit`` ids, which one aggregation finds out, the weights travel as an array with the function and rows are
    neither exploded nor shuffled. A wider model stays in Spark, see :func:`_wide_margin`. A feature id below 0 is an error.
    """
    spark = df.sparkSession
    body = weights.where(F.col("index") != INTERCEPT_INDEX)
    last, intercept = weights.agg(
        F.max("index"), F.coalesce(F.max(F.when(F.col("index") == INTERCEPT_INDEX, F.col("weight"))), F.lit(0.0))).first()
    size = max(-1 if last is None else last, -1) + 1
    if size <= dense_limit:
        dense = np.zeros(size)
        for r in body.collect():
            dense[r["index"]] = r["weight"]
        scored = df.withColumn("margin", _dense_margin(dense, intercept, feats))
    else:
        scored = _wide_margin(spark, df, body, intercept, feats)
    scored = scored.withColumn("probability", sigmoid(F.col("margin")))
    return scored.withColumn("prediction", predicted_class(F.col("probability")))


def _wide_margin(spark: SparkSession, df: DataFrame, weights: DataFrame, intercept: float, feats: str) -> DataFrame:
    """The margin for weights that no single task or driver holds.

    Weights and entries meet by feature id and a salt, so an id that every row has is spread over ``SALTS`` tasks; each task
    adds up what it has of a row before the sums are shuffled. The numbering of the rows is written to the shared folder,
    because it has to stay put when a lost executor's tasks run again.
    """
    numbered = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    places = weights.select(F.col("index").alias("f"), "weight", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    checked = F.when(F.col("f") < 0, F.raise_error(F.concat(F.lit("feature id below 0: "), F.col("f").cast("string"))).cast("int"))
    entries = entry_rows(numbered, feats, ["__row"]).select(
        "__row", F.coalesce(checked, F.col("f")).alias("f"), "v", F.pmod("__row", F.lit(SALTS)).cast("int").alias("__salt"))
    sums = entries.join(places, ["f", "__salt"]).groupBy("__row").agg(F.sum(F.col("weight") * F.col("v")).alias("__sum"))
    joined = numbered.join(sums, "__row", "left")
    return joined.withColumn("margin", F.coalesce("__sum", F.lit(0.0)) + intercept).drop("__row", "__sum")


# ---------------------------------------------------------------- linear booster

@dataclass(frozen=True)
class LinearBooster:
    """Weights by feature id and the intercept; ``history`` has the penalised mean loss before the first and after each round."""

    weights: np.ndarray
    intercept: float
    history: tuple[float, ...]

    def to_df(self, spark: SparkSession) -> DataFrame:
        """``(index, weight)`` rows, weights of 0 left out, as :func:`linear_score` reads them."""
        some = [(int(i), float(self.weights[i])) for i in np.flatnonzero(self.weights)]
        return spark.createDataFrame([(INTERCEPT_INDEX, float(self.intercept)), *some], "index int, weight double")


def fit_linear_booster(df: DataFrame, width: int, rounds: int = 4, eta: float = 0.5, alpha: float = 0.0001, reg: float = 0.0,
                       features: str = "feats", label: str = "label") -> LinearBooster:
    """Boost a linear model: each round moves all coefficients at once along their own coordinates, under L1 (and L2).

    One aggregation per round gives every feature's sums of gradient and second derivative at the present weights, the
    intercept's and the loss. A coefficient's step goes to the minimum of its own penalised quadratic, which for ``alpha`` is a
    soft threshold, shortened by ``eta``. Steps taken together may overshoot where features overlap: when the next pass finds
    that the penalised loss did not fall, the round's step is halved and taken again, so the loss falls in every round. Sums
    are combined before the shuffle and the driver gets one row per feature, at most ``width`` (up to ``DENSE_WEIGHTS``).

    Absent, null and NaN values count as 0, rows without a label are left out. Without any row the model is 0.
    """
    if not 0 < width <= DENSE_WEIGHTS:
        raise ValueError(f"width must be between 1 and {DENSE_WEIGHTS}")
    spark = df.sparkSession
    clean = F.filter(F.col(features), lambda s: s["v"].isNotNull() & ~F.isnan(s["v"]))
    rows = df.select(F.col(label).cast("double").alias("y"), F.coalesce(clean, F.expr(f"cast(array() as {FEATS_TYPE})")).alias("x"))
    rows = rows.where("y is not null").persist(StorageLevel.DISK_ONLY)
    point, intercept = np.zeros(width), 0.0
    n, loss, change, shift = _booster_pass(rows, point, intercept, alpha, reg)
    history = [loss]
    for _ in range(rounds if n else 0):
        step = eta
        for _ in range(HALVINGS):
            tried = point + step * change, intercept + step * shift
            _, reached, then, then_shift = _booster_pass(rows, *tried, alpha, reg)
            if reached < loss:
                (point, intercept), loss, change, shift = tried, reached, then, then_shift
                break
            step /= 2
        history.append(loss)
    rows.unpersist()
    return LinearBooster(point, intercept, tuple(history))


def _booster_pass(rows: DataFrame, weights: np.ndarray, intercept: float, alpha: float, reg: float) -> tuple[int, float, np.ndarray, float]:
    """The number of rows, the penalised mean loss, and each weight's and the intercept's step at these weights."""
    scored = rows.withColumn("z", _dense_margin(weights, intercept, "x"))
    # log(1 + exp(z)) - y z without overflow.
    loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
    p = sigmoid(F.col("z"))
    # The intercept is one more entry of each row.
    bias = F.struct(F.lit(INTERCEPT_INDEX).alias("f"), F.lit(1.0).alias("v"))
    entries = scored.select((p - F.col("y")).alias("g"), (p * (1 - p)).alias("h"), loss.alias("loss"), F.inline_outer(F.concat("x", F.array(bias))))
    found = entries.groupBy("f").agg(
        F.sum(F.col("g") * F.col("v")).alias("g"), F.sum(F.col("h") * F.col("v") * F.col("v")).alias("h"),
        F.sum("loss").alias("loss"), F.count("*").alias("n")).collect()
    sums = {r["f"]: r for r in found}
    if INTERCEPT_INDEX not in sums:
        return 0, 0.0, np.zeros(len(weights)), 0.0
    total = sums.pop(INTERCEPT_INDEX)
    n = total["n"]
    slope, curve = np.zeros(len(weights)), np.zeros(len(weights))
    for f, r in sums.items():
        if f >= len(weights):
            raise ValueError(f"feature id {f} outside [0, {len(weights)})")
        slope[f], curve[f] = r["g"], r["h"]
    mean = total["loss"] / n + alpha * np.abs(weights).sum() + reg / 2 * (weights * weights).sum()
    # The minimum of slope * d + curve * d^2 / 2 + n * (alpha * |w + d| + reg * (w + d)^2 / 2) over w + d.
    pull = curve * weights - slope
    target = np.sign(pull) * np.maximum(np.abs(pull) - n * alpha, 0.0)
    change = np.where(curve > 0, target / np.where(curve > 0, curve + n * reg, 1.0) - weights, 0.0)
    return n, mean, change, -total["g"] / max(total["h"], 1e-16)
