"""Model and data writers."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT_INDEX = -1


def write_linear_model(spark: SparkSession, model: LogisticRegressionModel, path: str) -> None:
    """Non-zero ``(index, weight)`` rows plus the intercept under index -1."""
    weights = [(int(i), float(w)) for i, w in enumerate(model.coefficients.toArray()) if w != 0.0]
    rows = [(INTERCEPT_INDEX, float(model.intercept)), *weights]
    spark.createDataFrame(rows, "index int, weight double").coalesce(1).write.mode("overwrite").parquet(path)


def read_linear_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("index int, weight double").parquet(path)


def write_importance_csv(importance: DataFrame, path: str) -> None:
    """``feature_name,importance,order`` with a header, most important first."""
    (
        importance.select("feature_name", "importance", "order")
        .orderBy("order").coalesce(1)
        .write.mode("overwrite").csv(path, header=True)
    )


def write_libsvm(rows: DataFrame, path: str, start_index: int = 1) -> None:
    """``label id:value ...`` lines from ``(label, feats)`` with ids from ``start_index``."""
    pairs = F.transform(
        F.sort_array("feats"),
        lambda s: F.concat_ws(":", (s["f"] + start_index).cast("string"), s["v"].cast("string")),
    )
    line = F.concat_ws(" ", F.col("label").cast("string"), F.array_join(pairs, " "))
    rows.select(F.rtrim(line).alias("value")).write.mode("overwrite").text(path)
