"""Views over the test tables that the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.functions import sigmoid
from clickforge.operators.features import feature_map, featurize, parse_spec
from clickforge.operators.splits import key_split, mix_key
from clickforge.operators.trees import TreeEnsemble

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

SPEC = [
    "# impressions",
    "name=value;class=S_direct;slot=101;depend=value;is_hash=false;feat_type=0",
    "name=k;class=S_direct;slot=102;depend=k_seen;is_hash=false;feat_type=0",
    "",
    "name=hour;class=S_onehot;slot=201;depend=hour_of_day;is_hash=false;feat_values=" + ",".join(map(str, range(24))),
    "name=type;class=S_onehot;slot=202;depend=event_type;is_hash=false;feat_values=" + ",".join(EVENT_TYPES),
]
# Ids given by SPEC: 0 value, 1 k, 2..25 hour, 26..30 type.
SPEC_SIZE = 31

# Three small trees over those ids: {node: (feature, threshold, left, right, missing) or leaf value}.
FIXED_TREES = [
    {0: (0, 50.0, 1, 2, 1), 1: (1, 30.0, 3, 4, 4), 2: (12, 0.5, 5, 6, 5), 3: -0.4, 4: 0.1, 5: 0.25, 6: 0.9},
    {0: (1, 70.0, 1, 2, 2), 1: -0.3, 2: (0, 20.0, 3, 4, 3), 3: 0.2, 4: 0.7},
    {0: (26, 0.5, 1, 2, 1), 1: (0, 100.0, 3, 4, 3), 2: 0.35, 3: -0.15, 4: 0.05},
]

NUMERIC = ["value", "k_seen", "hour_of_day"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with a label, a fixed score and a planted, learnable label."""
    margin = 0.01 * F.col("value") - 0.02 * F.col("hour_of_day") - 1.4
    planted = ((F.col("value") > 50) & (F.col("hour_of_day") < 12)) | (F.col("k") > 70)
    flipped = F.col("noise") < 214_748_364
    return (
        table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("row_id"), "user_id", "event_type", "ts", "value",
            (F.col("event_type") == "click").cast("double").alias("label"),
            F.to_date("ts").alias("dt"), F.hour("ts").alias("hour_of_day"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            mix_key("event_id").alias("mix"), mix_key("event_id", salt=1).alias("noise"),
        )
        .withColumns({
            "k_seen": F.when(F.col("k") % 7 != 0, F.col("k")),
            "margin0": margin,
            "score": F.round(sigmoid(margin), 9),
            "planted": (planted != flipped).cast("int"),
            "split": key_split("row_id", [0.8, 0.1, 0.1], ["train", "eval", "test"]),
        })
        .drop("noise")
    )


def spec(spark: SparkSession) -> DataFrame:
    return parse_spec(spark.createDataFrame(list(enumerate(SPEC)), "line int, text string"))


def spec_map(spark: SparkSession) -> DataFrame:
    return feature_map(spec(spark))


def sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions with ``feats`` built from the specification; ``k`` is missing at its multiples of 7."""
    return featurize(impressions(spark, sf_dir), spec(spark))


def fixed_model() -> TreeEnsemble:
    return TreeEnsemble.from_splits(FIXED_TREES)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order, customer and part columns; label = returned."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with their class."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
