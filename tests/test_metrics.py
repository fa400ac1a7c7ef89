import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from clickforge.operators import metrics as m


def brute_auc(rows):
    pairs = [(1.0 if p > n else 0.5 if p == n else 0.0) for y, p in rows if y for z, n in rows if not z]
    return sum(pairs) / len(pairs)


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = [(float(rng.random() < 0.3), round(rng.random(), 2), rng.choice(["train", "test"])) for _ in range(400)]
    return rows, spark.createDataFrame(rows, "label double, score double, split string").cache()


def test_auc_matches_pair_counting(scored):
    rows, df = scored
    assert m.auc(df).first()["auc"] == pytest.approx(brute_auc([(y, p) for y, p, _ in rows]))
    per = {r["split"]: r["auc"] for r in m.auc(df, by=["split"]).collect()}
    for split in ("train", "test"):
        assert per[split] == pytest.approx(brute_auc([(y, p) for y, p, s in rows if s == split]))


def test_auc_over_several_blocks(scored, monkeypatch):
    rows, df = scored
    monkeypatch.setattr(m, "BLOCKS", 3)
    assert m.auc(df).first()["auc"] == pytest.approx(brute_auc([(y, p) for y, p, _ in rows]))


def test_auc_near_the_binned_evaluator(scored):
    _, df = scored
    binned = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(df)
    assert m.auc(df).first()["auc"] == pytest.approx(binned, abs=0.01)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.5, "t"), (1.0, 0.7, "t")], "label double, score double, split string")
    row = m.evaluate_splits(df).first()
    assert row["auc"] is None and row["ne"] is None and row["calibration"] == pytest.approx(0.6)
    none = df.withColumn("label", F.lit(0.0))
    assert m.evaluate_splits(none).first()["calibration"] is None


def test_certain_scores_are_clipped_and_counted(spark):
    df = spark.createDataFrame([(1.0, 0.0, "t"), (0.0, 0.5, "t")], "label double, score double, split string")
    row = m.evaluate_splits(df).first()
    assert row["n_clipped"] == 1
    assert row["logloss"] == pytest.approx((-math.log(1e-15) - math.log(0.5)) / 2)


def test_missing_and_nan_scores_do_not_turn_into_numbers(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, float("nan"))], "label double, score double")
    rows = [r[0] for r in df.select(m.row_log_loss(F.col("label"), F.col("score"))).collect()]
    assert rows[0] is None and math.isnan(rows[1])


def test_evaluation_scans_once(scored):
    _, df = scored
    plan = m.evaluate_splits(df)._jdf.queryExecution().toString()
    assert plan.count("InMemoryTableScan [") == 1


def test_rates_match_mllib(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(3)), float(rng.randrange(4))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = m.weighted_rates(df).first()
    for name, column in [("f1", "f"), ("weightedPrecision", "precision"), ("weightedRecall", "recall"),
                         ("weightedFalsePositiveRate", "fpr"), ("accuracy", "accuracy")]:
        assert ours[column] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df)), name


def test_same_predictions(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id int, p double")
    assert m.same_predictions(a, a.select("p", "id")).count() == 0
    assert m.same_predictions(a, a.withColumn("p", F.col("p") + F.col("id"))).count() == 4


def test_auc_of_any_doubles(spark):
    """Scores below the ninth digit, huge, infinite, negative, zero of both signs, missing and not a number."""
    rng = random.Random(4)
    kinds = [lambda: rng.random() * 1e-12, lambda: rng.random() * 1e300, lambda: -rng.random(), lambda: -0.0, lambda: 0.0, lambda: float("inf"), lambda: float("-inf"),
             lambda: 5e-324, lambda: -5e-324, lambda: float("nan"), lambda: None, lambda: rng.choice([1e-10, 2e-10])]
    rows = [(float(rng.random() < 0.4), rng.choice(kinds)()) for _ in range(600)]
    found = m.auc(spark.createDataFrame(rows, "label double, score double"), unscored=True).first()
    known = [(y, s) for y, s in rows if s is not None and s == s]
    pairs = [(a > b) + (a == b) / 2 for y, a in known if y for z, b in known if not z]
    assert found["auc"] == pytest.approx(sum(pairs) / len(pairs), abs=1e-12) and found["n_unscored"] == 600 - len(known)
    two = spark.createDataFrame([(1.0, 2e-10), (0.0, 1e-10), (1.0, None)], "label double, score double")
    assert m.auc(two).first()["auc"] == 1.0
    whole = m.evaluate_splits(two.withColumn("split", F.lit("x"))).first()
    assert (whole["auc"], whole["n"], whole["positives"]) == (1.0, 3, 2)
