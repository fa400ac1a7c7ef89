import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickforge.operators import metrics as m
from clickforge.operators.booster import BoostOptions
from clickforge.operators.linear import logistic_regression
from clickforge.operators.metrics import same_predictions
from clickforge.plans import jobs, tuning, views
from clickforge.plans.estimator import BoostedTreesClassifier, BoostedTreesModel

QUICK = BoostOptions(num_round=3, max_depth=3, eta=0.5)


@pytest.fixture(scope="module")
def planted(spark, sf):
    return views.impressions(spark, sf).withColumn("label", F.col("planted").cast("double")).cache()


@pytest.fixture(scope="module")
def assembled(planted):
    return VectorAssembler(inputCols=["value", "k", "hour_of_day"], outputCol="features").transform(planted).select("row_id", "split", "label", "features")


def test_trees_linear_beats_linear_alone(spark, planted):
    both = jobs.train_trees_linear(planted, views.NUMERIC, row_id="row_id", options=QUICK, reg=0.01)
    filled = planted.fillna(0, ["k_seen"])
    vectors = VectorAssembler(inputCols=views.NUMERIC, outputCol="features").transform(filled)
    alone = jobs.train_linear(vectors, reg=0.01)
    auc = lambda e: {r["split"]: r["auc"] for r in e.collect()}
    assert auc(both.evaluation)["test"] > auc(alone.evaluation)["test"] - 0.02
    assert auc(both.evaluation)["train"] > auc(alone.evaluation)["train"]
    assert both.linear.numFeatures == both.vocabulary.count()


def test_stacked_features_and_wider_vocabulary(spark, planted):
    job = jobs.train_trees_linear(planted.fillna(0, ["k_seen"]), views.NUMERIC, row_id="row_id", options=QUICK, stack_raw=True,
                                  vocabulary_splits=("train", "test"), reg=0.01)
    assert job.linear.numFeatures == job.vocabulary.count() + 3
    assert job.evaluation.count() == 3


def test_trees_linear_deals_out_rows_of_few_partitions(spark, planted):
    """Rows of one file are encoded, fitted and scored on all cores, each once."""
    rows = planted.fillna(0, ["k_seen"]).coalesce(1)
    job = jobs.train_trees_linear(rows, views.NUMERIC, row_id="row_id", options=QUICK, stack_raw=True, reg=0.01)
    held = job.scored.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(held) == spark.sparkContext.defaultParallelism and max(r["count"] for r in held) < 2 * min(r["count"] for r in held)
    assert sorted(r[0] for r in job.scored.select("row_id").collect()) == sorted(r[0] for r in rows.select("row_id").collect())


def test_estimator_matches_the_function_and_survives_saving(spark, assembled, tmp_path):
    estimator = BoostedTreesClassifier(numRound=2, maxDepth=3, eta=0.5, leafCol="leaves", splitCol="split")
    model = estimator.fit(assembled)
    scored = model.transform(assembled)
    row = scored.first()
    assert len(row["leaves"]) == 2 and row["probability"].size == 2 and row["rawPrediction"][1] == -row["rawPrediction"][0]
    model.save(str(tmp_path / "m"))
    again = BoostedTreesModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid and again.getOrDefault("maxDepth") == 3
    assert same_predictions(scored.select("row_id", "prediction"), again.transform(assembled).select("row_id", "prediction")).count() == 0
    estimator.save(str(tmp_path / "e"))
    assert BoostedTreesClassifier.load(str(tmp_path / "e")).getOrDefault("eta") == 0.5


def test_tabular_pipeline_round_trip(spark, tmp_path):
    rows = [(i, float(i % 3) + 0.1 * (i % 7), float(i % 5), ["x", "y", "z"][i % 3]) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, a double, b double, kind string")
    model = jobs.tabular_pipeline(["a", "b"], "kind", ["x", "y", "z"], numRound=3, maxDepth=3, eta=0.5, numClass=3, subsample=1.0).fit(df)
    scored = model.transform(df)
    assert scored.filter("kind = predicted_label").count() > 140
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p")).transform(df)
    assert same_predictions(scored.select("id", "predicted_label"), again.select("id", "predicted_label")).count() == 0


def test_text_pipeline(spark):
    drinks, tools = ("tea", "Milk", "juice", "cocoa"), ("saw", "Drill", "rasp", "clamp")
    rows = [(f"{word} for {who} on day {i}", label) for label, words in ((1.0, drinks), (0.0, tools)) for i, word in enumerate(words) for who in ("ann", "bo")]
    df = spark.createDataFrame(rows, "text string, label double")
    scored = jobs.text_pipeline(1000).fit(df).transform(df)
    assert scored.filter("prediction = label").count() == len(rows)


def test_grid_sizes(spark):
    assert len(tuning.tree_grid(BoostedTreesClassifier())) == 48
    assert len(tuning.linear_grid(logistic_regression())) == 27


def test_searches(spark, assembled):
    lr = logistic_regression(max_iter=10)
    grid = tuning.linear_grid(lr, (0.1, 0.01), (10,), (0.0,))
    found = tuning.train_validation(lr, grid, tuning.auc_evaluator(), ratio=0.8).fit(assembled)
    report = tuning.grid_report(spark, grid, found.validationMetrics).collect()
    assert len(report) == 2 and "regParam=0.1" in report[0]["params"]
    params = {r["param"]: r["value"] for r in tuning.best_params(spark, found.bestModel).collect()}
    best = max(range(2), key=lambda i: found.validationMetrics[i])
    assert float(params["regParam"]) == (0.1, 0.01)[best]
    history = [r["objective"] for r in tuning.objective_history(spark, found.bestModel.summary).orderBy("iteration").collect()]
    assert history[-1] <= history[0]


def test_booster_in_a_cross_validator(spark, assembled):
    trees = BoostedTreesClassifier(eta=0.5, maxDepth=2)
    grid = tuning.tree_grid(trees, (2,), (1, 2), (0.5,))
    folded = assembled.withColumn("fold", (F.col("row_id") % 2).cast("int"))
    found = tuning.cross_validation(trees, grid, tuning.auc_evaluator(), 2, "fold").fit(folded)
    assert all(x > 0.6 for x in found.avgMetrics)
    assert found.bestModel.ensemble.num_trees in (1, 2)


def test_boosted_cross_validation(spark, planted):
    cv = tuning.boosted_cross_validation(planted, views.NUMERIC, "row_id", folds=2, options=BoostOptions(num_round=2, max_depth=2))
    rows = cv.orderBy("round").collect()
    assert [r["round"] for r in rows] == [0, 1] and all(0 < r["test_mean"] < 0.5 for r in rows)


# ---------------------------------------------------------------- UCI mushroom table, when at hand

MUSHROOM, CODE_BOOK = os.environ.get("MUSHROOM_CSV"), os.environ.get("MUSHROOM_CODE_BOOK")


@pytest.mark.skipif(not (MUSHROOM and CODE_BOOK), reason="needs MUSHROOM_CSV and MUSHROOM_CODE_BOOK")
def test_mushroom_end_to_end(spark):
    import re

    from clickforge.operators.features import feature_map, featurize, parse_spec
    from clickforge.operators.trees import TreeEnsemble, tree_leaf, tree_predict
    from test_trees import TWO_TREES

    columns, text = [], open(CODE_BOOK).read()
    for name, words in re.findall(r"\d+\. ([\w?-]+):\s+((?:[\w-]+=.,?\s*)+)", text):
        columns.append((name, dict((code, word) for word, code in re.findall(r"([\w-]+)=(.)", words))))
    assert len(columns) == 22
    raw = spark.read.csv(MUSHROOM).toDF("class", *[f"c{i}" for i in range(22)])
    named = raw.select("class", *[
        F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[F.col(f"c{i}")].alias(f"c{i}")
        for i, (_, codes) in enumerate(columns)])
    lines = [f"name={n};class=S_onehot;slot={i};depend=c{i};feat_values={','.join(codes.values())}" for i, (n, codes) in enumerate(columns)]
    spec = parse_spec(spark.createDataFrame(list(enumerate(lines)), "line int, text string"))
    assert feature_map(spec).count() == 126
    rows = featurize(named, spec).select((F.col("class") == "p").cast("double").alias("label"), "feats", F.lit("all").alias("split"))
    model = TreeEnsemble.from_splits(TWO_TREES, index_base=1)
    scored = tree_predict(tree_leaf(rows, model, "feats"), model, "feats")
    row = m.evaluate_splits(scored, score="probability").first()
    assert row["n"] == 8124 and scored.filter("prediction <> label").count() == 8
    assert (round(row["logloss"], 6), round(row["ne"], 6), round(row["calibration"], 6)) == (0.064372, 0.092955, 0.997287)
    pairs = {tuple(r["leaves"]): r["n"] for r in scored.groupBy("leaves").agg(F.count("*").alias("n")).collect()}
    assert pairs[7, 3] == 3216 and pairs[11, 10] == 3200 and pairs[12, 10] == 16 and len(pairs) == 11
    # Trained on the table itself, five small trees separate it almost fully.
    job = jobs.train_trees(rows.withColumn("split", F.lit("train")), "feats", options=BoostOptions(num_round=5, max_depth=5, eta=1.0, subsample=1.0))
    assert job.evaluation.first()["auc"] > 0.999
