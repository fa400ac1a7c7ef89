"""Queries that train models.

Most have no SQL form and are checked by properties in the tests; where the result is fixed by the
data (a single split, a round trip) there is SQL.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickforge.functions import predicted_class
from clickforge.functions import sigmoid as sigmoid_of
from clickforge.operators import metrics as m
from clickforge.operators.booster import BoostOptions, fit_boosted_trees
from clickforge.operators.features import assembler
from clickforge.operators.linear import fit_linear_booster, linear_score, logistic_regression
from clickforge.operators.sparse import entry_rows, feats_to_vector
from clickforge.operators.splits import k_fold
from clickforge.operators.trees import tree_predict
from clickforge.plans import jobs, tuning, views
from clickforge.plans.catalog import IMP, SPARSE, query
from clickforge.plans.estimator import BoostedTreesClassifier
from clickforge.plans.queries_metrics import compared, rounded
from clickforge.shared import scratch_path
from clickforge.sources import read_linear_model, write_linear_model
from clickforge.sources.writers import INTERCEPT_INDEX

QUICK = BoostOptions(num_round=3, max_depth=3, eta=0.5)


def _planted(spark, sf):
    return views.impressions(spark, sf).withColumn("label", F.col("planted").cast("double"))


def _sparse(spark, sf):
    rows = views.sparse_rows(spark, sf).withColumn("label", F.col("planted").cast("double"))
    return rows.withColumn("features", feats_to_vector("feats", views.SPEC_SIZE))


@query()
def lr_fit(spark, sf):
    job = jobs.train_linear(_sparse(spark, sf), reg=0.01, elastic_net=0.2)
    return rounded(job.evaluation)


@query()
def boosted_trees(spark, sf):
    return rounded(jobs.train_trees(_planted(spark, sf), views.NUMERIC, row_id="row_id", options=QUICK).evaluation)


@query()
def boosted_trees_sparse(spark, sf):
    return rounded(jobs.train_trees(_sparse(spark, sf), "feats", row_id="row_id", options=QUICK).evaluation)


@query()
def boosted_multiclass(spark, sf):
    rows = views.vectors(spark, sf)
    options = BoostOptions(num_round=2, max_depth=3, eta=0.3, num_class=10, max_bins=32)
    feats = F.transform("embedding", lambda x, i: F.struct(i.cast("int").alias("f"), x.cast("double").alias("v")))
    rows = rows.withColumn("feats", feats)
    model = fit_boosted_trees(rows, "feats", "label", options, row_id="vec_id").model
    scored = tree_predict(rows, model, "feats")
    return m.metric(scored.withColumn("label", F.col("label").cast("double")), (),
                    n=F.count("*"), accuracy=F.round(m.accuracy(F.col("label"), F.col("prediction")), 6))


@query()
def boost_from_margin(spark, sf):
    rows = _planted(spark, sf)
    first = fit_boosted_trees(rows, views.NUMERIC, options=BoostOptions(num_round=2, max_depth=2, subsample=1.0), row_id="row_id")
    begun = tree_predict(rows, first.model, views.NUMERIC, output_margin=True)
    one = BoostOptions(num_round=1, max_depth=2, subsample=1.0)
    then = fit_boosted_trees(begun, views.NUMERIC, options=one, row_id="row_id", margin="margin")
    base = begun.withColumnRenamed("margin", "margin_before")
    scored = tree_predict(base, then.model, views.NUMERIC, output_margin=True)
    total = sigmoid_of(F.col("margin_before") + F.col("margin"))
    return m.metric(scored, ["split"], before=F.round(m.log_loss(F.col("label"), sigmoid_of(F.col("margin_before"))), 6),
                    after=F.round(m.log_loss(F.col("label"), total), 6))


@query()
def eval_history(spark, sf):
    metrics = {"logloss": m.log_loss, "ne": m.normalized_entropy, "calibration": m.calibration, "error": m.error_at_half}
    result = fit_boosted_trees(_planted(spark, sf), views.NUMERIC, options=QUICK, split="split", row_id="row_id", metrics=metrics)
    return result.history_df(spark).withColumn("value", F.round("value", 6))


@query()
def custom_objective(spark, sf):
    def squared(margin, label):
        p = sigmoid_of(margin)
        slope = p * (1 - p)
        return (p - label) * slope, slope * slope

    options = BoostOptions(num_round=3, max_depth=3, eta=0.5, min_child_weight=0.1)
    rows = _planted(spark, sf)
    model = fit_boosted_trees(rows, views.NUMERIC, options=options, split="split", row_id="row_id", objective=squared).model
    scored = tree_predict(rows, model, views.NUMERIC)
    return rounded(m.evaluate_splits(scored, score="probability"))


@query()
def linear_booster(spark, sf):
    rows = _sparse(spark, sf)
    model = fit_linear_booster(rows.filter("split = 'train'"), views.SPEC_SIZE)
    scored = linear_score(rows, model.to_df(spark))
    return m.metric(scored, ["split"], n=F.count("*"), error=F.round(m.error_at_half(F.col("label"), F.col("probability")), 6))


# At zero weights every gradient is 1/2 - y and every second derivative 1/4; the step goes half way to the soft threshold.
@query(f"""
WITH {SPARSE}, train AS (SELECT row_id, 0.5e0 - planted AS g FROM imp WHERE split = 'train'),
sums AS (SELECT -1 AS f, sum(g) AS g, count(*) * 0.25e0 AS h FROM train
         UNION ALL SELECT f, sum(g * v), sum(v * v) * 0.25e0 FROM sparse JOIN train USING (row_id) GROUP BY f),
n AS (SELECT count(*) * 1e-3 AS penalty FROM train)
SELECT f, round(CASE WHEN f < 0 THEN -g ELSE -sign(g) * greatest(abs(g) - penalty, 0e0) END / h * 5e-2, 6) AS weight
FROM sums, n WHERE h > 0""")
def linear_booster_round(spark, sf):
    """Weights after one round, those the penalty keeps at 0 included; the intercept is -1."""
    train = _sparse(spark, sf).filter("split = 'train'")
    model = fit_linear_booster(train, views.SPEC_SIZE, rounds=1, eta=0.05, alpha=0.001)
    seen = entry_rows(train).select("f").distinct().withColumn("index", F.col("f"))
    weights = model.to_df(spark).withColumnRenamed("index", "f")
    every = seen.select("f").unionByName(spark.createDataFrame([(-1,)], "f int"))
    return every.join(F.broadcast(weights), "f", "left").select("f", F.round(F.coalesce("weight", F.lit(0.0)), 6).alias("weight"))


# The margins of a fixed wide model over hashed ids, far apart.
@query(f"""
WITH {SPARSE} SELECT row_id, round(0.25e0 + sum(CASE WHEN f < 2 THEN 1e-3 * v ELSE 1e-2 * f END), 6) AS margin FROM sparse GROUP BY row_id""")
def linear_score_wide(spark, sf):
    """Scoring by a join, as models beyond the dense limit are: the ids of the rows and weights lie 60 million apart."""
    far = lambda f: f * 60_000_000
    rows = views.sparse_rows(spark, sf).select("row_id", F.transform("feats", lambda s: F.struct(
        far(s["f"]).alias("f"), s["v"].alias("v"))).alias("feats"))
    weights = spark.range(views.SPEC_SIZE).select(
        far(F.col("id")).cast("int").alias("index"), F.when(F.col("id") < 2, 1e-3).otherwise(1e-2 * F.col("id")).alias("weight"))
    weights = weights.unionByName(spark.createDataFrame([(INTERCEPT_INDEX, 0.25)], "index int, weight double"))
    return linear_score(rows, weights).select("row_id", F.round("margin", 6).alias("margin"))


@query()
def trees_lr(spark, sf):
    job = jobs.train_trees_linear(_planted(spark, sf), views.NUMERIC, row_id="row_id", options=QUICK, reg=0.01)
    return rounded(job.evaluation)


@query()
def trees_lr_stacked(spark, sf):
    job = jobs.train_trees_linear(_planted(spark, sf).fillna(0, ["k_seen"]), views.NUMERIC, row_id="row_id",
                                  options=QUICK, stack_raw=True, reg=0.01)
    return rounded(job.evaluation)


@query()
def text_pipeline(spark, sf):
    rows = views.texts(spark, sf)
    scored = jobs.text_pipeline().fit(rows).transform(rows)
    return rounded(m.evaluate_splits(scored, score="probability", by=[]))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM embeddings")
def pipeline_save_load(spark, sf):
    rows = views.vectors(spark, sf).select(
        "vec_id", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("target"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])
    # The labels in index order: by falling count, then by name.
    counts = rows.groupBy("target").count().orderBy(F.desc("count"), "target").collect()
    pipeline = jobs.tabular_pipeline([f"e{i}" for i in range(64)], "target", [r["target"] for r in counts],
                                     numRound=2, maxDepth=2, numClass=len(counts), maxBins=32)
    model, path = pipeline.fit(rows), scratch_path(spark, "pipeline")
    model.write().overwrite().save(path)
    before = model.transform(rows).select("vec_id", "prediction", "predicted_label")
    after = PipelineModel.load(path).transform(rows).select("vec_id", "prediction", "predicted_label")
    return compared(rows, m.same_predictions(before, after))


def _grid_rows(spark, sf):
    rows = assembler(["value", "hour_of_day", "k"]).transform(_planted(spark, sf))
    return rows.select("row_id", "label", "features", k_fold("row_id", 3).alias("fold"))


@query()
def grid_tvs(spark, sf):
    lr = logistic_regression(max_iter=20)
    grid = tuning.linear_grid(lr, (0.1, 0.01), (20,), (0.0, 1.0))
    search = tuning.train_validation(lr, grid, tuning.auc_evaluator(), ratio=0.8)
    model = search.fit(_grid_rows(spark, sf))
    return tuning.grid_report(spark, grid, model.validationMetrics).withColumn("metric", F.round("metric", 6))


@query()
def grid_trees(spark, sf):
    trees = BoostedTreesClassifier(eta=0.3, maxBins=32, idCol="row_id")
    grid = tuning.tree_grid(trees, (2, 3), (1, 2), (0.3,))
    model = tuning.train_validation(trees, grid, tuning.auc_evaluator(), ratio=0.8).fit(_grid_rows(spark, sf))
    return tuning.grid_report(spark, grid, model.validationMetrics).withColumn("metric", F.round("metric", 6))


@query()
def cross_validate(spark, sf):
    lr = logistic_regression(max_iter=10)
    grid = tuning.linear_grid(lr, (0.1, 0.01), (10,), (0.0,))
    search = tuning.cross_validation(lr, grid, tuning.auc_evaluator(), 3, "fold")
    model = search.fit(_grid_rows(spark, sf))
    return tuning.grid_report(spark, grid, model.avgMetrics).withColumn("metric", F.round("metric", 6))


@query()
def boosted_cv(spark, sf):
    options = BoostOptions(num_round=2, max_depth=2, eta=0.5)
    cv = tuning.boosted_cross_validation(_planted(spark, sf), views.NUMERIC, "row_id", folds=3, options=options)
    return cv.select("round", "metric", *[F.round(c, 6).alias(c) for c in ("train_mean", "train_std", "test_mean", "test_std")])


@query()
def objective_history(spark, sf):
    model = logistic_regression(max_iter=10, reg=0.01).fit(_grid_rows(spark, sf))
    return tuning.objective_history(spark, model.summary).withColumn("objective", F.round("objective", 6))


@query()
def lr_training_rates(spark, sf):
    rows = _sparse(spark, sf)
    scored = logistic_regression(max_iter=20, reg=0.01).fit(rows).transform(rows)
    p = F.get(vector_to_array("probability"), F.lit(1))
    rates = m.per_label_rates(scored.withColumn("prediction", predicted_class(p)))
    return rates.select("label", "n", *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "precision", "recall", "f")])


@query(f"WITH {IMP} SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM imp")
def linear_model_roundtrip(spark, sf):
    rows = _sparse(spark, sf).select("row_id", "label", "feats", "features")
    model, path = logistic_regression(max_iter=20, reg=0.01).fit(rows), scratch_path(spark, "linear")
    write_linear_model(spark, model, path)
    p = F.get(vector_to_array("probability"), F.lit(1))
    theirs = model.transform(rows).select("row_id", p.alias("theirs"))
    ours = linear_score(rows, read_linear_model(spark, path)).select("row_id", F.col("probability").alias("ours"))
    far = (F.abs(F.col("ours") - F.col("theirs")) > 1e-9).cast("bigint")
    return ours.join(theirs, "row_id").agg(F.count("*").alias("n"), F.sum(far).alias("differing"))


# One tree of one split over hour (0) and k (1), fitted exactly: all rows, all features, every value a cut.
@query(f"""
WITH {IMP}, total AS (SELECT sum(0.5e0 - planted) AS g_all, count(*) * 0.25e0 AS h_all FROM imp),
cells AS (SELECT 0 AS feature, hour_of_day AS v, 0.5e0 - planted AS g FROM imp
          UNION ALL SELECT 1, k_seen, 0.5e0 - planted FROM imp WHERE k_seen IS NOT NULL),
hist AS (SELECT feature, v, sum(g) AS g, count(*) * 0.25e0 AS h FROM cells GROUP BY feature, v),
run AS (SELECT feature, v,
  coalesce(sum(g) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gl,
  coalesce(sum(h) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hl,
  sum(g) OVER (PARTITION BY feature) AS g_in, sum(h) OVER (PARTITION BY feature) AS h_in FROM hist),
sides AS (SELECT feature, v, false AS default_left, gl AS g, hl AS h, g_all, h_all FROM run, total
          UNION ALL SELECT feature, v, true, gl + g_all - g_in, hl + h_all - h_in, g_all, h_all FROM run, total),
gains AS (SELECT *, round(g * g / (h + 1) + (g_all - g) * (g_all - g) / (h_all - h + 1) - g_all * g_all / (h_all + 1), 9) AS gain
          FROM sides WHERE h >= 2 AND h_all - h >= 2)
SELECT feature, CAST(v AS DOUBLE) AS threshold, default_left, round(gain, 6) AS gain,
       round(-g / (h + 1) * 0.1e0, 6) AS left_value, round(-(g_all - g) / (h_all - h + 1) * 0.1e0, 6) AS right_value
FROM gains ORDER BY gains.gain DESC, feature, v, default_left DESC LIMIT 1""")
def boosted_stump(spark, sf):
    options = BoostOptions(num_round=1, max_depth=1, subsample=1.0, colsample_bytree=1.0, max_bins=1000)
    nodes = fit_boosted_trees(_planted(spark, sf), ["hour_of_day", "k_seen"], options=options, row_id="row_id").model.to_df(spark)
    leaf = nodes.filter("is_leaf").select("node", "leaf_value")
    left = leaf.select(F.col("node").alias("left"), F.round("leaf_value", 6).alias("left_value"))
    right = leaf.select(F.col("node").alias("right"), F.round("leaf_value", 6).alias("right_value"))
    root = nodes.filter("NOT is_leaf").select("feature", "threshold", "default_left", F.round("gain", 6).alias("gain"), "left", "right")
    return root.join(left, "left").join(right, "right").drop("left", "right")


@query()
def area_under_roc(spark, sf):
    rows = views.impressions(spark, sf)
    binned = tuning.auc_evaluator(score="score").evaluate(rows)
    return m.auc(rows).select(F.round("auc", 4).alias("exact"), F.round(F.lit(binned), 4).alias("binned"))


@query()
def grid_best(spark, sf):
    rows = _grid_rows(spark, sf)
    lr = logistic_regression(max_iter=20)
    grid = tuning.linear_grid(lr, (0.1, 0.01), (20,), (0.5,))
    best = tuning.train_validation(lr, grid, tuning.auc_evaluator(), ratio=0.8).fit(rows).bestModel
    return tuning.best_params(spark, best)
