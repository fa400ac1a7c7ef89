"""Whole searches as queries, and the metrics of training rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickforge.operators import metrics as m
from clickforge.operators.booster import BoostOptions, fit_boosted_trees
from clickforge.operators.trees import TreeEnsemble, tree_predict
from clickforge.plans import grids, jobs, views
from clickforge.plans.catalog import IMP, query
from clickforge.plans.queries_metrics import rounded
from clickforge.shared import drop_scratch, scratch_path

# The recorded small run: rounds and depth 5, step size 0.3.
RECORDED = BoostOptions(num_round=5, max_depth=5, eta=0.3)


def _planted(spark, sf):
    return views.impressions(spark, sf).withColumn("label", F.col("planted").cast("double"))


def _sparse(spark, sf):
    return views.sparse_rows(spark, sf).withColumn("label", F.col("planted").cast("double")).select("row_id", "split", "label", "feats")


def _report(found):
    return found.select("setting", "params", F.round("auc", 6).alias("auc"), F.round("auc_bound", 6).alias("auc_bound"))


@query()
def grid_trees_48(spark, sf):
    """All 48 settings of depth, rounds and step size, grown as 16 models in the same passes; rounds are a 25th of the recorded ones."""
    settings = grids.tree_settings(rounds=(2, 4, 6))
    return _report(grids.tree_search(_planted(spark, sf), views.NUMERIC, settings, row_id="row_id").report)


@query()
def grid_trees_best(spark, sf):
    """The best of a search, trained again, saved, read again and judged on the held-out split."""
    path = scratch_path(spark, "best")
    rows = _planted(spark, sf)
    grids.tree_search(rows, views.NUMERIC, grids.tree_settings((2, 4), (1, 3), (0.2, 0.4)), row_id="row_id", path=path)
    model = TreeEnsemble.load(spark, path)
    drop_scratch(spark, path)
    return rounded(m.evaluate_splits(tree_predict(rows.where("split = 'test'"), model, views.NUMERIC), score="probability"))


@query()
def grid_linear_27(spark, sf):
    """All 27 penalties of the logistic regression from the same passes, compared on the evaluation split."""
    return _report(grids.linear_search(_sparse(spark, sf), grids.linear_settings(), "feats", width=views.SPEC_SIZE).report)


@query()
def grid_leaves_27(spark, sf):
    """Fixed trees, leaves one-hot by node id, 27 penalties, and the best one's rates by label on the held-out split."""
    rates = grids.leaf_search(_planted(spark, sf), views.NUMERIC, RECORDED, grids.linear_settings(), "node", row_id="row_id").rates
    return rates.select("label", "n", *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "precision", "recall", "f")])


@query()
def boosted_trees_recorded(spark, sf):
    """Trees with the recorded run's rounds and depth."""
    return rounded(jobs.train_trees(_planted(spark, sf), views.NUMERIC, row_id="row_id", options=RECORDED).evaluation)


# One exact split over hour (0) and k (1) on the training rows; two scores per split, so the area follows from four counts.
@query(f"""
WITH {IMP}, t AS (SELECT * FROM imp WHERE split = 'train'),
total AS (SELECT sum(0.5e0 - planted) AS g_all, count(*) * 0.25e0 AS h_all FROM t),
cells AS (SELECT 0 AS feature, hour_of_day AS v, 0.5e0 - planted AS g FROM t
          UNION ALL SELECT 1, k_seen, 0.5e0 - planted FROM t WHERE k_seen IS NOT NULL),
hist AS (SELECT feature, v, sum(g) AS g, count(*) * 0.25e0 AS h FROM cells GROUP BY feature, v),
run AS (SELECT feature, v,
  coalesce(sum(g) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gl,
  coalesce(sum(h) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hl,
  sum(g) OVER (PARTITION BY feature) AS g_in, sum(h) OVER (PARTITION BY feature) AS h_in FROM hist),
sides AS (SELECT feature, v, false AS default_left, gl AS g, hl AS h, g_all, h_all FROM run, total
          UNION ALL SELECT feature, v, true, gl + g_all - g_in, hl + h_all - h_in, g_all, h_all FROM run, total),
best AS (SELECT feature, v, default_left, -g / (h + 1) AS left_value, -(g_all - g) / (h_all - h + 1) AS right_value
         FROM (SELECT *, round(g * g / (h + 1) + (g_all - g) * (g_all - g) / (h_all - h + 1) - g_all * g_all / (h_all + 1), 9) AS gain
               FROM sides WHERE h >= 2 AND h_all - h >= 2) ORDER BY gain DESC, feature, v, default_left DESC LIMIT 1),
sided AS (SELECT split, planted, (CASE WHEN (CASE feature WHEN 0 THEN hour_of_day ELSE k_seen END) IS NULL THEN default_left
            ELSE (CASE feature WHEN 0 THEN hour_of_day ELSE k_seen END) < v END) = (left_value > right_value) AS high FROM imp, best),
counts AS (SELECT split, count(*) FILTER (high AND planted = 1)::DOUBLE AS ph, count(*) FILTER (high AND planted = 0)::DOUBLE AS nh,
                  count(*) FILTER (NOT high AND planted = 1)::DOUBLE AS pl, count(*) FILTER (NOT high AND planted = 0)::DOUBLE AS nl FROM sided GROUP BY split)
SELECT 0 AS round, split, 'auc' AS metric, round((ph * nl + (ph * nh + pl * nl) / 2) / ((ph + pl) * (nh + nl)), 6) AS value FROM counts
UNION ALL SELECT 0, split, 'auc_bound', 0e0 FROM counts""")
def eval_history_auc(spark, sf):
    options = BoostOptions(num_round=1, max_depth=1, subsample=1.0, colsample_bytree=1.0, max_bins=1000)
    result = fit_boosted_trees(_planted(spark, sf), ["hour_of_day", "k_seen"], options=options, split="split", row_id="row_id",
                               metrics={"auc": m.ScoreHistogram()})
    return result.history_df(spark).withColumn("value", F.round("value", 6))
