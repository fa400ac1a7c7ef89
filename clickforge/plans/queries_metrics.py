"""Queries over label counts and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickforge.functions import predicted_class
from clickforge.operators import metrics as m
from clickforge.plans import views
from clickforge.plans.catalog import IMP, query

# Log loss of a row, the base-rate entropy and the AUC by pair counting, in SQL.
LOSS = "-(label * ln(score) + (1 - label) * ln(1 - score))"


def auc_sql(source: str, score: str, by: str) -> str:
    """Rank-sum AUC with averaged ties over ``source``, per ``by``."""
    return f"""
ties AS (SELECT {by}, CAST(round({score} * 1000000000) AS BIGINT) AS q,
         sum(CASE WHEN label > 0.1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label > 0.1 THEN 0 ELSE 1 END) AS neg
         FROM {source} GROUP BY {by}, q),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM ties),
auc AS (SELECT {by}, sum(CAST(pos AS DOUBLE) * (b + neg / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM below GROUP BY {by})"""


# A prediction that cuts the score in the middle of its range.
PREDICTED = f"""{IMP}, pred AS (
  SELECT *, CASE WHEN score > 0.25e0 THEN 1e0 ELSE 0e0 END AS prediction FROM imp)"""


def _predicted(spark, sf):
    return views.impressions(spark, sf).withColumn("prediction", predicted_class(F.col("score"), 0.25))


@query(f"WITH {IMP} SELECT split, label, count(*) AS n FROM imp GROUP BY split, label")
def label_distribution(spark, sf):
    return m.label_distribution(views.impressions(spark, sf))


@query(f"""
WITH {IMP} SELECT split, round(avg({LOSS}), 6) AS logloss FROM imp GROUP BY split""")
def log_loss(spark, sf):
    return m.metric(views.impressions(spark, sf), ["split"], logloss=F.round(m.log_loss(F.col("label"), F.col("score")), 6))


@query(f"""
WITH {IMP}, s AS (SELECT split, avg({LOSS}) AS loss, avg(label) AS r FROM imp GROUP BY split)
SELECT split, round(loss / -(r * ln(r) + (1 - r) * ln(1 - r)), 6) AS ne FROM s""")
def normalized_entropy(spark, sf):
    return m.metric(views.impressions(spark, sf), ["split"], ne=F.round(m.normalized_entropy(F.col("label"), F.col("score")), 6))


@query(f"""
WITH {IMP} SELECT event_type, CASE WHEN sum(label) > 0 THEN round(sum(score) / sum(label), 6) END AS calibration
FROM imp GROUP BY event_type""")
def calibration(spark, sf):
    # Only clicks are positive, so the other types show the null of a missing denominator.
    return m.metric(views.impressions(spark, sf), ["event_type"], calibration=F.round(m.calibration(F.col("label"), F.col("score")), 6))


@query(f"WITH {IMP}, {auc_sql('imp', 'score', 'split')} SELECT split, round(auc, 6) AS auc FROM auc")
def auc_rank(spark, sf):
    return m.auc(views.impressions(spark, sf), by=["split"]).select("split", F.round("auc", 6).alias("auc"))


@query(f"""
WITH {PREDICTED}, c AS (SELECT split,
  avg(CASE WHEN label = 1 THEN prediction END) AS tpr, avg(CASE WHEN label = 0 THEN 1 - prediction END) AS tnr
  FROM pred GROUP BY split)
SELECT split, round((tpr + tnr) / 2, 6) AS auc FROM c""")
def auc_hard(spark, sf):
    return m.auc_of_prediction(_predicted(spark, sf), by=["split"]).select("split", F.round("auc", 6).alias("auc"))


@query(f"""
WITH {PREDICTED} SELECT split, round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6) AS accuracy
FROM pred GROUP BY split""")
def accuracy(spark, sf):
    return m.metric(_predicted(spark, sf), ["split"], accuracy=F.round(m.accuracy(F.col("label"), F.col("prediction")), 6))


@query(f"""
WITH {IMP} SELECT split, round(avg(CASE WHEN (label = 0 AND score > 0.5) OR (label = 1 AND score <= 0.5)
THEN 1e0 ELSE 0e0 END), 6) AS error FROM imp GROUP BY split""")
def error_at_half(spark, sf):
    return m.metric(views.impressions(spark, sf), ["split"], error=F.round(m.error_at_half(F.col("label"), F.col("score")), 6))


@query(f"""
WITH {IMP} SELECT split, round(avg(CASE WHEN (label = 0 AND margin0 > 0) OR (label = 1 AND margin0 <= 0)
THEN 1e0 ELSE 0e0 END), 6) AS error FROM imp GROUP BY split""")
def margin_error(spark, sf):
    return m.metric(views.impressions(spark, sf), ["split"], error=F.round(m.margin_error(F.col("label"), F.col("margin0")), 6))


def _classes(spark, sf):
    """A three-class label and a guess of it, both from event columns."""
    rows = views.impressions(spark, sf)
    return rows.select((F.col("k") % 3).cast("double").alias("label"),
                       (F.floor(F.col("value") / 10) % 3).cast("double").alias("prediction"))


CLASSES = f"""{IMP}, c AS (
  SELECT CAST(k % 3 AS DOUBLE) AS label, CAST(CAST(floor(value / 10) AS BIGINT) % 3 AS DOUBLE) AS prediction FROM imp),
labels AS (SELECT DISTINCT label AS l FROM c),
counts AS (SELECT l, count(*) FILTER (WHERE label = l) AS actual, count(*) FILTER (WHERE prediction = l) AS called,
           count(*) FILTER (WHERE label = l AND prediction = l) AS hit, count(*) AS total FROM labels, c GROUP BY l),
rates AS (SELECT l AS label, actual AS n, coalesce(hit / CAST(nullif(actual, 0) AS DOUBLE), 0) AS tpr,
          coalesce((called - hit) / CAST(nullif(total - actual, 0) AS DOUBLE), 0) AS fpr,
          coalesce(hit / CAST(nullif(called, 0) AS DOUBLE), 0) AS prec, total FROM counts),
full_rates AS (SELECT *, CASE WHEN prec + tpr > 0 THEN 2 * prec * tpr / (prec + tpr) ELSE 0e0 END AS f FROM rates)"""

RATES = ("tpr", "fpr", "precision", "recall", "f")


@query(f"""
WITH {CLASSES} SELECT label, n, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(prec, 6) AS "precision",
round(tpr, 6) AS recall, round(f, 6) AS f FROM full_rates""")
def per_label_rates(spark, sf):
    rates = m.per_label_rates(_classes(spark, sf))
    return rates.select("label", "n", *[F.round(c, 6).alias(c) for c in RATES])


@query(f"""
WITH {CLASSES} SELECT round(sum(tpr * n) / sum(n), 6) AS tpr, round(sum(fpr * n) / sum(n), 6) AS fpr,
round(sum(prec * n) / sum(n), 6) AS "precision", round(sum(tpr * n) / sum(n), 6) AS recall,
round(sum(f * n) / sum(n), 6) AS f, round(sum(tpr * n) / sum(n), 6) AS accuracy FROM full_rates""")
def weighted_rates(spark, sf):
    rates = m.weighted_rates(_classes(spark, sf))
    return rates.select(*[F.round(c, 6).alias(c) for c in (*RATES, "accuracy")])


@query(f"WITH {CLASSES} SELECT round(sum(f * n) / sum(n), 6) AS f1 FROM full_rates")
def f1_multiclass(spark, sf):
    return m.weighted_rates(_classes(spark, sf)).select(F.round("f", 6).alias("f1"))


@query(f"""
WITH {IMP} SELECT split, round(sqrt(avg((label - score) * (label - score))), 6) AS rmse FROM imp GROUP BY split""")
def rmse(spark, sf):
    return m.metric(views.impressions(spark, sf), ["split"], rmse=F.round(m.rmse(F.col("label"), F.col("score")), 6))


@query(f"""
WITH {IMP}, {auc_sql('imp', 'score', 'split')}, s AS (
  SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, avg({LOSS}) AS loss, avg(label) AS r,
         sum(score) / sum(label) AS calibration, count(*) FILTER (WHERE score < 1e-15 OR score > 1 - 1e-15) AS n_clipped
  FROM imp GROUP BY split)
SELECT split, n, positives, round(auc, 6) AS auc, round(loss / -(r * ln(r) + (1 - r) * ln(1 - r)), 6) AS ne,
       round(calibration, 6) AS calibration, round(loss, 6) AS logloss, n_clipped FROM s JOIN auc USING (split)""")
def evaluate_splits(spark, sf):
    return rounded(m.evaluate_splits(views.impressions(spark, sf)))


def rounded(evaluation):
    """The evaluation table with its measures to six digits."""
    measures = ("auc", "ne", "calibration", "logloss")
    return evaluation.withColumns({c: F.round(c, 6) for c in measures})


@query(f"WITH {IMP} SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM imp")
def same_predictions(spark, sf):
    left = views.impressions(spark, sf).select("row_id", "score")
    return compared(left, m.same_predictions(left, left.select("score", "row_id")))


def compared(rows, differing):
    """``(n, differing)``: how many rows there are and how many differ."""
    counts = rows.agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("differing"))
    found = differing.agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("differing"))
    return counts.unionByName(found).agg(F.sum("n").alias("n"), F.sum("differing").alias("differing"))


# Scores that differ below the ninth digit or are huge, negative, missing or not a number.
@query(f"""
WITH {IMP}, dirty AS (SELECT split, label, CASE WHEN row_id % 11 = 0 THEN NULL WHEN row_id % 13 = 0 THEN 'NaN'::DOUBLE WHEN row_id % 17 = 0 THEN score * 1e12
    WHEN row_id % 7 = 0 THEN -score * 1e-10 WHEN row_id % 5 = 0 THEN score * 1e-10 ELSE score END AS score FROM imp),
ties AS (SELECT split, score, count(*) FILTER (label > 0.1)::DOUBLE AS p, count(*) FILTER (label <= 0.1)::DOUBLE AS n FROM dirty
         WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY split, score),
ranked AS (SELECT split, p, n, coalesce(sum(n) OVER (PARTITION BY split ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ties),
area AS (SELECT split, round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 9) AS auc FROM ranked GROUP BY split)
SELECT split, auc, n_unscored FROM area JOIN (SELECT split, count(*) FILTER (score IS NULL OR isnan(score)) AS n_unscored FROM dirty GROUP BY split) USING (split)""")
def auc_dirty_scores(spark, sf):
    of = lambda n: F.col("row_id") % n == 0
    score = F.col("score")
    dirty = F.when(of(11), None).when(of(13), float("nan")).when(of(17), score * 1e12).when(of(7), -score * 1e-10).when(of(5), score * 1e-10).otherwise(score)
    rows = views.impressions(spark, sf).withColumn("score", dirty)
    return m.auc(rows, by=["split"], unscored=True).withColumn("auc", F.round("auc", 9))
