"""Queries over tree scoring, leaf encodings and split finding."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickforge.operators import histogram as hist
from clickforge.operators import linear, metrics
from clickforge.operators import trees as t
from clickforge.operators.binning import equal_width_bin
from clickforge.operators.booster import weighted_gradient
from clickforge.operators.sparse import element_rows
from clickforge.plans import views
from clickforge.plans.catalog import IMP, LEAVES, ORDER_LINES, SPARSE, query
from clickforge.plans.queries_metrics import compared
from clickforge.shared import scratch_path
from clickforge.sources import write_importance_csv


def _leaved(spark, sf):
    return t.tree_leaf(views.sparse_rows(spark, sf), views.fixed_model(), "feats")


# ---------------------------------------------------------------- scoring

MARGIN_COLUMNS = """round(margin, 6) AS margin, round(1e0 / (1e0 + exp(-margin)), 6) AS probability,
CASE WHEN 1e0 / (1e0 + exp(-margin)) > 0.5 THEN 1e0 ELSE 0e0 END AS prediction"""


def _scored_columns(scored):
    return scored.select("row_id", F.round("margin", 6).alias("margin"),
                         F.round("probability", 6).alias("probability"), "prediction")


@query(f"WITH {LEAVES} SELECT row_id, {MARGIN_COLUMNS} FROM scored")
def tree_predict(spark, sf):
    return _scored_columns(t.tree_predict(views.sparse_rows(spark, sf), views.fixed_model(), "feats"))


@query(f"WITH {LEAVES} SELECT row_id, {MARGIN_COLUMNS} FROM scored")
def tree_predict_arrow(spark, sf):
    return _scored_columns(t.tree_predict(views.sparse_rows(spark, sf), views.fixed_model(), "feats", method="arrow"))


@query(f"WITH {LEAVES} SELECT row_id, l0, l1, l2 FROM leaves")
def tree_leaf(spark, sf):
    return _leaved(spark, sf).select("row_id", *[F.get("leaves", F.lit(i)).alias(f"l{i}") for i in range(3)])


@query(f"""
WITH {LEAVES} SELECT row_id, round(first_margin, 6) AS first, round(margin, 6) AS every FROM scored""")
def first_n_trees(spark, sf):
    rows = views.sparse_rows(spark, sf)
    one = t.tree_margin(rows, views.fixed_model(), "feats", "first", rounds=1)
    both = t.tree_margin(one, views.fixed_model(), "feats", "every", rounds=50)
    return both.select("row_id", F.round("first", 6).alias("first"), F.round("every", 6).alias("every"))


WEIGHTS = """
weights("index", weight) AS (
  SELECT -1, -1.4e0 UNION ALL SELECT 0, 0.01e0 UNION ALL SELECT 1, -0.005e0
  UNION ALL SELECT CAST(i AS INTEGER), (i - 14) * 0.05e0 FROM range(2, 26) r(i)
  UNION ALL SELECT CAST(i AS INTEGER), (i - 28) * 0.1e0 FROM range(26, 31) r(i))"""


@query(f"""
WITH {SPARSE}, {WEIGHTS}, s AS (
  SELECT row_id, sum(v * weight) + (SELECT weight FROM weights WHERE "index" = -1) AS margin
  FROM sparse JOIN weights ON f = "index" GROUP BY row_id)
SELECT row_id, {MARGIN_COLUMNS} FROM s""")
def linear_score(spark, sf):
    weights = spark.createDataFrame(
        [(-1, -1.4), (0, 0.01), (1, -0.005), *[(i, (i - 14) * 0.05) for i in range(2, 26)],
         *[(i, (i - 28) * 0.1) for i in range(26, 31)]], "index int, weight double")
    return _scored_columns(linear.linear_score(views.sparse_rows(spark, sf), weights))


@query(f"WITH {IMP} SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM imp")
def tree_model_roundtrip(spark, sf):
    model, path = views.fixed_model(), scratch_path(spark, "model")
    model.save(spark, path)
    rows = views.sparse_rows(spark, sf)
    before = t.tree_predict(rows, model, "feats").select("row_id", "probability")
    after = t.tree_predict(rows, t.TreeEnsemble.load(spark, path), "feats").select("row_id", "probability")
    return compared(rows, metrics.same_predictions(before, after))


# ---------------------------------------------------------------- leaf encodings

STRING_VOCABULARY = f"""{LEAVES}, leaf_counts AS (SELECT tree, leaf, count(*) AS n FROM leaf_long GROUP BY tree, leaf),
vocab AS (SELECT *, CAST(row_number() OVER (PARTITION BY tree ORDER BY n DESC, CAST(leaf AS VARCHAR)) - 1 AS INTEGER) AS idx
          FROM leaf_counts),
sizes AS (SELECT tree, count(*) AS size FROM vocab GROUP BY tree),
offsets AS (SELECT tree, coalesce(sum(size) OVER (ORDER BY tree ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM sizes)"""


@query(f"""
WITH {STRING_VOCABULARY} SELECT row_id, tree, idx, CAST(idx + o AS INTEGER) AS pos
FROM leaf_long JOIN vocab USING (tree, leaf) JOIN offsets USING (tree)""")
def leaf_onehot_string(spark, sf):
    leaved = _leaved(spark, sf)
    vocabulary = t.string_leaf_vocabulary(leaved)
    return t.leaf_long(leaved, "leaves", ["row_id"]).join(F.broadcast(vocabulary), ["tree", "leaf"]).select(
        "row_id", "tree", F.col("index").alias("idx"), F.col("position").alias("pos"))


@query(f"""
WITH {STRING_VOCABULARY} SELECT row_id, tree, CAST(idx + o AS INTEGER) AS pos
FROM leaf_long JOIN vocab USING (tree, leaf) JOIN offsets USING (tree)""")
def leaf_vector(spark, sf):
    leaved = _leaved(spark, sf)
    vectors = t.leaf_vector(leaved, t.string_leaf_vocabulary(leaved))
    hot = F.unwrap_udt("leaf_features")["indices"]
    return element_rows(vectors, hot, ("tree", "pos"), ["row_id"])


@query(f"""
WITH {LEAVES}, sizes AS (SELECT tree, max(leaf) + 1 AS size FROM leaf_long GROUP BY tree),
offsets AS (SELECT tree, coalesce(sum(size) OVER (ORDER BY tree ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM sizes)
SELECT row_id, tree, CAST(leaf + o AS INTEGER) AS pos FROM leaf_long JOIN offsets USING (tree)""")
def leaf_onehot_node(spark, sf):
    leaved = _leaved(spark, sf)
    encoded = t.encode_leaves_by_node(leaved, t.node_leaf_vocabulary(leaved))
    return element_rows(encoded, "onehot", ("tree", "pos"), ["row_id"])


ORDINAL = f"""{LEAVES}, ordinal AS (
  SELECT tree, leaf, CAST(row_number() OVER (ORDER BY tree, leaf) - 1 AS INTEGER) AS pos FROM leaf_value)"""


@query(f"WITH {ORDINAL} SELECT row_id, tree, pos FROM leaf_long JOIN ordinal USING (tree, leaf)")
def leaf_onehot_ordinal(spark, sf):
    encoded = t.encode_leaves(_leaved(spark, sf), t.ordinal_leaf_vocabulary(spark, views.fixed_model()))
    return element_rows(encoded, "onehot", ("tree", "pos"), ["row_id"])


@query(f"""
WITH {ORDINAL}, hot AS (SELECT row_id, pos, CAST(pos AS BIGINT) AS i FROM leaf_long JOIN ordinal USING (tree, leaf)),
slots AS (SELECT row_id, unnest(range(0, 10)) AS i FROM imp)
SELECT row_id, string_agg(CASE WHEN pos IS NULL THEN '0' ELSE '1' END, '' ORDER BY i) AS bits
FROM slots LEFT JOIN hot USING (row_id, i) GROUP BY row_id""")
def leaf_onehot_dense(spark, sf):
    vocabulary = t.ordinal_leaf_vocabulary(spark, views.fixed_model())
    encoded = t.dense_onehot(t.encode_leaves(_leaved(spark, sf), vocabulary), vocabulary.count())
    bits = F.array_join(F.transform("dense", lambda b: b.cast("string")), "")
    return encoded.select("row_id", bits.alias("bits"))


@query(f"""
WITH {LEAVES}, parts AS (
  SELECT tree, leaf, split FROM leaf_long JOIN imp USING (row_id) WHERE split IN ('train', 'test')),
n AS (SELECT tree, leaf, count(*) AS n FROM parts GROUP BY tree, leaf)
SELECT tree, leaf, n, CAST(row_number() OVER (PARTITION BY tree ORDER BY n DESC, CAST(leaf AS VARCHAR)) - 1 AS INTEGER) AS idx FROM n""")
def leaf_vocab_union(spark, sf):
    both = _leaved(spark, sf).filter(F.col("split").isin("train", "test"))
    return t.string_leaf_vocabulary(both).select("tree", "leaf", "n", F.col("index").alias("idx"))


# ---------------------------------------------------------------- inspection

NODE_SUMS = f"""{LEAVES}, node_sums AS (
  SELECT p.tree, p.node, sum(score * (1 - score)) AS h, sum(score * (1 - score) * leaf_value) / sum(score * (1 - score)) AS mean
  FROM leaf_long l JOIN imp USING (row_id) JOIN path p ON p.tree = l.tree AND p.leaf = l.leaf
  JOIN leaf_value v ON v.tree = l.tree AND v.leaf = l.leaf GROUP BY p.tree, p.node)"""


def _sums(spark, sf):
    leaved = _leaved(spark, sf).withColumn("hess", F.col("score") * (1 - F.col("score")))
    return t.node_sums(leaved, views.fixed_model())


@query(f"WITH {NODE_SUMS} SELECT tree, node, round(h, 4) AS sum_hess, round(mean, 6) AS mean FROM node_sums")
def node_mean(spark, sf):
    return _sums(spark, sf).select("tree", "node", F.round("sum_hess", 4).alias("sum_hess"), F.round("mean", 6).alias("mean"))


IMPORTANCE = f"""{NODE_SUMS}, cover AS (
  SELECT feature, sum(h) AS total FROM split_feature JOIN node_sums USING (tree, node) GROUP BY feature)"""


def _importance(spark, sf, names=None):
    model = t.with_cover(views.fixed_model().to_df(spark), _sums(spark, sf))
    return t.feature_importance(model, "total_cover", names)


@query(f"""
WITH {IMPORTANCE} SELECT feature, round(total, 4) AS importance,
CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS "order" FROM cover""")
def importance(spark, sf):
    return _importance(spark, sf).select("feature", F.round("importance", 4).alias("importance"), "order")


NAMES = """names(feature, feature_name) AS (VALUES (0, 'value'), (1, 'k'), (12, 'hour=10'), (26, 'type=click'))"""


@query(f"""
WITH {IMPORTANCE}, {NAMES} SELECT feature_name, round(total, 4) AS importance,
CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS "order" FROM cover JOIN names USING (feature)""")
def importance_named(spark, sf):
    named = _importance(spark, sf, views.spec_map(spark))
    return named.select("feature_name", F.round("importance", 4).alias("importance"), "order")


@query(f"""
WITH {IMPORTANCE}, {NAMES} SELECT feature_name, round(total, 4) AS importance,
CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS "order" FROM cover JOIN names USING (feature)""")
def importance_csv(spark, sf):
    path = scratch_path(spark, "importance")
    write_importance_csv(_importance(spark, sf, views.spec_map(spark)), path)
    back = spark.read.schema("feature_name string, importance double, `order` int").csv(path, header=True)
    return back.withColumn("importance", F.round("importance", 4))


# ---------------------------------------------------------------- gradients and splits


@query(f"""
WITH {IMP}, p AS (SELECT row_id, planted, 1e0 / (1e0 + exp(-margin0)) AS p, CASE WHEN planted = 1 THEN 2e0 ELSE 1e0 END AS w FROM imp)
SELECT row_id, round((p - planted) * w, 6) AS g, round(p * (1 - p) * w, 6) AS h FROM p""")
def grad_hess(spark, sf):
    g, h = weighted_gradient(F.col("margin0"), F.col("planted"), scale_pos_weight=2.0)
    return views.impressions(spark, sf).select("row_id", F.round(g, 6).alias("g"), F.round(h, 6).alias("h"))


# Feature 0: discount in hundredths, 1: quantity in steps of five, 2: tax in hundredths, missing at zero.
CELLS = f"""{ORDER_LINES}, lines AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS node FROM ol), cells AS (
  SELECT node, label, 0 AS feature, CAST(round(100 * l_discount) AS INTEGER) AS bin FROM lines
  UNION ALL SELECT node, label, 1, CAST(floor(l_quantity / 5) AS INTEGER) FROM lines
  UNION ALL SELECT node, label, 2, CAST(round(100 * l_tax) AS INTEGER) FROM lines WHERE l_tax > 0)"""


def _cells(spark, sf):
    status = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    lines = views.order_lines(spark, sf).withColumn("node", status)
    bins = [F.round(100 * F.col("l_discount")), F.floor(F.col("l_quantity") / 5),
            F.when(F.col("l_tax") > 0, F.round(100 * F.col("l_tax")))]
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), b.cast("int").alias("bin")) for i, b in enumerate(bins)])
    cells = lines.select("node", "label", F.inline_outer(pairs))
    return lines, cells.filter(F.col("bin").isNotNull())


@query(f"""
WITH {CELLS} SELECT feature, bin, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM cells GROUP BY feature, bin""")
def binned_counts(spark, sf):
    _, cells = _cells(spark, sf)
    return cells.groupBy("feature", "bin").agg(F.count("*").alias("n"), F.sum("label").cast("bigint").alias("positives"))


@query(f"""
WITH {IMP}, b AS (
  SELECT 'value' AS feature, CAST(least(15, greatest(0, floor(value / 500 * 16))) AS INTEGER) AS bin FROM imp
  UNION ALL SELECT 'k', CAST(least(15, greatest(0, floor(k_seen / 1e2 * 16))) AS INTEGER) FROM imp WHERE k_seen IS NOT NULL
  UNION ALL SELECT 'k', NULL FROM imp WHERE k_seen IS NULL)
SELECT feature, bin, count(*) AS n FROM b GROUP BY feature, bin""")
def bin_features(spark, sf):
    rows = views.impressions(spark, sf)
    bins = {"value": equal_width_bin(F.col("value"), 0, 500, 16),
            "k": equal_width_bin(F.col("k_seen"), 0, 100, 16)}
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), b.alias("bin")) for name, b in bins.items()])
    long = rows.select(F.inline_outer(pairs))
    return long.groupBy("feature", "bin").agg(F.count("*").alias("n"))


# Two open nodes, by line status.
SPLITS = f"""{CELLS}, total AS (SELECT node, sum(0.5e0 - label) AS g_all, count(*) * 0.25e0 AS h_all FROM lines GROUP BY node),
hist AS (SELECT node, feature, bin, sum(0.5e0 - label) AS g, count(*) * 0.25e0 AS h FROM cells GROUP BY node, feature, bin),
run AS (SELECT node, feature, bin,
  coalesce(sum(g) OVER (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gl,
  coalesce(sum(h) OVER (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hl,
  sum(g) OVER (PARTITION BY node, feature) AS g_in, sum(h) OVER (PARTITION BY node, feature) AS h_in FROM hist),
sides AS (
  SELECT node, feature, bin, false AS default_left, gl AS g_left, hl AS h_left, g_all, h_all FROM run JOIN total USING (node)
  UNION ALL SELECT node, feature, bin, true, gl + g_all - g_in, hl + h_all - h_in, g_all, h_all FROM run JOIN total USING (node)),
gains AS (SELECT node, feature, bin, default_left, g_left, h_left, round(g_left * g_left / (h_left + 1)
  + (g_all - g_left) * (g_all - g_left) / (h_all - h_left + 1) - g_all * g_all / (h_all + 1) - 0.2e0, 9) AS gain
  FROM sides WHERE h_left >= 2 AND h_all - h_left >= 2)"""


def _candidates(spark, sf):
    lines, cells = _cells(spark, sf)
    g, h = weighted_gradient(F.lit(0.0), F.col("label"))
    one = F.lit(0).alias("class_id")
    histogram = cells.groupBy(one, "node", "feature", "bin").agg(F.sum(g).alias("g"), F.sum(h).alias("h"))
    totals = lines.groupBy(one, "node").agg(F.sum(g).alias("g_all"), F.sum(h).alias("h_all"))
    return hist.split_candidates(histogram, totals, gamma=0.2, min_child_weight=2.0)


@query(f"WITH {SPLITS} SELECT node, feature, bin, default_left, round(gain, 6) AS gain FROM gains")
def split_gains(spark, sf):
    return _candidates(spark, sf).select("node", "feature", "bin", "default_left", F.round("gain", 6).alias("gain"))


@query(f"""
WITH {SPLITS} SELECT node, feature, bin, default_left, round(gain, 6) AS gain, round(g_left, 6) AS g_left, round(h_left, 6) AS h_left
FROM gains QUALIFY row_number() OVER (PARTITION BY node ORDER BY gains.gain DESC, feature, bin, default_left DESC) = 1""")
def split_search(spark, sf):
    best = hist.best_splits(_candidates(spark, sf))
    return best.select("node", "feature", "bin", "default_left", *[F.round(c, 6).alias(c) for c in ("gain", "g_left", "h_left")])


@query(f"""
WITH {IMP}, p AS (SELECT hour_of_day AS node, planted, 1e0 / (1e0 + exp(-margin0)) AS p FROM imp),
s AS (SELECT node, sum(p - planted) AS g, sum(p * (1 - p)) AS h FROM p GROUP BY node)
SELECT node, round(-g / (h + 1) * 0.1e0, 6) AS plain,
round(-sign(g) * greatest(abs(g) - 5, 0) / (h + 1) * 0.1e0, 6) AS shrunk FROM s""")
def leaf_weight(spark, sf):
    g, h = weighted_gradient(F.col("margin0"), F.col("planted"))
    sums = views.impressions(spark, sf).groupBy(F.col("hour_of_day").alias("node")).agg(F.sum(g).alias("g"), F.sum(h).alias("h"))
    return sums.select("node", F.round(hist.leaf_weight("g", "h", 1.0, 0.0, 0.1), 6).alias("plain"),
                       F.round(hist.leaf_weight("g", "h", 1.0, 5.0, 0.1), 6).alias("shrunk"))
