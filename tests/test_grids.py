"""Searches: all settings together give what each gives alone, and the optimum that the estimator finds."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickforge.operators import linear_grid as lg
from clickforge.operators import metrics as m
from clickforge.operators.booster import BoostOptions, fit_boosted_trees
from clickforge.operators.trees import TreeEnsemble, tree_predict
from clickforge.plans import grids, views
from clickforge.plans.estimator import BoostedTreesClassifier


@pytest.fixture(scope="module")
def planted(spark, sf):
    rows = views.sparse_rows(spark, sf).withColumn("label", F.col("planted").cast("double"))
    return rows.withColumn("constant", F.lit(3.0)).repartition(4).cache()


COLUMNS = ["value", "k", "hour_of_day", "constant"]


def test_linear_grid_reaches_the_estimators_optimum(spark, planted):
    train = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(planted.where("split = 'train'")).select("label", "features")
    settings = [lg.LinearSetting(r, e) for r in (0.2, 0.01, 0.0) for e in (0.0, 0.5, 1.0)]
    fits = lg.fit_linear_grid(train, settings)
    for s, fit in zip(settings, fits):
        model = LogisticRegression(maxIter=500, tol=1e-12, regParam=s.reg, elasticNetParam=s.elastic_net).fit(train)
        assert fit.objective <= model.summary.objectiveHistory[-1] + 1e-9 and fit.violation < 1e-7
        assert fit.coefficients == pytest.approx(model.coefficients.toArray(), abs=2e-4) and fit.intercept == pytest.approx(model.intercept, abs=2e-3)
        assert fit.coefficients[3] == 0.0
    assert fits[2].coefficients.tolist().count(0.0) >= 2 and fits[0].passes > 1


def test_linear_grid_of_27_and_bounded_passes(planted):
    settings = [*grids.linear_settings(), lg.LinearSetting(0.01, 0.5, 1), lg.LinearSetting(0.01, 0.5, 0)]
    fits = lg.fit_linear_grid(planted.where("split = 'train'"), settings, "feats", width=views.SPEC_SIZE)
    assert len(fits) == 29 and all(f.violation < 1e-8 for f in fits[:27])
    by = {(f.setting.reg, f.setting.elastic_net): f.objective for f in fits[:27]}
    assert len(by) == 9 and all(by[f.setting.reg, f.setting.elastic_net] == f.objective for f in fits[:27])
    assert fits[27].passes <= 1 and fits[28].passes == 0 and by[0.01, 0.5] < fits[27].objective < fits[28].objective


def test_linear_grid_edges(spark):
    schema = "label double, a double, b double"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, 1.0), (None, 1.0, 1.0)], schema)
    s = [lg.LinearSetting(0.1, 0.5)]
    assert (lg.fit_linear_grid(none, s, ["a", "b"])[0].intercept, lg.fit_linear_grid(one, s, ["a", "b"])[0].intercept) == (0.0, np.inf)
    with pytest.raises(ValueError, match="more than"):
        lg.fit_linear_grid(one, s, ["a", "b"], width=lg.MAX_WIDTH + 1)


def test_linear_search(planted):
    found = grids.linear_search(planted, grids.linear_settings(regs=(0.2, 0.01), iterations=(50,), nets=(0.0, 1.0)), "feats", width=views.SPEC_SIZE)
    report = {r.setting: r for r in found.report.collect()}
    assert len(report) == 4 and all(r.auc_bound < 0.01 for r in report.values())
    valid = planted.where("split = 'eval'").withColumn("p", lg.grid_scores(planted, found.fits, "feats"))
    for i, r in report.items():
        exact = m.auc(valid.withColumn("score", F.get("p", F.lit(i)))).first()["auc"]
        assert abs(r.auc - exact) <= r.auc_bound + 1e-6
    assert found.best.setting == found.fits[max(report, key=lambda i: (report[i].auc, -i))].setting
    assert found.evaluation.collect()[0]["split"] == "test" and {r["label"] for r in found.rates.collect()} == {0.0, 1.0}


@pytest.mark.parametrize("encoding", ["node", "ordinal", "string"])
def test_leaf_search(planted, encoding):
    options = BoostOptions(num_round=2, max_depth=2, eta=0.5)
    found = grids.leaf_search(planted, "feats", options, grids.linear_settings(regs=(0.01,), iterations=(50,), nets=(0.5, 1.0)), encoding, row_id="row_id")
    assert found.report.count() == 2 and found.evaluation.first()["auc"] > 0.75
    trees = fit_boosted_trees(planted, "feats", options=options, split="split", row_id="row_id").model
    rows, size = grids.leaf_features(planted, trees, "feats", encoding, planted.where("split = 'train'"))
    leaves = sum(n["is_leaf"] for n in trees.nodes)
    assert size == len(found.best.coefficients) and (size == leaves if encoding != "node" else size > leaves)
    assert rows.where(F.size("leaf_features") != 2).count() == 0
    assert planted.sparkSession.catalog.clearCache() is None


def test_tree_search(spark, planted, tmp_path):
    settings = grids.tree_settings(depths=(1, 3), rounds=(1, 3), etas=(0.3,))
    found = grids.tree_search(planted, views.NUMERIC, settings, row_id="row_id", path=str(tmp_path / "best"))
    report = found.report.orderBy("setting").collect()
    for o, r in zip(settings, report):
        alone = fit_boosted_trees(planted, views.NUMERIC, options=o, split="split", row_id="row_id").model
        exact = m.auc(tree_predict(planted.where("split = 'eval'"), alone, views.NUMERIC).withColumn("score", F.col("probability"))).first()["auc"]
        assert abs(r.auc - exact) <= r.auc_bound + 1e-6
    assert found.best == settings[max(range(4), key=lambda i: (report[i].auc, -i))]
    again = tree_predict(planted.where("split = 'test'"), TreeEnsemble.load(spark, str(tmp_path / "best")), views.NUMERIC)
    assert m.evaluate_splits(again, score="probability").first()["auc"] == pytest.approx(found.evaluation.first()["auc"], abs=1e-12)


def test_estimator_fits_a_grid_together(spark, planted):
    rows = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(planted).select("row_id", "split", "label", "features")
    trees = BoostedTreesClassifier(eta=0.5, splitCol="split", idCol="row_id")
    maps = [{trees.maxDepth: d, trees.numRound: n, trees.leafCol: "leaves"} for d, n in ((1, 1), (2, 2), (2, 1))]
    models = dict(trees.fitMultiple(rows, maps))
    assert sorted(models) == [0, 1, 2]
    for i, p in enumerate(maps):
        assert models[i].getOrDefault("maxDepth") == p[trees.maxDepth] and "leaves" in models[i].transform(rows).columns
        alone = trees.fit(rows, p).ensemble.nodes
        assert [(n["tree"], n["feature"], n["threshold"]) for n in models[i].ensemble.nodes] == [(n["tree"], n["feature"], n["threshold"]) for n in alone]


class _Local:
    """Enough of a DataFrame for the passes of a linear grid, in this process."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return _Local(list(run(iter(self.batches))))

    def repartition(self, *keys):
        return self

    def collect(self):
        from types import SimpleNamespace

        return [SimpleNamespace(**r) for b in self.batches for r in b.to_pylist()]


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([float(y) for y, _ in rows]), pa.array(
        [[{"f": f, "v": v} for f, v in x] for _, x in rows], pa.list_(pa.struct([("f", pa.int32()), ("v", pa.float64())])))], names=["y", "feats"])


def test_derivatives_by_pairs_and_by_matrix():
    import numpy as np

    from clickforge.operators import linear_grid

    draw, width = np.random.default_rng(5), 20
    few = [(i % 2, [(int(f), float(draw.normal())) for f in draw.choice(width, i % 4, replace=False)]) for i in range(50)]
    few[7] = (1, [(3, 5.0), (1, 2.0), (3, -1.0), (4, None), (1, float("nan"))])  # the last of a feature counts, null and NaN are 0
    many = [(i % 3 == 0, [(f, float(draw.normal())) for f in range(width)]) for i in range(30)]
    scale, at = draw.uniform(0.5, 2, width), draw.normal(size=(3, width + 1))
    x, y = np.zeros((81, width + 1)), np.array([float(r[0]) for r in few + many] + [0.0])[:80]
    x = x[:80]
    for i, (_, entries) in enumerate(few + many):
        for f, v in entries:
            x[i, f] = 0.0 if v is None or v != v else v * scale[f]
        x[i, -1] = 1.0
    loss, grad, second = linear_grid._derivatives(_Local([_batch(few), _batch(many)]), scale, at)
    z = x @ at.T
    p = 1 / (1 + np.exp(-z))
    assert np.allclose(loss, (np.logaddexp(0, z) - y[:, None] * z).sum(axis=0))
    assert np.allclose(grad, ((p - y[:, None]).T @ x))
    for m in range(3):
        assert np.allclose(second[m], (x * (p * (1 - p))[:, m:m + 1]).T @ x)


def test_one_hot_rows_cost_by_their_entries():
    import time

    import numpy as np

    from clickforge.operators import linear_grid

    width = 500
    batch = _batch([(i % 2, [(100 * t + (i * 7 + t) % 100, 1.0) for t in range(5)]) for i in range(20_000)])
    began = time.process_time()
    linear_grid._derivatives(_Local([batch]), np.ones(width), np.zeros((9, width + 1)))
    assert time.process_time() - began < 4
