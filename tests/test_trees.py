import glob
import shutil

import pytest
from pyspark.sql import functions as F

from clickforge.operators import trees as t
from clickforge.operators.metrics import same_predictions
from clickforge.plans import views

# Two trees over a 126-feature indicator table, {node: (feature, threshold, yes, no,
# missing) or leaf value} with ids from 1, and sparse instances with the ids that are present.
EDGE = -9.53674e-07
TWO_TREES = [
    {0: (29, EDGE, 1, 2, 1), 1: (56, EDGE, 3, 4, 3), 2: (109, EDGE, 5, 6, 5), 3: (60, EDGE, 7, 8, 7),
     4: (21, EDGE, 9, 10, 9), 5: (67, EDGE, 11, 12, 11), 6: 1.85965, 7: 1.90175, 8: -1.95062, 9: 1.77778,
     10: -1.98104, 11: -1.98531, 12: 0.808511},
    {0: (29, EDGE, 1, 2, 1), 1: (21, EDGE, 3, 4, 3), 2: (109, EDGE, 5, 6, 5), 4: (36, EDGE, 7, 8, 7),
     5: (39, EDGE, 9, 10, 9), 3: 1.1457, 6: 0.994744, 7: -6.87558, 8: -0.127376, 9: -0.0386054, 10: -1.15275},
]
INSTANCES = {
    "A0": [3, 10, 20, 21, 23, 34, 36, 39, 41, 53, 56, 65, 69, 77, 86, 88, 92, 95, 102, 106, 116, 120],
    "A2": [3, 9, 19, 21, 30, 34, 36, 40, 42, 53, 58, 65, 69, 77, 86, 88, 92, 95, 102, 105, 117, 124],
    "A3": [3, 10, 14, 22, 29, 34, 37, 39, 41, 54, 58, 65, 69, 77, 86, 88, 92, 95, 98, 106, 114, 120],
    "B3": [4, 7, 11, 22, 29, 34, 36, 40, 41, 53, 58, 65, 69, 77, 86, 88, 92, 95, 102, 105, 119, 124],
    "B4": [3, 10, 20, 21, 23, 34, 37, 40, 42, 54, 55, 65, 69, 77, 86, 88, 92, 95, 102, 106, 118, 126],
}
# name: (leaf ids, one-hot positions of 13, margin, probability)
GOLDEN = {
    "A0": ([10, 8], [4, 10], -2.108416, 0.108282),
    "A2": ([7, 8], [1, 10], 1.774374, 0.855001),
    "A3": ([11, 10], [5, 12], -3.138060, 0.041564),
    "B3": ([11, 9], [5, 11], -2.023915, 0.116715),
    "B4": ([7, 7], [1, 9], -4.973830, 0.006869),
}


@pytest.fixture(scope="module")
def model():
    return t.TreeEnsemble.from_splits(TWO_TREES, index_base=1)


@pytest.fixture(scope="module")
def instances(spark):
    rows = [(name, {i - 1: 1.0 for i in ids}) for name, ids in INSTANCES.items()]
    return spark.createDataFrame(rows, "name string, m map<int,double>")


@pytest.mark.parametrize("method", ["case", "arrow"])
def test_golden_scores(instances, model, method):
    scored = t.tree_predict(t.tree_leaf(instances, model, "m", method=method), model, "m", method=method)
    for r in scored.collect():
        leaves, _, margin, p = GOLDEN[r["name"]]
        assert r["leaves"] == leaves
        assert r["margin"] == pytest.approx(margin, abs=1e-5) and r["probability"] == pytest.approx(p, abs=1e-6)
        assert r["prediction"] == float(p > 0.5)


def test_golden_leaf_onehot(spark, instances, model):
    vocabulary = t.ordinal_leaf_vocabulary(spark, model)
    assert vocabulary.count() == 13
    encoded = t.dense_onehot(t.encode_leaves(t.tree_leaf(instances, model, "m"), vocabulary), 13)
    for r in encoded.collect():
        assert r["onehot"] == GOLDEN[r["name"]][1]
        assert [i for i, b in enumerate(r["dense"]) if b] == r["onehot"] and len(r["dense"]) == 13


def test_present_zero_is_not_missing(spark):
    model = t.TreeEnsemble.from_splits([{0: (0, 0.5, 1, 2, 2), 1: -1.0, 2: 1.0}])
    rows = spark.createDataFrame([(1, {0: 0.0}), (2, {}), (3, {0: 0.5}), (4, {0: float("nan")})], "id int, m map<int,double>")
    for method in ("case", "arrow"):
        found = t.tree_margin(rows, model, "m", method=method).orderBy("id").collect()
        assert [r["margin"] for r in found] == [-1.0, 1.0, 1.0, 1.0], method


def test_named_columns_score_like_sparse_rows(spark, sf):
    rows = views.sparse_rows(spark, sf)
    model = t.TreeEnsemble.from_splits([{0: (0, 50.0, 1, 2, 1), 1: (1, 30.0, 3, 4, 4), 2: 0.4, 3: -0.4, 4: 0.1}])
    for method in ("case", "arrow"):
        sparse = t.tree_margin(rows, model, "feats", method=method).select("row_id", "margin")
        named = t.tree_margin(rows, model, ["value", "k_seen"], method=method).select("row_id", "margin")
        assert same_predictions(sparse, named).count() == 0


def test_root_only_tree_has_one_leaf(spark):
    model = t.TreeEnsemble.from_splits([{0: 0.5}, {0: (3, 1.0, 1, 2, 1), 1: -1.0, 2: 1.0}])
    rows = spark.createDataFrame([(1, {3: 2.0}), (2, {})], "id int, m map<int,double>")
    vocabulary = t.ordinal_leaf_vocabulary(spark, model)
    for method in ("case", "arrow"):
        encoded = t.encode_leaves(t.tree_leaf(rows, model, "m", method=method), vocabulary).orderBy("id").collect()
        assert [r["onehot"] for r in encoded] == [[0, 2], [0, 1]], method


def test_first_trees(instances, model):
    assert model.first(0) is model and model.first(9) is model and model.first(1).num_trees == 1
    one = t.tree_margin(instances, model, "m", rounds=1).filter("name = 'B4'").first()
    assert one["margin"] == pytest.approx(1.90175)


def test_save_and_load(spark, instances, model, tmp_path):
    model.save(spark, str(tmp_path / "m"))
    again = t.TreeEnsemble.load(spark, str(tmp_path / "m"))
    assert again.nodes == sorted(model.nodes, key=lambda n: (n["tree"], n["node"]))


def test_unseen_leaf_is_left_out(spark, instances, model):
    leaved = t.tree_leaf(instances, model, "m")
    vocabulary = t.string_leaf_vocabulary(leaved.filter("name = 'A0'"))
    vectors = {r["name"]: r["leaf_features"] for r in t.leaf_vector(leaved, vocabulary).collect()}
    assert vectors["A0"].numNonzeros() == 2 and vectors["A3"].numNonzeros() == 0
    positions = {r["name"]: r["onehot"] for r in t.encode_leaves(leaved, vocabulary).collect()}
    assert positions["A2"] == [1] and positions["B4"] == []


def test_encodings_do_not_shuffle_rows(spark, instances, model):
    leaved = t.tree_leaf(instances, model, "m")
    for df in (t.encode_leaves(leaved, t.ordinal_leaf_vocabulary(spark, model)),
               t.leaf_vector(leaved, t.ordinal_leaf_vocabulary(spark, model))):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_importance(spark, model):
    table = t.feature_importance(model.to_df(spark)).collect()
    assert [(r["feature"], r["importance"], r["order"]) for r in table[:3]] == [(20, 2.0, 1), (28, 2.0, 2), (108, 2.0, 3)]
    assert table[0]["feature_name"] == "f20"
    names = spark.createDataFrame([(28, "odor=none")], "feature_id int, name string")
    named = {r["feature"]: r["feature_name"] for r in t.feature_importance(model.to_df(spark), feature_map=names).collect()}
    assert named[28] == "odor=none" and named[20] == "f20"


def test_node_sums_equal_the_recursion(spark, instances, model):
    leaved = t.tree_leaf(instances, model, "m").withColumn("hess", F.length("name") * 0.1 + F.ascii("name") * 0.01)
    rows = leaved.collect()
    found = {(r["tree"], r["node"]): r for r in t.node_sums(leaved, model).collect()}
    for tree, nodes in enumerate(model.by_tree):
        by_id = {n["node"]: n for n in nodes}

        def visit(node):
            n = by_id[node]
            if n["is_leaf"]:
                h = sum(r["hess"] for r in rows if r["leaves"][tree] == node)
                return h, h * n["leaf_value"]
            parts = [visit(n[s]) for s in ("left", "right")]
            return tuple(map(sum, zip(*parts)))

        for node in by_id:
            h, weighted = visit(node)
            if h:
                assert found[tree, node]["sum_hess"] == pytest.approx(h)
                assert found[tree, node]["mean"] == pytest.approx(weighted / h)
            else:
                assert (tree, node) not in found


def test_scoring_runs_on_a_stream(spark, sf, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    shutil.copy(glob.glob(f"{sf}/events.parquet")[0], source / "events.parquet")
    schema = spark.read.parquet(str(source)).schema
    model = t.TreeEnsemble.from_splits([{0: (0, 50.0, 1, 2, 1), 1: -0.4, 2: 0.1}])
    for method in ("case", "arrow"):
        stream = spark.readStream.schema(schema).parquet(str(source))
        scored = t.tree_predict(stream, model, ["value"], method=method).select("event_id", "prediction")
        name = f"scored_{method}"
        run = scored.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        assert run.awaitTermination(120)
        batch = t.tree_predict(spark.read.parquet(str(source)), model, ["value"]).select("event_id", "prediction")
        assert same_predictions(spark.table(name), batch).count() == 0
