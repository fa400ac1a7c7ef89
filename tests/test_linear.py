"""The linear booster and scoring by models of any width."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickforge.operators.linear import fit_linear_booster, linear_score
from clickforge.sources.writers import INTERCEPT_INDEX


@pytest.fixture(scope="module")
def rows(spark):
    """Overlapping features: 0 and 1 are nearly copies, 2 decides, 3 is noise."""
    rng = np.random.default_rng(3)
    out = []
    for i in range(600):
        a = rng.normal()
        x = [a, a + 0.01 * rng.normal(), rng.normal(), rng.normal()]
        y = float(x[2] + 0.3 * a + 0.3 * rng.normal() > 0)
        out.append((i, y, [(f, float(v)) for f, v in enumerate(x) if rng.random() < 0.9]))
    return spark.createDataFrame(out, "id int, label double, feats array<struct<f:int,v:double>>").repartition(5)


def plain(rows, width):
    """Rows as a matrix, and their labels."""
    data = rows.collect()
    x = np.zeros((len(data), width))
    for i, r in enumerate(data):
        for e in r["feats"]:
            x[i, e["f"]] = e["v"]
    return x, np.array([r["label"] for r in data])


def objective(x, y, w, b, alpha):
    z = x @ w + b
    return np.mean(np.logaddexp(0, z) - y * z) + alpha * np.abs(w).sum()


def test_loss_falls_each_round_and_reaches_the_optimum(rows):
    model = fit_linear_booster(rows, 4, rounds=40, eta=1.0, alpha=0.01)
    x, y = plain(rows, 4)
    assert all(b < a or b == pytest.approx(a, abs=1e-9) for a, b in zip(model.history, model.history[1:]))
    assert model.history[0] == pytest.approx(np.log(2))
    assert model.history[-1] == pytest.approx(objective(x, y, model.weights, model.intercept, 0.01))
    # At the optimum the gradient of a used feature is the penalty and that of an unused one is below it.
    p = 1 / (1 + np.exp(-(x @ model.weights + model.intercept)))
    slope = x.T @ (p - y) / len(y)
    used = np.abs(model.weights) > 1e-3
    assert np.allclose(slope[used], -0.01 * np.sign(model.weights[used]), atol=2e-3) and np.all(np.abs(slope[~used]) <= 0.012)
    assert abs(model.weights[2]) > 1 and abs(model.weights[3]) < 0.1


def test_strong_penalty_keeps_all_weights_at_zero(rows):
    model = fit_linear_booster(rows, 4, rounds=2, alpha=10.0)
    assert not model.weights.any() and model.intercept != 0


def test_rows_without_label_values_or_entries(spark):
    schema = "label double, feats array<struct<f:int,v:double>>"
    odd = spark.createDataFrame([(1.0, [(0, 1.0)]), (0.0, None), (0.0, []), (None, [(0, 5.0)]), (1.0, [(0, float("nan")), (1, None)])], schema)
    model = fit_linear_booster(odd, 2, rounds=1, eta=1.0, alpha=0.0)
    assert model.intercept == pytest.approx(0.0) and model.weights == pytest.approx([2.0, 0.0])
    empty = fit_linear_booster(odd.limit(0), 2)
    assert empty.history == (0.0,) and not empty.weights.any()
    with pytest.raises(Exception, match="outside"):
        fit_linear_booster(spark.createDataFrame([(1.0, [(2, 1.0)])], schema), 2)
    with pytest.raises(ValueError):
        fit_linear_booster(odd, 0)


def test_wide_scoring_equals_dense(spark, rows):
    weights = spark.createDataFrame([(INTERCEPT_INDEX, -0.3), (0, 0.5), (2, -1.5), (9, 7.0)], "index int, weight double")
    more = rows.select("id", "feats").unionByName(spark.createDataFrame([(1000, None), (1001, []), (1002, [(5, 2.0)])], "id int, feats array<struct<f:int,v:double>>"))
    dense = {r["id"]: (r["margin"], r["prediction"]) for r in linear_score(more, weights).collect()}
    wide_df = linear_score(more, weights, dense_limit=2)
    assert wide_df.columns == ["id", "feats", "margin", "probability", "prediction"]
    wide = {r["id"]: (r["margin"], r["prediction"]) for r in wide_df.collect()}
    assert dense.keys() == wide.keys()
    assert all(wide[i][0] == pytest.approx(dense[i][0]) and wide[i][1] == dense[i][1] for i in dense)
    assert wide[1000][0] == wide[1001][0] == wide[1002][0] == -0.3


def test_ten_million_ids_are_not_collected(spark):
    weights = spark.range(10_000_000).select(F.col("id").cast("int").alias("index"), (F.col("id") % 7 - 3.0).alias("weight"))
    ids = [0, 5, 9_999_999, 4_000_001]
    df = spark.createDataFrame([(1, [(i, 2.0) for i in ids])], "id int, feats array<struct<f:int,v:double>>")
    assert linear_score(df, weights).first()["margin"] == pytest.approx(sum(2.0 * (i % 7 - 3) for i in ids))


def test_negative_ids_are_an_error_in_both_forms(spark):
    df = spark.createDataFrame([(1, [(-2, 1.0)])], "id int, feats array<struct<f:int,v:double>>")
    weights = spark.createDataFrame([(0, 1.0), (8, 1.0)], "index int, weight double")
    for limit in (100, 2):
        with pytest.raises(Exception, match="below 0"):
            linear_score(df, weights, dense_limit=limit).collect()
