"""Fitted models as relations: nodes against the library's scores and importances, gradients and covariances against numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyhawk.operators import linear, models, preprocessing, projection, sampling, trees
from tallyhawk.sources import writers

WIDTH = 4


def data(spark, n=500, seed=7):
    draw = np.random.default_rng(seed)
    x = np.round(draw.standard_normal((n, WIDTH)), 3)
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.7 * draw.standard_normal(n) > 0.8).astype(int)
    rows = [(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    df = sampling.class_weights(df.withColumn("raw_features", array_to_vector("x"))).drop("x")
    return df.withColumn("std_features", F.col("raw_features")).persist(), x, y


@pytest.fixture(scope="module")
def table(spark):
    return data(spark)


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_descent_and_gains_equal_the_library(spark, table, tmp_path, name):
    df, _, _ = table
    made = {"forest": models.random_forest(trees=12, depth=5), "boosted": models.boosted_trees(iterations=9, depth=3, step=0.2)}
    model = models.fit_all(df, {name: made[name]}).models[name]
    writers.save_stage(model, str(tmp_path / name))
    nodes = trees.stored_nodes(spark, str(tmp_path / name))
    depth = trees.stored_depth(spark, str(tmp_path / name))
    assert depth == made[name].getMaxDepth() and nodes.count() == sum(t.numNodes for t in model.trees)
    found = {r["id"]: r["score"] for r in trees.ensemble_scores(df, nodes, "id", depth, name == "boosted").collect()}
    for r in models.score({name: model}, df, "id").collect():
        assert found[r["id"]] == pytest.approx(r["score"], abs=1e-12)
    shares = {r["idx"]: r["importance"] for r in trees.node_importances(nodes, name == "boosted").collect()}
    for i, value in enumerate(model.featureImportances.toArray()):
        assert shares.get(i, 0.0) == pytest.approx(value, abs=1e-12)


def test_descent_moves_rows_once_only(spark, table, tmp_path):
    df, _, _ = table
    model = models.fit_all(df, {"f": models.random_forest(trees=3, depth=3)}).models["f"]
    writers.save_stage(model, str(tmp_path / "f"))
    scores = trees.ensemble_scores(df, trees.stored_nodes(spark, str(tmp_path / "f")), "id", 3, False)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


def test_a_single_leaf_and_a_table_without_rows(spark, tmp_path):
    df, _, _ = data(spark, 30)
    model = models.fit_all(df, {"f": models.random_forest(trees=2, depth=0)}).models["f"]
    writers.save_stage(model, str(tmp_path / "leaf"))
    nodes = trees.stored_nodes(spark, str(tmp_path / "leaf"))
    assert trees.ensemble_scores(df, nodes, "id", 0, False).count() == 30
    assert trees.ensemble_scores(df.limit(0), nodes, "id", 0, False).count() == 0
    assert trees.node_importances(nodes, False).count() == 0


def test_logistic_gradient_equals_numpy_and_vanishes_at_the_fit(table):
    df, x, y = table
    weight = np.where(y == 0, len(y) / (2 * (y == 0).sum()), len(y) / (2 * (y == 1).sum()))
    beta, intercept, reg = [0.3, -0.2, 0.1, 0.05], 0.4, 0.01
    p = 1 / (1 + np.exp(-(x @ beta + intercept)))
    residual = weight * (p - y)
    want = np.append(residual @ x / weight.sum() + reg * np.array(beta), residual.sum() / weight.sum())
    got = linear.logistic_gradient(df, beta, intercept, reg).first()
    assert got["gradient"] == pytest.approx(np.abs(want).max())
    zero = weight * (0.5 - y)
    assert got["at_zero"] == pytest.approx(np.abs(np.append(zero @ x, zero.sum()) / weight.sum()).max())
    model = models.logistic_regression().fit(df)
    fit = linear.logistic_gradient(df, list(model.coefficients.toArray()), model.intercept, model.getRegParam()).first()
    assert fit["gradient"] <= 1e-4 * fit["at_zero"]


def test_hinge_intervals_hold_zero_at_the_fit_only(table):
    df, x, y = table
    model = models.linear_svc(max_iter=200).fit(df)
    beta = list(model.coefficients.toArray())
    fit = linear.hinge_gradient(df, beta, model.intercept, model.getRegParam()).first()
    off = linear.hinge_gradient(df, [b + 0.5 for b in beta], model.intercept, model.getRegParam()).first()
    assert fit["gradient"] <= 0.02 * fit["at_zero"] < 0.1 * off["gradient"] * 10
    assert off["gradient"] > 5 * max(fit["gradient"], 1e-3)


def test_covariances_and_eigenvectors(spark, table):
    df, x, _ = table
    cells = {(r["i"], r["j"]): r["cov"] for r in projection.covariance_cells(df, "raw_features", WIDTH).collect()}
    want = np.cov(x.T)
    assert all(cells[i, j] == pytest.approx(want[i, j], abs=1e-12) for i in range(WIDTH) for j in range(WIDTH))
    model = PCA(k=3, inputCol="raw_features", outputCol="p").fit(df)
    report = projection.projection_report(df, "raw_features", model).orderBy("component").collect()
    assert [r["component"] for r in report] == [1, 2, 3] and all(r["is_eigenvector"] and r["share_agrees"] for r in report)
    assert report[0]["n_varying"] == pytest.approx(np.trace(want))
    # other rows than those fitted on have other directions
    other = projection.projection_report(df.filter("id % 3 = 0"), "raw_features", model)
    assert not any(r["is_eigenvector"] for r in other.collect())


def test_registry_statistics(spark, table):
    df, x, _ = table
    got = preprocessing.vector_summary(df, "raw_features").orderBy("idx").collect()
    for i, r in enumerate(got):
        assert (r["idx"], r["n"], r["nonzeros"]) == (i, len(x), np.count_nonzero(x[:, i]))
        assert r["mean"] == pytest.approx(x[:, i].mean(), abs=1e-12) and r["variance"] == pytest.approx(x[:, i].var(ddof=1))


def test_models_load_by_their_metadata(spark, table, tmp_path):
    df, _, _ = table
    fitted = models.fit_all(df, {
        "Logistic Regression": models.logistic_regression(max_iter=5), "Random Forest": models.random_forest(trees=2, depth=2),
        "GBT": models.boosted_trees(iterations=2, depth=2), "Linear SVC": models.linear_svc(max_iter=5),
    })
    writers.save_models(spark, fitted.models, fitted.seconds, str(tmp_path))
    again, seconds = writers.load_models(spark, str(tmp_path))
    assert {k: type(v) for k, v in again.items()} == {k: type(v) for k, v in fitted.models.items()} and seconds == fitted.seconds
    assert sorted(models.score(again, df, "id").collect()) == sorted(models.score(fitted.models, df, "id").collect())
    with pytest.raises(ValueError, match="share a folder"):
        writers.save_models(spark, {"a b": fitted.models["GBT"], "a-b": fitted.models["GBT"]}, {}, str(tmp_path / "x"))
