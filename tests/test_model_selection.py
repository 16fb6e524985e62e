"""Estimators of their own and the search over shared matrices."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.plans import models as MD
from revlens.plans import search as SE
from revlens.plans.estimators import NeuralNet, SlicedBagging, SquaredHingeSVC, bootstrap_count, fit_nets


def rows(seed=1, n=400, d=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=n) > 0).astype(int)
    return x, y, rng.choice([0.5, 1.0, 2.0], n)


def frame(spark, x, y, w, parts=3):
    data = [(i, [float(v) for v in r], int(t), float(u)) for i, (r, t, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(data, "id long, x array<double>, satisfied int, weight double").repartition(
        parts).select("id", array_to_vector("x").alias("features"), "satisfied", "weight")


@pytest.mark.parametrize("C", [0.001, 1.0, 100.0])
def test_squared_hinge_reaches_the_minimum(spark, C):
    x, y, w = rows()
    df = frame(spark, x, y, w)
    model = SquaredHingeSVC(C=C).fit(df)
    ones, sign = np.hstack([x, np.ones((len(x), 1))]), 2 * y - 1

    def gradient(coef):
        gap = np.maximum(0, 1 - sign * (ones @ coef))
        return coef - 2 * C * ones.T @ (w * gap * sign)

    # a plain gradient descent with backtracking, from zero
    def loss(coef):
        return coef @ coef / 2 + C * (w * np.maximum(0, 1 - sign * (ones @ coef)) ** 2).sum()
    plain = np.zeros(6)
    for _ in range(20_000):
        g, step = gradient(plain), 1.0
        while loss(plain - step * g) > loss(plain) - step / 2 * (g @ g) and step > 1e-16:
            step /= 2
        plain = plain - step * g
    assert np.abs(model.coefficients - plain).max() < 1e-4
    out = model.transform(df).orderBy("id").collect()
    assert np.allclose([r["rawPrediction"][1] for r in out], ones @ model.coefficients)
    assert all(r["prediction"] == float(r["rawPrediction"][1] > 0) for r in out)


def test_net_stops_on_the_held_out_loss_and_keeps_the_best(spark):
    x, y, w = rows(2, 600)
    noise = frame(spark, x, np.random.default_rng(0).integers(0, 2, 600), w)
    stopped = NeuralNet(hidden=(32,), maxIter=60, patience=3, rate=0.02).fit(noise)
    assert 3 < len(stopped.losses) < 60
    assert min(stopped.losses[-3:]) >= min(stopped.losses[:-3]) - 1e-4
    model = NeuralNet(hidden=(16, 8), maxIter=40, rate=0.02, batch=50).fit(frame(spark, x, y, w))
    out = model.transform(frame(spark, x, y, w)).collect()
    assert np.mean([r["prediction"] == r["satisfied"] for r in out]) > 0.85
    assert all(abs(r["probability"].sum() - 1) < 1e-9 for r in out)


def test_l2_shrinks_and_nets_fitted_together_are_those_fitted_alone(spark):
    x, y, w = rows(3, 300)
    df = frame(spark, x, y, w, 1)
    nets = [NeuralNet(hidden=(8,), alpha=a, maxIter=6, batch=30, rate=0.01) for a in (1e-4, 100.0)]
    both = fit_nets(nets, df)
    assert np.linalg.norm(both[1].layers[0]) < 0.8 * np.linalg.norm(both[0].layers[0])
    alone = nets[1].fit(df)
    assert all(np.allclose(a, b) for a, b in zip(alone.layers, both[1].layers))


def test_each_tree_has_its_share_of_features(spark):
    x, y, w = rows(4, 300, 6)
    df = frame(spark, x, y, w)
    model = SlicedBagging(numTrees=6, share=0.5, maxDepth=4, minInstancesPerNode=5).fit(df)
    assert [len(s) for s in model.slices] == [3] * 6 and len({tuple(s) for s in model.slices}) > 1
    for tree, slice_ in zip(model.trees, model.slices):
        used = {int(k) for k in np.flatnonzero(tree.featureImportances.toArray())}
        assert used <= set(slice_.tolist())
    out = model.transform(df).collect()
    assert np.mean([r["prediction"] == r["satisfied"] for r in out]) > 0.75
    one = model.trees[0].copy().setFeaturesCol("features")
    assert "probability" in one.transform(df).columns
    counts = spark.range(20_000).select(bootstrap_count("id", 3, 42).alias("n")).agg(F.avg("n"), F.variance("n")).first()
    assert abs(counts[0] - 1) < 0.03 and abs(counts[1] - 1) < 0.05


def test_every_setting_is_searched_or_listed():
    able = sum(len(SE.settings(n, g)) for n, g in SE.GRIDS.items())
    lacking = sum(len(SE.lacking_settings(n, g)) for n, g in SE.GRIDS.items())
    assert set(SE.GRIDS) == set(MD.MODEL_NAMES) and (able, lacking) == (133, 54)
    assert SE.estimator_params("hist_gradient_boosting", {"max_leaf_nodes": 31, "l2_regularization": 0.0}) == {"maxDepth": 5}


def test_search_over_shared_matrices(spark):
    x, y, w = rows(5, 900, 3)
    data = spark.createDataFrame(
        [(i, *map(float, r), "ab"[i % 2], int(t), float(u)) for i, (r, t, u) in enumerate(zip(x, y, w))],
        "id long, a double, b double, c double, k string, satisfied int, weight double")
    folds = [(data.where(F.col("id") % 3 != f), data.where(F.col("id") % 3 == f)) for f in range(3)]
    mats = SE.Matrices(folds, ["a", "b", "c"], ["k"], [])
    grids = {"logistic_regression": {"C": [0.01, 1.0]}, "knn": {"n_neighbors": [5, 2000]},
             "decision_tree": {"maxDepth": [1, 5], "minInstancesPerNode": [20]}, "naive_bayes": {"n_bins": [3, 10]}}
    table = SE.grid_search(mats, grids)
    got = {(r["model"], r["setting"]): r for r in table.collect()}
    assert len(got) == 8 and len(mats.made) == 12           # four preprocessors, three folds
    assert got["knn", json.dumps({"n_neighbors": 5})]["cv_auc"] > 0.8
    assert abs(got["knn", json.dumps({"n_neighbors": 2000})]["cv_auc"] - 0.5) < 1e-9      # all rows: no order
    best = SE.best_params(table)
    assert best["decision_tree"]["maxDepth"] == 5 and best["knn"] == {"n_neighbors": 5}
    assert sum(r["chosen"] for r in got.values()) == 4
    models = MD.build_models(data, ["a", "b", "c"], ["k"], params=best, names=["knn", "naive_bayes"])
    assert models["knn"].getStages()[-1].k == 5
    summary = {r["model"]: r["gini_mean"] for r in SE.cross_validate(mats, ["logistic_regression", "knn"]).collect()}
    assert summary["logistic_regression"] > 0.8 and summary["knn"] > 0.7


def test_variants_are_scored_once(spark):
    """Later jobs read the written scores; they don't run or plan the variants' pipelines."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from revlens.plans.evaluate import _variants_scored
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(60)],
                                 "id long, a double, b double, satisfied int")
    builds = {n: (lambda cols=cols: Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="satisfied", maxIter=3)]))
        for n, cols in {"ALL": ["a", "b"], "one": ["b"]}.items()}
    scored = _variants_scored(builds, rows, rows)
    assert {r["model"]: r["count"] for r in scored.groupBy("model").count().collect()} == {"ALL": 60, "one": 60}
    assert scored.inputFiles() and all("variant-scores" in f for f in scored.inputFiles())
