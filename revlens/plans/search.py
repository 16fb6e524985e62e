"""Model selection over shared feature matrices.

For every fold and preprocessor the fit rows and the held-out rows are featurised
once and written to the shared folder; all models and settings of that
preprocessor read those two matrices.  Fits run side by side as Spark jobs from a
pool of threads, each model in its own fair pool.  The settings of a model are
scored together: one long table per fold, one job of rank statistics.  k-nearest
neighbours searches its neighbours once per fold for all numbers of neighbours.
"""

from __future__ import annotations

import json
import math
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from revlens.operators import metrics as M
from revlens.operators.knn import knn_scores, small_shares
from revlens.plans import models as MD
from revlens.plans.estimators import fit_nets
from revlens.plans.evaluate import TARGET, _union, cv_summary
from revlens.session import materialize

# The settings that are searched.
GRIDS = {
    "logistic_regression": {"C": [0.0001, 0.001, 0.01, 0.1, 1.0]},
    "svm_linear": {"C": [0.0001, 0.001, 0.01, 0.1, 1.0]},
    "knn": {"n_neighbors": [100, 200, 400, 800, 1600]},
    "naive_bayes": {"n_bins": [5, 10, 20], "alpha": [0.01, 0.1, 1.0, 10.0]},
    "neural_net": {"hidden": [(64,), (128,), (256,), (64, 32)], "alpha": [1e-4, 1e-3, 1e-2, 1e-1]},
    "decision_tree": {"maxDepth": [4, 6, 8, 12], "minInstancesPerNode": [50, 100, 200],
                      "impurity": ["gini", "entropy"]},
    "bagging": {"maxDepth": [12, 16, 20], "minInstancesPerNode": [20, 50], "max_features": [0.5, 1.0]},
    "random_forest": {"maxDepth": [8, 12, 16], "minInstancesPerNode": [10, 20, 50],
                      "featureSubsetStrategy": ["sqrt", "0.5", "0.8"]},
    "hist_gradient_boosting": {"stepSize": [0.01, 0.05, 0.1], "max_leaf_nodes": [15, 31, 63],
                               "l2_regularization": [0.0, 1.0, 10.0], "minInstancesPerNode": [20, 50, 100]},
}
#: Values that Spark's estimators have no parameter for; they are listed, not searched.
LACKING = {"hist_gradient_boosting": {"l2_regularization": [1.0, 10.0]}}
#: Sizes of the ensembles while searching; the chosen settings are refitted at full size.
SEARCH_SIZES = {"bagging": {"numTrees": 6}, "random_forest": {"numTrees": 10},
                "hist_gradient_boosting": {"maxIter": 10}}


def settings(name: str, grid: dict) -> list[dict]:
    """Every combination of the grid that can be fitted."""
    lacking = LACKING.get(name, {})
    keep = {k: [v for v in vs if v not in lacking.get(k, [])] for k, vs in grid.items()}
    return [dict(zip(keep, values)) for values in product(*keep.values())]


def lacking_settings(name: str, grid: dict) -> list[dict]:
    """The combinations that are left out."""
    able = settings(name, grid)
    return [s for s in (dict(zip(grid, values)) for values in product(*grid.values())) if s not in able]


def estimator_params(name: str, setting: dict) -> dict:
    """Parameters of :func:`revlens.plans.models.estimator`: a leaf cap becomes the least depth
    that allows as many leaves; what the preprocessor or nobody takes is left out."""
    out = {k: v for k, v in setting.items() if k not in ("n_bins", "l2_regularization", "max_leaf_nodes")}
    if "max_leaf_nodes" in setting:
        out["maxDepth"] = math.ceil(math.log2(setting["max_leaf_nodes"]))
    return out


class Matrices:
    """The feature matrices of ``folds`` ((fit rows, held-out rows) each), written on demand."""

    def __init__(self, folds: list[tuple[DataFrame, DataFrame]], num: list[str], cat: list[str],
                 binary: list[str], parallelism: int = 8):
        self.folds, self.num, self.cat, self.binary = folds, num, cat, binary
        self.parallelism, self.made = parallelism, {}
        self.sizes = [fit.count() for fit, _ in folds]

    def key(self, name: str, setting: dict | None = None) -> tuple:
        family = MD.FAMILY.get(name, "scaled")
        return (family, (setting or {}).get("n_bins", 10)) if family == "binned" else (family, 0)

    def make(self, wanted: list[tuple[str, dict]]) -> None:
        """Write all matrices that the models and settings need, side by side."""
        todo = {}
        for name, setting in wanted:
            for f in range(len(self.folds)):
                if (self.key(name, setting), f) not in self.made:
                    todo[self.key(name, setting), f] = name

        def one(item):
            (family, bins), f = item
            fit, held = self.folds[f]
            pre = Pipeline(stages=MD.preprocessor(todo[item], self.num, self.cat, self.binary, bins)).fit(fit)
            cols = ["id", TARGET, "weight", "features"]
            return item, [materialize(pre.transform(rows).select(*cols), f"{family}-{part}-{f}")
                          for rows, part in ((fit, "fit"), (held, "held"))]

        with ThreadPool(self.parallelism) as pool:
            self.made.update(pool.map(inheritable_thread_target(one), list(todo), 1))

    def of(self, name: str, setting: dict | None, fold: int) -> list[DataFrame]:
        return self.made[self.key(name, setting), fold]


def _nets(mats: Matrices, tries: list[dict], fold: int):
    fit, _ = mats.of("neural_net", None, fold)
    fit.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", "neural_net")
    return fit_nets([MD.estimator("neural_net", mats.sizes[fold], **s) for s in tries], fit)


def _fitted(mats: Matrices, name: str, setting: dict, fold: int, sizes: dict):
    fit, _ = mats.of(name, setting, fold)
    fit.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    if name == "hist_gradient_boosting":
        fit = MD.early_stop().transform(fit)
    params = estimator_params(name, setting) | sizes.get(name, {})
    return MD.estimator(name, mats.sizes[fold], **params).fit(fit)


def _knn_scored(mats: Matrices, tries: list[tuple[str, dict]], fold: int) -> DataFrame:
    fit, held = mats.of("knn", None, fold)
    ks = {s.get("n_neighbors", 25): label for label, s in tries}
    train = fit.select(F.col("id").alias("tid"), vector_to_array("features").alias("vec"), F.col(TARGET).alias("label"))
    shares = small_shares(train, list(ks))
    if shares is not None:
        @F.pandas_udf("array<double>")
        def near(x: pd.Series) -> pd.Series:
            return pd.Series(list(shares(np.stack(x.to_numpy()).astype(float))) if len(x) else [], dtype=object)

        labels = F.array(*[F.lit(label) for label in ks.values()])
        each = F.explode(F.map_from_arrays(labels, near(vector_to_array("features")))).alias("model", "score")
        return held.select("id", F.col(TARGET).alias("y"), each).select(
            "model", "id", "y", (F.col("score") >= 0.5).cast("int").alias("pred"), "score")
    found = knn_scores(train,
                       held.select(F.col("id").alias("qid"), vector_to_array("features").alias("vec")), list(ks))
    names = F.create_map(*[x for k, label in ks.items() for x in (F.lit(k), F.lit(label))])
    return (held.select("id", F.col(TARGET).alias("y")).join(found.withColumnRenamed("qid", "id"), "id")
            .select(names[F.col("k")].alias("model"), "id", "y", (F.col("score") >= 0.5).cast("int").alias("pred"),
                    "score"))


def scored_folds(mats: Matrices, tries: dict[str, list[dict]], sizes: dict | None = None):
    """[(model, fold, scored)]: held-out scores of all settings of a model in one long table
    whose ``model`` column is the setting's place in ``tries[model]``."""
    sizes = SEARCH_SIZES if sizes is None else sizes
    mats.make([(name, s) for name, ss in tries.items() for s in ss])
    folds = range(len(mats.folds))
    # the costly ones first, so that the pool stays busy to the end
    order = sorted(tries, key=lambda n: -list(MD.MODEL_NAMES).index(n))
    jobs = [(name, k, f) for name in order if name not in ("knn", "neural_net")
            for k in range(len(tries[name])) for f in folds]
    nets = [("neural_net", None, f) for f in folds if "neural_net" in tries]

    def fitted(job):
        name, k, f = job
        if k is None:       # all settings in one pass per epoch
            return [((name, k, f), m) for k, m in enumerate(_nets(mats, tries[name], f))]
        return [(job, _fitted(mats, name, tries[name][k], f, sizes))]

    with ThreadPool(mats.parallelism) as pool:
        models = dict(m for ms in pool.map(inheritable_thread_target(fitted), nets + jobs, 1) for m in ms)
    out = []
    for name in order:
        for f in folds:
            if name == "knn":
                scored = _knn_scored(mats, [(str(k), s) for k, s in enumerate(tries[name])], f)
            else:
                scored = _union([MD.score(models[name, k, f], mats.of(name, s, f)[1], str(k))
                                 for k, s in enumerate(tries[name])])
            out.append((name, f, scored))
    return out


def grid_search(mats: Matrices, grids: dict | None = None, sizes: dict | None = None) -> DataFrame:
    """One row per model and setting: mean AUC over the folds' held-out rows, its rank in the
    model, and whether the chosen setting is at an edge of its grid.  Settings that can't
    be fitted have status ``lacking`` and no AUC."""
    grids = GRIDS if grids is None else grids
    tries = {name: settings(name, grid) for name, grid in grids.items()}
    scored = scored_folds(mats, tries, sizes)

    def areas(job):
        name, f, table = job
        return [(name, f, int(r["model"]), r["auc"]) for r in M.roc_auc(table, by=["model"]).collect()]

    with ThreadPool(mats.parallelism) as pool:
        found = [row for rows in pool.map(inheritable_thread_target(areas), scored, 1) for row in rows]
    rows = []
    for name, grid in grids.items():
        auc = {k: [] for k in range(len(tries[name]))}
        for other, _, k, area in found:
            if other == name:
                auc[k].append(area)
        mean = {k: sum(a) / len(a) for k, a in auc.items() if a}
        order = sorted(mean, key=lambda k: (-round(mean[k], 12), k))
        for place, k in enumerate(order):
            setting = tries[name][k]
            able = {p: [v for v in vs if v not in LACKING.get(name, {}).get(p, [])] for p, vs in grid.items()}
            edge = [p for p, v in setting.items() if len(able[p]) > 2 and v in (able[p][0], able[p][-1])
                    and not isinstance(v, (str, tuple))]
            rows.append((name, json.dumps(setting), "searched", float(mean[k]), place + 1, place == 0,
                         ", ".join(edge) if place == 0 else None))
        rows += [(name, json.dumps(s), "lacking", None, None, False, None) for s in lacking_settings(name, grid)]
    return mats.folds[0][0].sparkSession.createDataFrame(
        rows, "model string, setting string, status string, cv_auc double, place int, chosen boolean, at_edge string")


def best_params(table: DataFrame) -> dict[str, dict]:
    """The chosen setting per model, as ``params`` of ``build_models``."""
    out = {}
    for r in table.where("chosen").collect():       # one row per model
        setting = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(r["setting"]).items()}
        out[r["model"]] = estimator_params(r["model"], setting) | (
            {"n_bins": setting["n_bins"]} if "n_bins" in setting else {})
    return out


def cross_validate(mats: Matrices, names: list[str] | None = None, params: dict | None = None) -> DataFrame:
    """Mean and population std over the folds of balanced accuracy, F1 of class 1 and gini, of
    each model at its defaults (or ``params``), at full size; all held-out rows are scored."""
    tries = {n: [(params or {}).get(n, {})] for n in names or MD.MODEL_NAMES}
    scored = [table.withColumns({"model": F.lit(name), "fold": F.lit(f)})
              for name, f, table in scored_folds(mats, tries, {})]
    return cv_summary(_union(scored))
