"""Estimators with rules that Spark ML's own ones don't have.

* :class:`SquaredHingeSVC` -- linear SVM with the squared hinge, the intercept in the
  penalty, fitted by Newton steps; a step is one pass that adds up loss, gradient and
  curvature (numbers of the columns squared, never rows).
* :class:`NeuralNet` -- relu layers with an L2 penalty, Adam on minibatches inside each
  partition, weights averaged over partitions after every epoch, stopped by the loss
  of a held-out tenth (by a hash of the row's id).
* :class:`SlicedBagging` -- decision trees, each on bootstrap weights (from a hash of id
  and tree) and on its own share of the features.

All of them stay on one materialized matrix: no rows reach the driver.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from revlens.operators.sampling import poisson_cdf
from revlens.session import materialize


def matrix(df: DataFrame, label: str, weight: str | None, key: str, seed: int) -> DataFrame:
    """x (array), y, w and whether the row is of the held-out tenth, written once."""
    return materialize(df.select(
        vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10)) == 0).alias("held")), "fit-matrix")


def _columns(batch: pa.RecordBatch):
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return (flat.reshape(batch.num_rows, -1), batch.column("y").to_numpy(), batch.column("w").to_numpy(),
            batch.column("held").to_numpy(zero_copy_only=False))


def _summed(rows: DataFrame, step, kind: str = "sum") -> np.ndarray:
    """The (weighted) sum or mean of the arrays that ``step`` yields in the tasks."""
    parts = rows.mapInArrow(step, "n double, v array<double>")
    agg = getattr(Summarizer, kind)(array_to_vector("v"), F.col("n"))
    got = parts.agg(agg.alias("v")).first()["v"]
    return got.toArray() if got is not None else np.zeros(0)


def _row(n: float, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([values.tolist()], pa.list_(pa.float64()))],
                                      names=["n", "v"])


def _with_scores(df: DataFrame, positive: Column, raw: Column, prediction: Column) -> DataFrame:
    out = df.withColumn("__s", positive)
    return out.withColumns({"rawPrediction": raw, "prediction": prediction.cast("double")})


class SquaredHingeSVC(Estimator):
    """Minimises ``|w|^2 / 2 + C * sum(weight * max(0, 1 - y f)^2)`` with f = w x + b, b
    being part of w (a column of ones)."""

    def __init__(self, C: float = 1.0, labelCol: str = "satisfied", weightCol: str | None = "weight",
                 maxIter: int = 50, tol: float = 1e-8, idCol: str = "id"):
        super().__init__()
        self.C, self.label, self.weight, self.max_iter, self.tol, self.key = C, labelCol, weightCol, maxIter, tol, idCol

    def _fit(self, df: DataFrame) -> "SquaredHingeModel":
        rows = matrix(df, self.label, self.weight, self.key, 0)
        first = rows.first()
        d = len(first["x"]) + 1 if first else 1
        coef, before, best = np.zeros(d), np.zeros(d), math.inf
        for _ in range(self.max_iter if first else 0):
            loss, grad, curve = self._pass(rows, coef)
            if loss > best * (1 + 1e-12):       # too long a step: halve it
                coef = (coef + before) / 2
                continue
            step = np.linalg.solve(curve, grad)
            if grad @ step <= self.tol * max(loss, 1e-300):
                break
            before, best, coef = coef, loss, coef - step
        return SquaredHingeModel(coef)

    def _pass(self, rows: DataFrame, coef: np.ndarray):
        d, C = len(coef), self.C

        def step(batches):
            loss, grad, curve = 0.0, np.zeros(d), np.zeros((d, d))
            for batch in batches:
                x, y, w, _ = _columns(batch)
                x, sign = np.hstack([x, np.ones((len(x), 1))]), 2 * y - 1
                gap = 1 - sign * (x @ coef)
                on = gap > 0
                x, sign, gap, w = x[on], sign[on], gap[on], w[on]
                loss += (w * gap * gap).sum()
                grad += x.T @ (w * gap * sign)
                curve += x.T @ (x * w[:, None])
            yield _row(1, np.concatenate([[loss], grad, curve.ravel()]))

        got = _summed(rows, step)
        return (coef @ coef / 2 + C * got[0], coef - 2 * C * got[1:d + 1],
                np.eye(d) + 2 * C * got[d + 1:].reshape(d, d))


class SquaredHingeModel(Model):
    def __init__(self, coefficients: np.ndarray):
        super().__init__()
        self.coefficients = coefficients

    def _transform(self, df: DataFrame) -> DataFrame:
        coef = self.coefficients

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()) @ coef[:-1] + coef[-1] if len(x) else [], dtype=float)

        s = F.col("__s")
        return _with_scores(df, margin(vector_to_array("features")), array_to_vector(F.array(-s, s)), s > 0).drop("__s")


class NeuralNet(Estimator):
    def __init__(self, hidden=(64,), alpha: float = 1e-4, maxIter: int = 100, patience: int = 10, tol: float = 1e-4,
                 batch: int = 200, rate: float = 1e-3, labelCol: str = "satisfied", idCol: str = "id", seed: int = 42):
        super().__init__()
        self.hidden, self.alpha, self.max_iter, self.patience = tuple(hidden), alpha, maxIter, patience
        self.tol, self.batch, self.rate, self.label, self.key, self.seed = tol, batch, rate, labelCol, idCol, seed

    def _start(self, sizes) -> list[np.ndarray]:
        rng, out = np.random.default_rng(self.seed), []
        for a, b in zip(sizes, sizes[1:]):
            reach = math.sqrt((6 if b != 1 else 2) / (a + b))
            out += [rng.uniform(-reach, reach, (a, b)), rng.uniform(-reach, reach, b)]
        return out

    def _fit(self, df: DataFrame) -> "NeuralNetModel":
        return fit_nets([self], df)[0]

    def run_epoch(self, batch, k: int, epoch: int, shapes, w, m, v, t: int):
        """Adam over the minibatches of one Arrow batch; returns the new state and step."""
        x, y = batch
        order = np.random.default_rng([self.seed, epoch, k]).permutation(len(x))
        for at in range(0, len(order), self.batch):
            some = order[at:at + self.batch]
            g = _gradient(_shaped(w, shapes), x[some], y[some], self.alpha)
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - self.rate * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-8)
        return w, m, v, t


def fit_nets(nets: list[NeuralNet], df: DataFrame) -> list["NeuralNetModel"]:
    """Fits several nets on the same rows: one pass per epoch serves all that still learn."""
    rows = matrix(df, nets[0].label, None, nets[0].key, nets[0].seed)
    first = rows.first()
    width = len(first["x"]) if first else 0
    starts = [net._start([width, *net.hidden, 1]) for net in nets]
    shapes = [[p.shape for p in layers] for layers in starts]
    found = [np.concatenate([p.ravel() for p in layers]) for layers in starts]
    state = [np.concatenate([w, np.zeros(2 * len(w))]) for w in found]
    best, since, losses = [math.inf] * len(nets), [0] * len(nets), [[] for _ in nets]
    for epoch in range(max(net.max_iter for net in nets) if first else 0):
        live = [k for k, net in enumerate(nets) if epoch < net.max_iter and since[k] < net.patience]
        if not live:
            break
        got = _summed(rows, _epoch([nets[k] for k in live], [shapes[k] for k in live], [state[k] for k in live],
                                   epoch), "mean")
        for k in live:
            size = len(state[k])
            state_now, sums, got = got[:size], got[size:size + 4], got[size + 4:]
            held = float(sums[2] / sums[3] if sums[3] > 0 else sums[0] / max(sums[1], 1e-300))
            losses[k].append(held)                              # the loss before this epoch
            if held < best[k] - nets[k].tol:
                best[k], found[k], since[k] = held, state[k][:size // 3], 0
            else:
                since[k] += 1
            state[k] = state_now
    return [NeuralNetModel(_shaped(w, s), loss) for w, s, loss in zip(found, shapes, losses)]


def _epoch(nets: list[NeuralNet], shapes: list, state: list[np.ndarray], epoch: int):
    def step(batches):
        now = [[*np.split(s.copy(), 3), epoch * 50] for s in state]
        sums = [np.zeros(4) for _ in nets]      # losses and rows, fitted on and held out
        n = 0
        for k, batch in enumerate(batches):
            x, y, _, held = _columns(batch)
            for i, net in enumerate(nets):
                loss = _log_loss(_forward(_shaped(state[i][:len(state[i]) // 3], shapes[i]), x)[-1], y)
                sums[i] += [loss[~held].sum(), (~held).sum(), loss[held].sum(), held.sum()]
                now[i] = list(net.run_epoch((x[~held], y[~held]), k, epoch, shapes[i], *now[i]))
            n += int((~held).sum())
        if len(sums) and sums[0][[1, 3]].sum():
            # the averages are weighted by rows: divided sums add up in proportion
            yield _row(max(n, 1), np.concatenate([v for i in range(len(nets))
                                                  for v in (*now[i][:3], sums[i] / max(n, 1))]))
    return step


class NeuralNetModel(Model):
    def __init__(self, layers: list[np.ndarray], losses: list[float]):
        super().__init__()
        self.layers, self.losses = layers, losses

    def _transform(self, df: DataFrame) -> DataFrame:
        layers = self.layers

        @F.pandas_udf("double")
        def positive(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(1 / (1 + np.exp(-np.clip(_forward(layers, np.stack(x.to_numpy()))[-1], -500, 500))))

        s = F.col("__s")
        both = array_to_vector(F.array(1 - s, s))
        return _with_scores(df, positive(vector_to_array("features")), both, s >= 0.5).withColumn(
            "probability", F.col("rawPrediction")).drop("__s")


def _shaped(flat: np.ndarray, shapes) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes:
        n = math.prod(shape)
        out.append(flat[at:at + n].reshape(shape))
        at += n
    return out


def _forward(layers: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """Inputs of each layer, and the margins at the end."""
    out = [x]
    for k in range(0, len(layers), 2):
        z = out[-1] @ layers[k] + layers[k + 1]
        out.append(z[:, 0] if k + 2 == len(layers) else np.maximum(z, 0))
    return out


def _log_loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, margin) - y * margin


def _gradient(layers: list[np.ndarray], x: np.ndarray, y: np.ndarray, alpha: float) -> np.ndarray:
    """Of the mean log loss plus alpha * |weights|^2 / (2 rows)."""
    acts, n = _forward(layers, x), len(x)
    delta = ((1 / (1 + np.exp(-np.clip(acts[-1], -500, 500))) - y) / n)[:, None]
    out: list[np.ndarray] = []
    for k in range(len(layers) - 2, -1, -2):
        out = [(acts[k // 2].T @ delta + alpha / n * layers[k]).ravel(), delta.sum(axis=0), *out]
        delta = (delta @ layers[k].T) * (acts[k // 2] > 0)
    return np.concatenate(out)


def bootstrap_count(key: str, tree: int, seed: int) -> Column:
    """How often a row is in a tree's resample: Poisson(1) from a hash of id and tree."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(tree), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return sum((F.when(u >= p, 1).otherwise(0) for p in poisson_cdf()), F.lit(0))


class SlicedBagging(Estimator):
    """``numTrees`` trees on a ``share`` of the features each.  The other features are zero for
    the tree, so it never splits on them and reads whole vectors when it predicts."""

    def __init__(self, numTrees: int = 50, share: float = 1.0, maxDepth: int = 16, minInstancesPerNode: int = 50,
                 labelCol: str = "satisfied", weightCol: str | None = "weight", idCol: str = "id", seed: int = 42,
                 parallelism: int = 8):
        super().__init__()
        self.n, self.share, self.depth, self.leaf = numTrees, share, maxDepth, minInstancesPerNode
        self.label, self.weight, self.key, self.seed, self.parallelism = labelCol, weightCol, idCol, seed, parallelism

    def slices(self, width: int) -> list[np.ndarray]:
        """Each tree's features."""
        k = max(1, int(self.share * width))
        return [np.sort(np.random.default_rng([self.seed, t]).choice(width, k, replace=False)) for t in range(self.n)]

    def _fit(self, df: DataFrame) -> "SlicedBaggingModel":
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = materialize(df.select("features", F.col(self.label).cast("double").alias("y"),
                                     weight.alias("w"), F.col(self.key).alias("key")), "bagging-rows")
        first = rows.first()
        width = len(first["features"]) if first else 0
        slices = self.slices(width) if width else []

        def one(t: int):
            mask = np.zeros(width)
            mask[slices[t]] = 1.0
            some = rows.withColumn("n", bootstrap_count("key", t, self.seed)).filter("n > 0")
            some = ElementwiseProduct(scalingVec=Vectors.dense(mask), inputCol="features",
                                      outputCol="sliced").transform(some.withColumn("w", F.col("w") * F.col("n")))
            return DecisionTreeClassifier(featuresCol="sliced", labelCol="y", weightCol="w", maxDepth=self.depth,
                                          minInstancesPerNode=self.leaf, seed=self.seed).fit(some)

        with ThreadPool(self.parallelism) as pool:
            trees = pool.map(inheritable_thread_target(one), range(len(slices)), 1)
        return SlicedBaggingModel(trees, slices)


class SlicedBaggingModel(Model):
    """The mean of the trees' class shares."""

    def __init__(self, trees: list, slices: list[np.ndarray]):
        super().__init__()
        self.trees, self.slices = trees, slices

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, out = [], df
        for k, tree in enumerate(self.trees):
            tree = tree.copy()
            tree.setFeaturesCol("features").setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"__p{k}")
            out = tree.transform(out)
            cols.append(vector_to_array(f"__p{k}")[1])
        s = sum(cols, F.lit(0.0)) / max(len(cols), 1)
        out = out.withColumn("__s", s).drop(*[f"__p{k}" for k in range(len(cols))])
        s = F.col("__s")
        return out.withColumns({"probability": array_to_vector(F.array(1 - s, s)),
                                "prediction": (s >= 0.5).cast("double")}).drop("__s")
