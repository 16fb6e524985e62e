"""Spark ML pipelines for the nine model families and their preprocessors.

Every model is a complete ``Pipeline`` (imputation, encoding, scaling and the
estimator), so cross-validation and refits never leak test statistics.

Mapping to Spark ML (differences are documented, not hidden):

* logistic regression: ``LogisticRegression`` with ``regParam = 1 / (C * sum(w))``
  and no internal standardisation (the pipeline already scales);
* linear SVM: :class:`revlens.plans.estimators.SquaredHingeSVC`;
* naive Bayes: ``NaiveBayes(modelType='bernoulli')`` over quantile-bin
  indicators (Spark also smooths the class prior);
* neural network: :class:`revlens.plans.estimators.NeuralNet` (relu, L2, Adam,
  stopped by the loss of a held-out tenth);
* decision tree / random forest: the Spark trees with the same depth and
  leaf-size caps; bagging = a forest with ``featureSubsetStrategy='all'``, or
  :class:`revlens.plans.estimators.SlicedBagging` for a share of the features per tree;
* gradient boosting: ``GBTClassifier`` (a depth cap that allows as many leaves instead
  of a leaf cap, no L2, no native NULL handling: median-imputed inputs); a tenth
  of the training rows (by a hash of the id) stops it early;
* k-nearest neighbours: :class:`revlens.operators.knn.KNNClassifier`, a
  pipeline stage around the exact distributed job
  :func:`revlens.operators.knn.knn_scores` (on the scaled preprocessor's vectors).

Balanced class weights (n / (2 n_class)) are a column used through
``weightCol`` wherever Spark supports it (not by the MLP and naive Bayes).
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from revlens.operators.quantiles import quantiles_checked
from revlens.plans.estimators import NeuralNet, SlicedBagging, SquaredHingeSVC

SEED = 42
UNKNOWN = "Unknown"
INFREQUENT = "__infrequent__"
MIN_FREQUENCY = 50
MODEL_NAMES = ["logistic_regression", "svm_linear", "knn", "naive_bayes", "neural_net",
               "decision_tree", "bagging", "random_forest", "hist_gradient_boosting"]


class RareLevelMerger(Estimator):
    """Levels seen fewer than ``min_frequency`` times in training are merged
    into one infrequent level; levels never seen in training are left as they
    are (the indexer then maps them to its invalid slot, encoded as all zeros).

    Fitting is one grouped count per (column, level): only the level list,
    bounded by the columns' cardinality, reaches the driver."""

    def __init__(self, cols: list[str], min_frequency: int = MIN_FREQUENCY):
        super().__init__()
        self.cols, self.min_frequency = list(cols), min_frequency

    def _fit(self, df: DataFrame) -> "RareLevelMergerModel":
        if not self.cols:
            return RareLevelMergerModel(self.cols, {}, {})
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                    for c in self.cols]))
        counts = df.select(pairs.alias("x")).groupBy("x.c", "x.v").count().collect()
        frequent = {c: [] for c in self.cols}
        rare = {c: [] for c in self.cols}
        for r in counts:
            (frequent if r["count"] >= self.min_frequency else rare)[r["c"]].append(r["v"])
        return RareLevelMergerModel(self.cols, frequent, rare)


class RareLevelMergerModel(Model):
    def __init__(self, cols, frequent, rare):
        super().__init__()
        self.cols, self.frequent, self.rare = cols, frequent, rare

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c in self.cols:
            if self.rare.get(c):
                out[c] = F.when(F.col(c).isin(*self.rare[c]), F.lit(INFREQUENT)).otherwise(F.col(c))
        return df.withColumns(out) if out else df


class FillUnknown(Transformer):
    """Constant imputation of categorical NULLs with 'Unknown'."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
                               for c in self.cols})


def _fill_unknown(cat: list[str]) -> list:
    return [FillUnknown(cat)] if cat else []


class ExactImputer(Estimator):
    """NULLs become the column's exact median, or its most frequent value (the least of equals);
    0 for a column without values.  Outputs ``<column>__imp``."""

    def __init__(self, cols: list[str], strategy: str = "median"):
        super().__init__()
        self.cols, self.strategy = list(cols), strategy

    def _fit(self, df: DataFrame) -> "FilledModel":
        if self.strategy == "median":
            found = {c: v[0] for c, v in quantiles_checked(df, self.cols, [0.5]).items()}
        else:
            pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v"))
                                        for c in self.cols]))
            counts = (df.select(pairs.alias("x")).where("x.v is not null and not isnan(x.v)")
                      .groupBy("x.c", "x.v").agg(F.count(F.lit(1)).alias("n")))
            most = counts.groupBy("c").agg(F.max(F.struct("n", (-F.col("v")).alias("less"))).alias("m"))
            found = {r["c"]: -r["m"]["less"] for r in most.collect()}       # one row per column
        return FilledModel({c: 0.0 if found.get(c) is None else float(found[c]) for c in self.cols})


class FilledModel(Model):
    def __init__(self, values: dict[str, float]):
        super().__init__()
        self.values = values

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}__imp": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(v))
                               for c, v in self.values.items()})


def _impute(num: list[str], strategy: str = "median") -> list:
    return [ExactImputer(num, strategy)] if num else []


class QuantileBinner(Estimator):
    """Exact quantile edges (linear interpolation; edges closer than 1e-8 are merged): bin numbers
    ``<column>__bin`` and their indicators ``<column>__bohe``."""

    def __init__(self, cols: list[str], suffix: str, n_bins: int):
        super().__init__()
        self.cols, self.suffix, self.n_bins = list(cols), suffix, n_bins

    def _fit(self, df: DataFrame) -> "QuantileBinnerModel":
        probs = [k / self.n_bins for k in range(self.n_bins + 1)]
        found = quantiles_checked(df, [c + self.suffix for c in self.cols], probs)
        inner = {}
        for c in self.cols:
            edges: list[float] = []
            for e in found[c + self.suffix]:
                if e is not None and (not edges or e - edges[-1] > 1e-8):
                    edges.append(e)
            inner[c] = edges[1:-1]
        return QuantileBinnerModel(inner, self.suffix)


class QuantileBinnerModel(Model):
    def __init__(self, inner: dict[str, list[float]], suffix: str):
        super().__init__()
        self.inner, self.suffix = inner, suffix

    def _transform(self, df: DataFrame) -> DataFrame:
        bins = {f"{c}__bin": sum(((F.col(c + self.suffix) >= e).cast("int") for e in edges), F.lit(0))
                for c, edges in self.inner.items()}
        hot = {f"{c}__bohe": array_to_vector(F.array(*[(F.col(f"{c}__bin") == k).cast("double")
                                                       for k in range(len(edges) + 1)]))
               for c, edges in self.inner.items()}
        return df.withColumns(bins).withColumns(hot)


class OrdinalCoder(Estimator):
    """Categories as their place among the sorted training levels; -1 for NULL and
    for levels not seen in training.  The codes carry no nominal metadata, so
    trees split them as ordered features."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> "OrdinalCoderModel":
        return OrdinalCoderModel(self.cols, StringIndexer(
            inputCols=self.cols, outputCols=[f"{c}__idx" for c in self.cols],
            handleInvalid="keep", stringOrderType="alphabetAsc").fit(df))


class OrdinalCoderModel(Model):
    def __init__(self, cols: list[str], indexer):
        super().__init__()
        self.cols, self.indexer = cols, indexer

    def _transform(self, df: DataFrame) -> DataFrame:
        coded = {f"{c}__ord": F.when(F.col(f"{c}__idx") < len(levels), F.col(f"{c}__idx")).otherwise(-1.0)
                 for c, levels in zip(self.cols, self.indexer.labelsArray)}
        return self.indexer.transform(df).withColumns(coded)


def scaled_preprocessor(num: list[str], cat: list[str], out: str = "features",
                        scale: bool = True) -> list:
    """Median-impute + standardise numerics; 'Unknown'-fill, rare-merge, one-hot categoricals."""
    stages = _fill_unknown(cat) + _impute(num)
    parts = []
    if num:
        stages.append(VectorAssembler(inputCols=[f"{c}__imp" for c in num], outputCol="__num"))
        if scale:
            stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True,
                                         withStd=True))
        parts.append("__num_s" if scale else "__num")
    if cat:
        stages += [RareLevelMerger(cat),
                   StringIndexer(inputCols=cat, outputCols=[f"{c}__idx" for c in cat],
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=[f"{c}__idx" for c in cat],
                                 outputCols=[f"{c}__ohe" for c in cat], dropLast=True)]
        parts += [f"{c}__ohe" for c in cat]
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


def ordinal_preprocessor(num: list[str], cat: list[str], out: str = "features") -> list:
    """Median-impute numerics; categoricals as sorted codes (NULL and unseen: -1)."""
    stages = _impute(num)
    parts = [f"{c}__imp" for c in num]
    if cat:
        stages.append(OrdinalCoder(cat))
        parts += [f"{c}__ord" for c in cat]
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


def binned_preprocessor(num: list[str], binary: list[str], cat: list[str], n_bins: int = 10,
                        out: str = "features") -> list:
    """Quantile bins (duplicate edges merged) one-hot encoded; 0/1 columns pass through
    with their most frequent value for NULL."""
    cont = [c for c in num if c not in binary]
    stages = (_fill_unknown(cat) + _impute(cont)
              + _impute([c for c in num if c in binary], "mode"))
    parts = [f"{c}__imp" for c in num if c in binary]
    if cont:
        stages.append(QuantileBinner(cont, "__imp", n_bins))
        parts += [f"{c}__bohe" for c in cont]
    if cat:
        stages += [RareLevelMerger(cat),
                   StringIndexer(inputCols=cat, outputCols=[f"{c}__idx" for c in cat],
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=[f"{c}__idx" for c in cat],
                                 outputCols=[f"{c}__ohe" for c in cat], dropLast=True)]
        parts += [f"{c}__ohe" for c in cat]
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


#: Preprocessor of each model.
FAMILY = {"naive_bayes": "binned", "decision_tree": "ordinal", "bagging": "ordinal", "random_forest": "ordinal",
          "hist_gradient_boosting": "ordinal"}


def preprocessor(name: str, num: list[str], cat: list[str], binary: list[str] = (), n_bins: int = 10) -> list:
    """The preprocessing stages of model ``name``."""
    family = FAMILY.get(name, "scaled")
    if family == "binned":
        return binned_preprocessor(num, list(binary), cat, n_bins)
    return ordinal_preprocessor(num, cat) if family == "ordinal" else scaled_preprocessor(num, cat)


def early_stop(key: str = "id") -> SQLTransformer:
    """Marks the tenth of the rows that stops gradient boosting."""
    return SQLTransformer(statement=f"SELECT *, pmod(xxhash64({key}, {SEED}), 10) = 0 AS __early_stop FROM __THIS__")


def estimator(name: str, n: int, label: str = "satisfied", weight: str = "weight", **params):
    """The estimator of model ``name`` for ``n`` fit rows; ``params`` override its defaults."""
    common = dict(featuresCol="features", labelCol=label)

    def p(key, default):
        return params.get(key, default)

    if name == "logistic_regression":
        return LogisticRegression(weightCol=weight, regParam=1.0 / (p("C", 1.0) * n), elasticNetParam=0.0,
                                  standardization=False, maxIter=p("maxIter", 100), **common)
    if name == "svm_linear":
        return SquaredHingeSVC(C=p("C", 1.0), labelCol=label, weightCol=weight)
    if name == "knn":
        from revlens.operators.knn import KNNClassifier
        return KNNClassifier(k=p("n_neighbors", 25), idCol=p("idCol", "id"), labelCol=label)
    if name == "naive_bayes":
        return NaiveBayes(modelType="bernoulli", smoothing=p("alpha", 1.0), **common)
    if name == "neural_net":
        return NeuralNet(hidden=p("hidden", (64,)), alpha=p("alpha", 1e-4), maxIter=p("maxIter", 100), labelCol=label,
                         seed=SEED)
    if name == "decision_tree":
        return DecisionTreeClassifier(
            maxDepth=p("maxDepth", 12), minInstancesPerNode=p("minInstancesPerNode", 50),
            impurity=p("impurity", "gini"), weightCol=weight, seed=SEED, **common)
    if name == "bagging" and p("max_features", 1.0) < 1:
        return SlicedBagging(numTrees=p("numTrees", 50), share=p("max_features", 1.0), maxDepth=p("maxDepth", 16),
                             minInstancesPerNode=p("minInstancesPerNode", 50), labelCol=label, weightCol=weight,
                             seed=SEED)
    if name in ("bagging", "random_forest"):
        return RandomForestClassifier(
            numTrees=p("numTrees", 50 if name == "bagging" else 200), maxDepth=p("maxDepth", 16),
            minInstancesPerNode=p("minInstancesPerNode", 50),
            featureSubsetStrategy="all" if name == "bagging" else p("featureSubsetStrategy", "sqrt"),
            bootstrap=True, subsamplingRate=1.0, weightCol=weight, seed=SEED, **common)
    if name == "hist_gradient_boosting":
        return GBTClassifier(
            maxIter=p("maxIter", 500), validationIndicatorCol="__early_stop", validationTol=p("validationTol", 1e-3),
            maxDepth=p("maxDepth", 5), stepSize=p("stepSize", 0.1),
            minInstancesPerNode=p("minInstancesPerNode", 20), weightCol=weight, seed=SEED, **common)
    raise ValueError(f"unknown model {name}")


def build_models(train: DataFrame, num: list[str], cat: list[str], binary: list[str] = (),
                 label: str = "satisfied", weight: str = "weight", params: dict | None = None,
                 names: list[str] | None = None) -> dict[str, Pipeline]:
    """Name -> complete Pipeline.  ``params`` overrides per model, e.g. with the best of a search."""
    n, out = train.count(), {}
    for name in MODEL_NAMES:
        if names is None or name in names:
            own = dict((params or {}).get(name, {}))
            stages = preprocessor(name, num, cat, binary, own.pop("n_bins", 10))
            if name == "hist_gradient_boosting":
                stages = [early_stop()] + stages
            out[name] = Pipeline(stages=stages + [estimator(name, n, label, weight, **own)])
    return out


def score(model, df: DataFrame, name: str, keep: list[str] = ("id",),
          label: str = "satisfied") -> DataFrame:
    """(model, keep..., y, pred, score): P(class 1) where the estimator has
    probabilities, else the class-1 margin."""
    out = model.transform(df)
    if "probability" in out.columns:
        s = vector_to_array("probability")[1]
    else:
        s = vector_to_array("rawPrediction")[1]
    return out.select(F.lit(name).alias("model"), *keep, F.col(label).alias("y"),
                      F.col("prediction").cast("int").alias("pred"), s.alias("score"))
