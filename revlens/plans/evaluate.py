"""Model evaluation and comparison plans.

All scoring collapses into one long scored table (model, split/fold/..., id,
y, pred, score); every metric is then one grouped job over it
(:mod:`revlens.operators.metrics`), never a per-model driver loop over rows.
Driver loops here iterate over *models, folds, feature subsets and
parameter settings* (each iteration launches distributed fits), which is
the inherent shape of the work.
"""

from __future__ import annotations

import time
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from revlens.operators import metrics as M
from revlens.operators.bootstrap import paired_bootstrap
from revlens.operators.ranking import global_rank
from revlens.operators.sampling import RANDOM_STATE, seeded_hash, stratified_sample
from revlens.plans import models as MD
from revlens.session import materialize

TARGET = "satisfied"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def metrics_table(scored: DataFrame, by: list[str]) -> DataFrame:
    """Classification metrics, gini, average precision and lift per group, joined."""
    scored = materialize(scored, "scored")      # every model is applied once, not once per metric
    cm = M.classification_metrics(scored, by=by).select(
        *by, "balanced_accuracy", "precision_1", "recall_1", "f1_1",
        "precision_0", "recall_0", "f1_0", "f1_macro")
    g = M.gini(scored, by=by)
    ap = M.average_precision(scored.withColumn("y", 1 - F.col("y"))
                             .withColumn("score", -F.col("score")), by=by) \
        .withColumnRenamed("ap", "pr_auc_dissatisfied")
    lift = M.top_decile_lift(scored, by=by).withColumnRenamed("lift", "top_decile_lift")
    lift0 = M.top_decile_lift(scored, by=by, pos_label=0) \
        .withColumnRenamed("lift", "top_decile_lift_dissat")
    return (cm.join(g, by, "left").join(ap, by, "left").join(lift, by, "left")
            .join(lift0, by, "left"))


def _side_by_side(work, items: list, parallelism: int = 4) -> list:
    """``work`` of each item, in their order, as Spark jobs from a few threads."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(work), items, 1)


def fit_all(models: dict[str, Pipeline], train: DataFrame, parallelism: int = 4) -> tuple[dict, dict]:
    """Fitted models and their wall-clock seconds; fits run side by side."""
    def fit(name):
        t0 = time.perf_counter()
        return name, models[name].fit(train), time.perf_counter() - t0

    done = _side_by_side(fit, list(models), parallelism)
    return {n: m for n, m, _ in done}, {n: t for n, _, t in done}


def evaluate(models: dict[str, Pipeline], train: DataFrame, test: DataFrame,
             keep=("id",)) -> tuple[DataFrame, DataFrame, dict]:
    """Fit every model, score train and test; returns (metrics, scored, fitted)."""
    fitted, _ = fit_all(models, train)
    scored = _union([MD.score(m, d, n, list(keep)).withColumn("split", F.lit(s))
                     for n, m in fitted.items() for s, d in (("train", train), ("test", test))])
    return metrics_table(scored, ["model", "split"]), scored, fitted


def cv_summary(scored: DataFrame) -> DataFrame:
    """Mean and population std over the folds, per model, of a long table of held-out scores."""
    per_fold = metrics_table(scored, ["model", "fold"])
    aggs = []
    for c, name in (("balanced_accuracy", "balanced_accuracy"), ("f1_1", "f1"), ("gini", "gini")):
        aggs += [F.round(F.avg(c), 6).alias(f"{name}_mean"),
                 F.round(F.stddev_pop(c), 6).alias(f"{name}_std")]
    return per_fold.groupBy("model").agg(*aggs)


def cross_validate(models: dict[str, Pipeline], folds: list[tuple[DataFrame, DataFrame]],
                   keep=("id",)) -> DataFrame:
    """:func:`cv_summary` of whole pipelines over ``folds``: (rows to fit on, held-out rows).
    :mod:`revlens.plans.search` does the same on shared feature matrices."""
    return cv_summary(_union([MD.score(pipe.fit(tr), va, name, list(keep)).withColumn("fold", F.lit(f))
                              for f, (tr, va) in enumerate(folds) for name, pipe in models.items()]))


# ---------------------------------------------------------------------------
# Permutation importance
# ---------------------------------------------------------------------------

def bijection(index: np.ndarray, n: int, key: list[int], rounds: int = 4) -> np.ndarray:
    """A seeded one-to-one map of 0 ... n-1: a Feistel network on the least even number of
    bits that holds n, walked on until the value is below n."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    salts = np.random.default_rng(key).integers(0, 2**64, rounds, dtype=np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & low
        for salt in salts:
            z = (right + salt) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & low)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (out >= n).any():
        out = np.where(out >= n, once(out), out)
    return out.astype(np.int64)


#: Rows that get their permuted values in one task.
BLOCK_ROWS = 50_000


def permuted_copies(data: DataFrame, features: list[str], repeats: int, key: str = "id",
                    seed: int = RANDOM_STATE) -> DataFrame:
    """One copy of ``data`` per (feature, repeat) with that feature's whole column permuted.

    Rows get a dense index once (in order of a seeded hash, two-level ranks).  For each
    copy a seeded bijection of the indexes says which row a value goes to.  Rows are dealt to
    blocks by index; a task sends each block its values of a copy as one list, a block puts
    them in order, and the copies flow from there straight into the model."""
    order = [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)]
    rows = global_rank(data, order, name="__at").withColumn("__at", F.col("__at") - 1)
    n = rows.count()
    kinds = dict(data.dtypes)
    text = [f for f in features if kinds[f] in ("string", "boolean", "date", "timestamp")]
    sent = rows.select("__at", *[F.col(f).cast("string" if f in text else "double").alias(f) for f in features])
    small = n <= BLOCK_ROWS << 16       # block numbers of two bytes are sorted faster

    def send(batches):
        for batch in batches:
            at = batch.column(0).to_numpy()
            for k, f in enumerate(features):
                for r in range(repeats):
                    to = bijection(at, n, [seed, k, r])
                    block = to // BLOCK_ROWS
                    order = np.argsort(block.astype(np.uint16) if small else block, kind="stable")
                    block = block[order]
                    start = np.flatnonzero(np.diff(block, prepend=-1))
                    ends = pa.array(np.append(start, len(block)), pa.int32())
                    given = pa.ListArray.from_arrays(ends, batch.column(k + 1).take(pa.array(order)))
                    none = pa.nulls(len(start), pa.list_(pa.float64() if f in text else pa.string()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block[start]), pa.array([k * repeats + r] * len(start), pa.int32()),
                         pa.ListArray.from_arrays(ends, pa.array(to[order] % BLOCK_ROWS, pa.int32())),
                         *((none, given) if f in text else (given, none))], names=["block", "copy", "to", "num", "txt"])

    moved = sent.mapInArrow(send, "block bigint, copy int, to array<int>, num array<double>, txt array<string>")
    here = rows.withColumn("block", F.floor(F.col("__at") / BLOCK_ROWS))
    new = {f: f"__new{k}" for k, f in enumerate(features)}
    schema = StructType([*here.schema.fields, *[
        StructField(new[f], ArrayType(StringType() if f in text else DoubleType())) for f in features]])

    def receive(block: pa.Table, given: pa.Table) -> pa.Table:
        block, size = block.sort_by("__at"), block.num_rows
        every = np.arange(size * repeats)
        ends = pa.array(np.arange(0, size * repeats + 1, repeats), pa.int32())
        for k, f in enumerate(features):
            of = given.filter((pc.field("copy") >= k * repeats) & (pc.field("copy") < (k + 1) * repeats))
            lists = [of[c].combine_chunks() for c in ("to", "txt" if f in text else "num")]
            repeat = np.repeat(of["copy"].to_numpy() - k * repeats, pc.list_value_length(lists[0]).to_numpy())
            place = np.empty(len(every), np.int64)
            place[lists[0].flatten().to_numpy().astype(np.int64) * repeats + repeat] = every
            block = block.append_column(new[f], pa.ListArray.from_arrays(ends, lists[1].flatten().take(pa.array(place))))
        return block.select(schema.names)

    got = here.groupBy("block").cogroup(moved.groupBy("block")).applyInArrow(receive, schema)
    each = got.withColumn("__new", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"),
                 (F.lit(None).cast("double") if f in text else F.col(new[f])[r]).alias("num"),
                 (F.col(new[f])[r] if f in text else F.lit(None).cast("string")).alias("txt"))
        for f in features for r in range(repeats)])))

    def column(c):
        if c not in features:
            return F.col(c)
        value = F.col("__new.txt" if c in text else "__new.num").cast(kinds[c])
        return F.when(F.col("__new.feature") == c, value).otherwise(F.col(c)).alias(c)

    return each.select(*[column(c) for c in data.columns], "__new.feature", "__new.repeat")


def _auc_drops(model, data: DataFrame, features: list[str], repeats: int, key: str) -> DataFrame:
    """(feature, drop): mean over the repeats of the loss in AUC, not clipped."""
    base = M.roc_auc(MD.score(model, data, "m", [key])).first()["auc"]
    copies = MD.score(model, permuted_copies(data, features, repeats, key), "m",
                      [key, "feature", "repeat"])
    auc = M.roc_auc(copies, by=["feature", "repeat"])
    return auc.groupBy("feature").agg((F.lit(base) - F.avg("auc")).alias("drop"))


def permutation_importance(fitted: dict, data: DataFrame, features: list[str], repeats: int = 5,
                           key: str = "id", n_models: int = 3, top: int | None = None) -> DataFrame:
    """Loss in AUC when one feature is permuted: mean over repeats, negative means
    as 0, mean over the ``n_models`` models with the best AUC.  All features
    unless a ``top`` report is asked for."""
    auc = dict(zip(fitted, _side_by_side(
        lambda n: M.roc_auc(MD.score(fitted[n], data, n, [key])).first()["auc"], list(fitted))))
    best = sorted(auc, key=lambda n: (-auc[n], n))[:n_models]
    drops = _union(_side_by_side(lambda n: _auc_drops(fitted[n], data, features, repeats, key), best))
    table = (drops.groupBy("feature")
             .agg(F.round(F.avg(F.greatest(F.lit(0.0), F.col("drop"))), 6).alias("importance"))
             .orderBy(F.col("importance").desc(), "feature"))
    return table.limit(top) if top else table


def cv_permutation_importance(pipe: Pipeline, folds: list[tuple[DataFrame, DataFrame]],
                              features: list[str], repeats: int = 3, key: str = "id") -> DataFrame:
    """Out-of-fold permutation importance (loss in AUC), mean over ``folds`` (rows to
    fit on, held-out rows), all features and all held-out rows."""
    parts = _side_by_side(lambda fold: _auc_drops(pipe.fit(fold[0]), fold[1], features, repeats, key), folds)
    return (_union(parts).groupBy("feature").agg(F.round(F.avg("drop"), 6).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))


# ---------------------------------------------------------------------------
# Curves and ablations
# ---------------------------------------------------------------------------

def _variants_scored(builds: dict, train: DataFrame, test: DataFrame, key: str = "id"):
    """Fit each variant on ``train`` and score ``test``: one long scored table.

    Each variant's scores are written, so later jobs neither score again nor plan all pipelines at once."""
    return _union(_side_by_side(
        lambda v: materialize(MD.score(v[1]().fit(train), test, v[0], [key]), "variant-scores"), list(builds.items())))


def topk_curve(build, ranking: list[str], train: DataFrame, test: DataFrame,
               ks=(5, 10, 25, 50), replicates: int = 2000) -> DataFrame:
    """Refit on the top-k features of ``ranking``; gini, % of the all-feature
    gini and paired-bootstrap intervals of the difference to the full model."""
    sizes = [k for k in ks if k < len(ranking)] + [len(ranking)]
    builds = {str(k): (lambda k=k: build(ranking[:k])) for k in sizes}
    scored = _variants_scored(builds, train, test)
    boot = paired_bootstrap(scored, str(len(ranking)), replicates=replicates)
    full = boot.where(F.col("model") == str(len(ranking))).select("gini").scalar()
    return boot.select(F.col("model").cast("int").alias("n_features"), "gini",
                       F.round(F.col("gini") / full * 100, 2).alias("pct_of_full"),
                       "delta_vs_full", "delta_bonf_lo", "delta_bonf_hi",
                       "differs_from_full_bonf")


def group_ablation(build, groups: dict[str, list[str]], features: list[str], train: DataFrame,
                   test: DataFrame, replicates: int = 2000) -> DataFrame:
    """Refit without each feature block (row ``ALL``: no block left out); the block
    matters when the Bonferroni upper bound of (gini without it - full gini) is
    below 0."""
    builds = {"ALL": lambda: build(features)}
    for g, cols in groups.items():
        kept = [c for c in features if c not in cols]
        if kept:
            builds[g] = lambda kept=kept: build(kept)
    scored = _variants_scored(builds, train, test)
    boot = paired_bootstrap(scored, "ALL", replicates=replicates)
    return boot.select(
        F.col("model").alias("block"), "gini", "delta_vs_full", "delta_vs_full_lo",
        "delta_vs_full_hi", "delta_bonf_lo", "delta_bonf_hi",
        (F.col("delta_bonf_hi") < 0).alias("block_has_value"))


# Training sizes and the bound of the test rows.
CURVE_SIZES = (10_000, 25_000, 50_000, 100_000, 250_000, 500_000, 1_000_000)
CURVE_TEST_ROWS = 250_000


def learning_curve(builds: dict, pool: DataFrame, test: DataFrame, sizes=CURVE_SIZES,
                   key: str = "id", y: str = TARGET, test_rows: int = CURVE_TEST_ROWS) -> DataFrame:
    """Gini vs training size on one fixed test set (at most ``test_rows``, stratified).

    Training sets are nested: a row's level is the first size whose n smallest seeded
    hashes hold it, computed once and stored with the rows, so a size reads the rows up to
    its level.  All fits run side by side.  One row per size with a column per model;
    sizes above the pool have status ``skipped`` and no gini."""
    sizes = sorted(sizes)
    total = pool.count()
    able = [n for n in sizes if n <= total]
    spark = pool.sparkSession
    ranked = global_rank(pool.withColumn("__h", seeded_hash([key])), [F.col("__h"), F.col(key)],
                         name="__r").drop("__h")
    level = sum(((F.col("__r") > n).cast("int") for n in able), F.lit(0))
    rows = materialize(ranked.withColumn("__level", level).drop("__r").where(F.col("__level") < len(able)),
                       "curve-rows")
    held = materialize(stratified_sample(test, y, test_rows, [key]), "curve-test")

    def one(job):
        k, name = job
        fitted = builds[name]().fit(rows.where(F.col("__level") <= k).drop("__level"))
        return MD.score(fitted, held, name, [key]).withColumn("n_train", F.lit(able[k]))

    scored = _side_by_side(one, [(k, n) for k in range(len(able)) for n in builds])
    listed = spark.createDataFrame([(n, "fitted" if n <= total else "skipped") for n in sizes],
                                   "n_train int, status string")
    if not scored:
        return listed.withColumns({n: F.lit(None).cast("double") for n in sorted(builds)})
    ginis = M.gini(_union(scored), by=["n_train", "model"], digits=None)
    wide = ginis.groupBy("n_train").pivot("model", sorted(builds)).agg(F.round(F.first("gini"), 6))
    return listed.join(wide, "n_train", "left")


def logistic_coefficients(fitted_pipe, data: DataFrame, top: int = 20) -> DataFrame:
    """Coefficient, odds ratio and encoded feature name, ordered by |coef|."""
    lr = fitted_pipe.stages[-1]
    feats = fitted_pipe.transform(data.limit(1)).schema["features"].metadata
    attrs = feats.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    coefs = lr.coefficients.toArray().tolist()
    rows = [(names.get(i, f"f{i}"), float(c)) for i, c in enumerate(coefs)]
    df = data.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return (df.select("feature", F.round("coefficient", 6).alias("coefficient"),
                      F.round(F.exp("coefficient"), 6).alias("odds_ratio"))
            .orderBy(F.abs("coefficient").desc(), "feature").limit(top))


def importance_agreement(imp_a: DataFrame, imp_b: DataFrame, k: int = 10) -> DataFrame:
    """Spearman of two importance rankings on shared features, and top-k overlap size."""
    from revlens.operators.ranking import spearman
    from revlens.operators.setops import overlap_and_difference
    j = imp_a.select("feature", F.col("importance").alias("a")).join(
        imp_b.select("feature", F.col("importance").alias("b")), "feature", "inner")
    rho = spearman(j, "a", "b").select(F.round("spearman", 6).alias("spearman"))
    ov = overlap_and_difference(imp_a, imp_b, "feature", "importance", k)
    counts = ov.groupBy().pivot("membership", ["both", "only_a", "only_b"]).count()
    return rho.withColumns({m: counts.select(F.coalesce(F.col(m), F.lit(0))).scalar()
                            for m in ["both", "only_a", "only_b"]})
