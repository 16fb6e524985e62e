"""Evaluation metrics over a long scored table.

Input shape: one row per (group..., row) with a 0/1 label, a score and
optionally a hard prediction; ``by`` names the group columns (model, split,
replicate ...), so every model is evaluated by *one* grouped job.

Exact rank metrics (ROC-AUC / gini, average precision, PR curve) first
collapse rows to one row per distinct (group, score) with positive/negative
counts.  The AUC adds up pairs per score range and then across ranges; the others
cumulate in two levels (:func:`revlens.operators.ranking.cumulative`).
Spark's ``BinaryClassificationEvaluator`` bins scores (approximate) and uses
trapezoids for PR, so it is not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from revlens.functions.expr import round_half_even
from revlens.operators.ranking import TOPK_MAX_ROWS, cumulative, global_rank, group_runs


def score_histogram(df: DataFrame, y: str = "y", score: str = "score", by=(),
                    weight: str | None = None) -> DataFrame:
    """(by..., score, pos, neg) with (weighted) positive / negative counts."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    yy = F.col(y).cast("double")
    return (df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
            .groupBy(*by, score)
            .agg(F.sum(w * yy).alias("pos"), F.sum(w * (1 - yy)).alias("neg")))


def _range_pairs(groups: int):
    """Per batch and group of (by..., score, pos, neg) in order: the first score, and concordant
    pairs (ties one half), positives and negatives of its score range."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = group_runs(batch, list(range(groups)))
            start = np.flatnonzero(np.diff(codes, prepend=-1))
            pos, neg = (batch.column(groups + k).to_numpy(zero_copy_only=False) for k in (1, 2))
            below = np.cumsum(neg) - neg
            pairs = pos * (below - below[start][codes] + neg / 2)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(start)) for c in batch.columns[:groups + 1]],
                 *[pa.array(np.add.reduceat(v, start)) for v in (pairs, pos, neg)]],
                names=[*batch.schema.names[:groups + 1], "__u", "__p", "__n"])
    return run


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", by=(),
            weight: str | None = None, partitions: int | None = None) -> DataFrame:
    """ROC-AUC with ties counted one half, per group; NULL for a one-class group."""
    by = list(by)
    h = score_histogram(df, y, score, by, weight)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = h.repartitionByRange(n, *by, score).sortWithinPartitions(*by, score)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in h.schema.fields[:-2])
    ranges = ranged.mapInArrow(_range_pairs(len(by)), f"{kinds}, __u double, __p double, __n double")
    # negatives of the ranges below; a range is one row per batch and group
    below = F.coalesce(F.sum("__n").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(score).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0.0))
    agg = ranges.withColumn("__u", F.col("__u") + F.col("__p") * below).groupBy(*by).agg(
        F.sum("__u").alias("u"), F.sum("__p").alias("p"), F.sum("__n").alias("n"))
    auc = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p") * F.col("n")))
    return agg.select(*by, auc.alias("auc"))


def gini(df: DataFrame, y: str = "y", score: str = "score", by=(), weight: str | None = None,
         partitions: int | None = None, digits: int | None = 6) -> DataFrame:
    """Gini = 2 * AUC - 1."""
    a = roc_auc(df, y, score, by, weight, partitions)
    g = 2 * F.col("auc") - 1
    return a.select(*by, (round_half_even(g, digits) if digits is not None else g).alias("gini"))


def _desc_cumulative(df, y, score, by, partitions):
    h = score_histogram(df, y, score, by)
    return cumulative(h, [F.col(score).desc()], ["pos", "neg"], list(by), partitions)


def average_precision(df: DataFrame, y: str = "y", score: str = "score", by=(),
                      partitions: int | None = None, digits: int | None = 6) -> DataFrame:
    """Step-wise average precision: sum over distinct thresholds (descending) of
    recall increase x precision.  NULL when a group has no positives."""
    by = list(by)
    c = _desc_cumulative(df, y, score, by, partitions)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = c.groupBy(*by).agg(F.sum(F.col("pos") * prec).alias("s"), F.sum("pos").alias("p"))
    ap = F.when(F.col("p") > 0, F.col("s") / F.col("p"))
    return agg.select(*by, (round_half_even(ap, digits) if digits is not None else ap).alias("ap"))


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", by=(),
             partitions: int | None = None, digits: int | None = 6) -> DataFrame:
    """Precision and recall at every distinct threshold (score >= threshold)."""
    by = list(by)
    c = _desc_cumulative(df, y, score, by, partitions)
    if by:
        c = c.join(c.groupBy(*by).agg(F.sum("pos").alias("__p")), by, "inner")
    else:
        c = c.withColumn("__p", c.agg(F.sum("pos")).scalar())
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    rec = F.when(F.col("__p") > 0, F.col("cum_pos") / F.col("__p"))
    r = (lambda e: round_half_even(e, digits)) if digits is not None else (lambda e: e)
    return c.select(*by, F.col(score).alias("threshold"), r(prec).alias("precision"),
                    r(rec).alias("recall"))


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "pred", by=()) -> DataFrame:
    return df.groupBy(*by, y, pred).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, y: str = "y", pred: str = "pred", by=(),
                           digits: int | None = 6) -> DataFrame:
    """Balanced accuracy, per-class precision/recall/F1, macro F1 (0 on 0/0)."""
    yy, pp = F.col(y), F.col(pred)
    agg = df.groupBy(*by).agg(
        F.count(F.when((yy == 1) & (pp == 1), 1)).alias("tp"),
        F.count(F.when((yy == 0) & (pp == 1), 1)).alias("fp"),
        F.count(F.when((yy == 0) & (pp == 0), 1)).alias("tn"),
        F.count(F.when((yy == 1) & (pp == 0), 1)).alias("fn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double") if isinstance(a, str) else a,
                                       F.col(b).cast("double") if isinstance(b, str) else b),
                          F.lit(0.0))

    p1 = ratio("tp", F.col("tp") + F.col("fp"))
    r1 = ratio("tp", F.col("tp") + F.col("fn"))
    p0 = ratio("tn", F.col("tn") + F.col("fn"))
    r0 = ratio("tn", F.col("tn") + F.col("fp"))
    f1 = F.coalesce(F.try_divide(2 * p1 * r1, p1 + r1), F.lit(0.0))
    f0 = F.coalesce(F.try_divide(2 * p0 * r0, p0 + r0), F.lit(0.0))
    r = (lambda e: round_half_even(e, digits)) if digits is not None else (lambda e: e)
    return agg.select(*by, "tp", "fp", "tn", "fn",
                      r((r1 + r0) / 2).alias("balanced_accuracy"),
                      r(p1).alias("precision_1"), r(r1).alias("recall_1"), r(f1).alias("f1_1"),
                      r(p0).alias("precision_0"), r(r0).alias("recall_0"), r(f0).alias("f1_0"),
                      r((f1 + f0) / 2).alias("f1_macro"))


def top_decile_lift(df: DataFrame, y: str = "y", score: str = "score", key: str = "id",
                    fraction: float = 0.1, pos_label: int = 1, by=(),
                    partitions: int | None = None, digits: int | None = 6) -> DataFrame:
    """Rate of ``pos_label`` among the top ``k = max(1, round(n * fraction))``
    cases divided by its base rate; NULL when the base is 0.  Cases are ranked
    by descending score for ``pos_label = 1`` and by ascending score for
    ``pos_label = 0`` (ties broken by ``key``).  ``round`` is half-to-even.

    Rows are never ranked one by one: the descending cumulative histogram of
    distinct scores locates the boundary score per group (everything above it
    is in the top k), and only the rows *at* the boundary score are ranked by
    key to take the remaining m rows."""
    by = list(by)
    single = not by
    if single:                      # one group: a constant key keeps every join an equi-join
        df, by = df.withColumn("__g", F.lit(0)), ["__g"]
    hit = (F.col(y) == pos_label).cast("double")
    ranked_score = F.col(score) if pos_label == 1 else -F.col(score)
    d = df.select(*by, key, ranked_score.alias(score), hit.alias("__hit"))
    h = (d.groupBy(*by, score)
         .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("__hit").alias("p")))
    c = cumulative(h, [F.col(score).desc()], ["n", "p"], by, partitions)
    tot = h.groupBy(*by).agg(F.sum("n").alias("__n"), F.sum("p").alias("__p"))
    c = c.join(F.broadcast(tot), by, "inner")      # one row per group
    k = F.greatest(F.lit(1.0), F.bround(F.col("__n") * fraction, 0))
    # boundary = first distinct score whose cumulative count reaches k
    bnd = (c.where(F.col("cum_n") >= k)
           .groupBy(*by)
           .agg(F.max_by(F.struct(score, (F.col("cum_n") - F.col("n")).alias("n_above"),
                                  (F.col("cum_p") - F.col("p")).alias("p_above"),
                                  k.alias("k"), F.col("__n").alias("total"),
                                  F.col("__p").alias("pos"), F.col("n").alias("n_tie")),
                        F.col(score)).alias("b"))
           .select(*by, "b.*").withColumnRenamed(score, "__bscore"))
    ties = d.join(F.broadcast(bnd), by, "inner")   # one row per group
    ties = ties.where(F.col(score) == F.col("__bscore"))
    # the tie group's size is known: a bounded group is ranked by a plain window
    largest_tie = bnd.agg(F.max("n_tie")).first()[0] or 0
    if largest_tie <= TOPK_MAX_ROWS:
        ranked = ties.withColumn("__r", F.row_number().over(
            Window.partitionBy(*by).orderBy(F.col(key))))
    else:
        ranked = global_rank(ties, [F.col(key)], by, partitions, name="__r")
    m_pos = (ranked.where(F.col("__r") <= F.col("k") - F.col("n_above"))
             .groupBy(*by).agg(F.sum("__hit").alias("__mp")))
    res = bnd.join(m_pos, by, "left")
    top_rate = (F.col("p_above") + F.coalesce(F.col("__mp"), F.lit(0.0))) / F.col("k")
    base = F.col("pos") / F.col("total")
    lift = F.when(base > 0, top_rate / base)
    out_by = [] if single else by
    return res.select(*out_by, (round_half_even(lift, digits) if digits is not None else lift)
                      .alias("lift"))
