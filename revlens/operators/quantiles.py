"""Exact quantiles without holding a column in one task.

``percentile`` keeps a value -> count map per group, merged in one task: for
a high-cardinality column over a whole table that map is the column.  Here
the columns are unpivoted to (variable, value), collapsed to one row per
distinct value (partial aggregation), and cumulated in two levels
(:func:`revlens.operators.ranking.cumulative`).  The k-th smallest value is the
first distinct value whose cumulative count exceeds k, so each requested
quantile is one conditional ``min`` -- linear interpolation between the two
neighbouring order statistics, like pandas / ``quantile_cont``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from revlens.operators.ranking import cumulative


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    partitions: int | None = None) -> DataFrame:
    """(variable, q<i> ...) with the exact linear-interpolated quantiles;
    NULL for a column without values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("double").alias("value")) for c in cols]))
    long = df.select(pairs.alias("p")).select("p.variable", "p.value") \
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    hist = long.groupBy("variable", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    cum = cumulative(hist, ["value"], ["n"], ["variable"], partitions)
    totals = hist.groupBy("variable").agg(F.sum("n").alias("total"))
    # one row per column: bounded by the schema, so broadcast
    c = cum.join(F.broadcast(totals), "variable", "inner")
    aggs = []
    for i, q in enumerate(probs):
        pos = (F.col("total") - 1) * q
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.min(F.when(F.col("cum_n") > lo, F.col("value"))).alias(f"__lo{i}"),
                 F.min(F.when(F.col("cum_n") > hi, F.col("value"))).alias(f"__hi{i}"),
                 F.first(pos - lo).alias(f"__w{i}")]
    agg = c.groupBy("variable").agg(*aggs)
    out = [F.col("variable")]
    for i, _ in enumerate(probs):
        lo, hi, w = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__w{i}")
        out.append(F.when(w == 0, lo).otherwise(lo + w * (hi - lo)).alias(f"q{i}"))
    res = agg.select(*out)
    # columns without any value still get a row
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return names.join(res, "variable", "left")


def exact_quantile_map(df: DataFrame, cols: list[str], q: float) -> dict[str, float | None]:
    """{column: quantile} on the driver (one number per column)."""
    got = quantiles_checked(df, cols, [q])
    out = {c: got.get(c, [None])[0] for c in cols}
    return {c: (None if v is None or math.isnan(v) else v) for c, v in out.items()}


# ``percentile`` holds one map entry per distinct value; below this many
# distinct values (estimated, with margin) that map is small enough.
MAX_MAP_VALUES = 1_000_000


def quantiles_checked(df: DataFrame, cols: list[str], probs: list[float],
                      max_distinct: int = MAX_MAP_VALUES,
                      partitions: int | None = None) -> dict[str, list[float | None]]:
    """Exact quantiles per column, choosing the plan by a measured bound.

    One scan estimates the distinct count of every column
    (``approx_count_distinct``, 5 % error).  Columns safely below
    ``max_distinct`` get ``percentile`` in one more scan; the others go
    through :func:`exact_quantiles`.  Only len(cols) x len(probs) numbers
    reach the driver.
    """
    if not cols:
        return {}
    est = df.agg(*[F.approx_count_distinct(F.col(c), 0.05).alias(c) for c in cols]).first()
    small = [c for c in cols if est[c] <= 0.8 * max_distinct]
    big = [c for c in cols if c not in small]
    out: dict[str, list[float | None]] = {}
    if small:
        arr = F.array(*[F.lit(float(q)) for q in probs])
        row = df.agg(*[F.percentile(F.col(c).cast("double"), arr).alias(c) for c in small]).first()
        for c in small:
            out[c] = list(row[c]) if row[c] is not None else [None] * len(probs)
    if big:
        for r in exact_quantiles(df, big, probs, partitions).collect():
            out[r["variable"]] = [r[f"q{i}"] for i in range(len(probs))]
    return out
