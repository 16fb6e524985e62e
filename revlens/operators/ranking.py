"""Distributed ordered prefix sums and ranks.

A global ``Window.orderBy`` (or one partitioned only by a 2-valued class)
sends every row to one task.  ``cumulative`` computes running sums in two
levels instead:

1. range-partition by (group keys, order key) and sort inside partitions, so
   every partition holds a contiguous key range; one Arrow pass adds the running
   sums inside the partition, and the result is written to the shared folder;
2. one aggregate gives per-(partition, group) totals; their exclusive prefix per
   group is the offset of the groups that began in an earlier partition;
3. the offsets (at most one row per partition) are joined to the rows.

Every task sees one range of rows, and no rows reach the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from revlens.session import materialize


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def cumulative(df: DataFrame, order: list[Column | str], sums: list[str], by: list[str] = (),
               partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum of ``c`` in ``order`` within ``by``.

    ``order`` should be a total order (break ties with a key) when row-level
    ranks are wanted; ties in ``order`` otherwise land in an arbitrary but
    consistent order.
    """
    by = list(by)
    okeys = [F.col(o) if isinstance(o, str) else o for o in order]
    n = _partitions(df, partitions)
    ranged = (df.repartitionByRange(n, *[F.col(b) for b in by], *okeys)
              .sortWithinPartitions(*[F.col(b) for b in by], *okeys)
              .withColumn("__pid", F.spark_partition_id()))
    places = [ranged.columns.index(b) for b in by]
    numbers = [ranged.columns.index(c) for c in sums]
    schema = StructType([*ranged.schema.fields, *[StructField(f"{prefix}{c}", DoubleType()) for c in sums]])

    def run(batches):
        held, carry = None, None        # the last row's group and its running sums
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = group_runs(batch, places)
            values = pd.DataFrame({k: batch.column(at).cast(pa.float64()).to_numpy(zero_copy_only=False)
                                   for k, at in enumerate(numbers)}).fillna(0.0)
            local = values.groupby(codes, sort=False).cumsum().to_numpy()
            if held == _group(batch, places, 0):
                local[codes == 0] += carry
            held, carry = _group(batch, places, batch.num_rows - 1), local[-1].copy()
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in local.T]], names=schema.names)

    # the range-partition index is stored in the rows: the tasks that read them are others
    local = materialize(ranged.mapInArrow(run, schema), "running-sums")
    totals = local.groupBy("__pid", *by).agg(*[F.sum(F.col(c).cast("double")).alias(f"__cum_total{k}") for k, c in enumerate(sums)])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # only a partition's first group can have begun in an earlier one: a row per partition at most
    offsets = materialize(totals.select(
        F.col("__pid").alias("__cum_pid"), *[F.col(b).alias(f"__cum_group{k}") for k, b in enumerate(by)],
        F.count(F.lit(1)).over(before).alias("__cum_before"),
        *[F.coalesce(F.sum(f"__cum_total{k}").over(before), F.lit(0.0)).alias(f"__cum_offset{k}") for k in range(len(sums))])
        .where("__cum_before > 0"), "running-offsets")
    same = F.col("__pid") == F.col("__cum_pid")
    for k, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__cum_group{k}"))
    return local.join(F.broadcast(offsets), same, "left").select(
        *df.columns, *[(F.col(f"{prefix}{c}") + F.coalesce(F.col(f"__cum_offset{k}"), F.lit(0.0))).alias(f"{prefix}{c}")
                       for k, c in enumerate(sums)])


def group_runs(batch: pa.RecordBatch, places: list[int]) -> np.ndarray:
    """The number of each row's run of equal values in the columns at ``places``, from 0."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for at in places:
        code = batch.column(at).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new)


def _group(batch: pa.RecordBatch, places: list[int], row: int) -> tuple:
    return tuple(repr(batch.column(at)[row].as_py()) for at in places)


def global_rank(df: DataFrame, order: list[Column | str], by: list[str] = (),
                partitions: int | None = None, name: str = "rank") -> DataFrame:
    """1-based position in ``order`` within ``by`` (row_number semantics)."""
    with_one = df.withColumn("__one", F.lit(1).cast("long"))
    ranked = cumulative(with_one, order, ["__one"], by, partitions, prefix="__cum")
    return ranked.withColumn(name, F.col("__cum__one").cast("long")).drop("__one", "__cum__one")


def average_rank(df: DataFrame, value: str, name: str = "avg_rank",
                 partitions: int | None = None) -> DataFrame:
    """Rank with ties averaged (pandas ``rank()``): distinct values are counted,
    cumulated in two levels, and joined back (one row per distinct value)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).cast("double").alias("__n"))
    cum = cumulative(counts, [value], ["__n"], partitions=partitions)
    ranks = cum.select(value, (F.col("cum___n") - F.col("__n") + (F.col("__n") + 1) / 2)
                       .alias(name))
    return df.join(ranks, value, "left")


def _value_ranks(counts: DataFrame, value: str, name: str, partitions) -> DataFrame:
    """Average rank of each distinct value, from (value, n) rows."""
    totals = counts.groupBy(value).agg(F.sum("n").alias("__n"))
    cum = cumulative(totals, [value], ["__n"], partitions=partitions)
    return cum.select(value, (F.col("cum___n") - F.col("__n") + (F.col("__n") + 1) / 2).alias(name))


def spearman(df: DataFrame, x: str, y: str, partitions: int | None = None) -> DataFrame:
    """Spearman rank correlation = Pearson correlation of average ranks
    (rows with a NULL in either column are dropped first).

    Rows collapse to one per distinct (x, y) pair first, so a frequent value
    is one row per distinct partner value; the ranks are joined to those
    pairs and the correlation weights them by their number of rows."""
    pairs = (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
             .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
             .agg(F.count(F.lit(1)).cast("double").alias("n")))
    ranked = (pairs.join(_value_ranks(pairs, "x", "rx", partitions), "x")
              .join(_value_ranks(pairs, "y", "ry", partitions), "y"))
    mean_rank = (pairs.agg(F.sum("n")).scalar() + 1) / 2       # of either column
    dx, dy = F.col("rx") - mean_rank, F.col("ry") - mean_rank
    sums = ranked.select((F.col("n") * dx * dy).alias("xy"), (F.col("n") * dx * dx).alias("xx"),
                         (F.col("n") * dy * dy).alias("yy")).agg(
        F.sum("xy").alias("xy"), F.sum("xx").alias("xx"), F.sum("yy").alias("yy"))
    varies = (F.col("xx") > 0) & (F.col("yy") > 0)
    return sums.select(F.when(varies, F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
                       .alias("spearman"))


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key by ascending ``order`` (a keep-first de-duplication).

    Written as ``min_by`` over a struct, an ordinary aggregate: partial
    aggregation runs map-side, so a key holding a third of the rows still
    costs one small row per task, unlike a key-partitioned window.
    """
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(best.alias("__b")).select(key, *[F.col(f"__b.{c}").alias(c)
                                                               for c in rest])


# Up to this many rows a top-k is Spark's TakeOrderedAndProject: each task
# keeps its own k best and one task merges k x tasks rows.  Beyond it the
# merge would be too large for one task, so the distributed rank is used.
TOPK_MAX_ROWS = 100_000


def top_k(df: DataFrame, order: list[Column | str], k: int,
          partitions: int | None = None) -> DataFrame:
    """First k rows in ``order`` (a total order)."""
    if k <= TOPK_MAX_ROWS:
        return df.orderBy(*order).limit(k)
    ranked = global_rank(df, order, partitions=partitions, name="__r")
    return ranked.where(F.col("__r") <= k).drop("__r")


def lift_topk(df: DataFrame, score: str, k: int, key: str,
              partitions: int | None = None) -> DataFrame:
    """The k highest scores, ties broken by ``key``."""
    return top_k(df, [F.col(score).desc(), F.col(key)], k, partitions)

