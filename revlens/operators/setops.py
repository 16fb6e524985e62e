"""Set operations: stacking tables and comparing two rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from revlens.operators.ranking import top_k


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_keys(ranking: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Keys of the k largest values (ties by key)."""
    return top_k(ranking.select(key, value), [F.col(value).desc(), F.col(key)], k).select(key)


def overlap_and_difference(a: DataFrame, b: DataFrame, key: str, value: str,
                           k: int = 10) -> DataFrame:
    """Top-k keys of two rankings labelled 'both', 'only_a' or 'only_b'."""
    ta, tb = top_keys(a, key, value, k), top_keys(b, key, value, k)
    both = ta.intersect(tb).withColumn("membership", F.lit("both"))
    only_a = ta.exceptAll(tb).withColumn("membership", F.lit("only_a"))
    only_b = tb.exceptAll(ta).withColumn("membership", F.lit("only_b"))
    return union_all([both, only_a, only_b])
