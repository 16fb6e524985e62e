"""Connected components of a link table, as Spark joins.

Alternating large-star and small-star steps: each step re-hangs links on the
smallest neighbour, so chains shrink by a factor each round and hubs are never
gathered (only minima per node are).  Each round is written to the shared
folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: root is the smallest
    node that it reaches.  Links may repeat, run either way, or be loops; rows
    with a null end are ignored.  No links, no rows."""
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = materialize(start.filter("u <> v").distinct(), "links")
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
                        .alias("h")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
