"""Parquet table access.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so callers never pre-select columns by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_fact_scan(df: DataFrame) -> DataFrame:
    """A fact file stored as one row group scans as one partition, so every
    narrow stage after it (joins with broadcast dimensions, cleaning, the
    write) would run in one task.  When the scan has fewer partitions than
    half the cores it is rebalanced once (round-robin); on a real fact with
    thousands of splits this is a no-op.  Filters and column pruning are
    still pushed below the repartition."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < max(2, cores // 2):
        return df.repartition(cores)
    return df


class Tables:
    """Attribute access to the tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
