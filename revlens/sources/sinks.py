"""Writers for the enriched dataset and the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_dataset(df: DataFrame, path: str, partition_by: str | None = "review_year",
                  mode: str = "overwrite") -> None:
    """Persist the enriched review table as Parquet, partitioned by year so
    year filters prune whole folders."""
    writer = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """CSV files with a header, or Parquet; as many files as the result has partitions
    (AQE makes a small result one)."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    else:
        df.write.mode(mode).parquet(path)
