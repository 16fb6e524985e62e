"""Registry of runnable jobs on the fixture tables.

Each entry maps a job id (SURVEY section 2) to a callable ``(spark, sf_dir) ->
DataFrame`` and, when the job is SQL-expressible, the DuckDB oracle SQL over
the same parquet views.  ``__spark_entry__`` only re-exports this registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # imported for their registrations
    from revlens.catalog import flow, tables  # noqa: F401
    for optional in ("screening", "evaluation", "modelling", "io"):
        try:
            __import__(f"revlens.catalog.{optional}")
        except ModuleNotFoundError as exc:  # pragma: no cover - partial checkouts
            if exc.name != f"revlens.catalog.{optional}":
                raise
