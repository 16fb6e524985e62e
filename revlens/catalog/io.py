"""Queries for the file-based sources and sinks, and the ordering jobs.

The file jobs write Spark-derived data into a fresh folder under the shared
``spark.checkpoint.dir`` and read it back, so the scan and the sink are both
exercised on data that grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from revlens import fixtures as FX
from revlens.catalog import register
from revlens.functions.expr import order_index
from revlens.operators import enrich as E
from revlens.plans import dataset as D
from revlens.session import ensure_checkpoint_dir
from revlens.sources import json_text as J
from revlens.sources import sinks as SK
from revlens.sources import weather as W
from revlens.sources.tables import Tables


def _scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/revlens-io/{name}-{uuid.uuid4().hex[:12]}"


EXPORTS = {
    "customer": StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                            StructField("c_nationkey", IntegerType()),
                            StructField("c_acctbal", DoubleType()),
                            StructField("c_mktsegment", StringType())]),
    "supplier": StructType([StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
                            StructField("s_nationkey", IntegerType()),
                            StructField("s_acctbal", DoubleType())]),
    "part": StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()),
                        StructField("p_brand", StringType()), StructField("p_type", StringType()),
                        StructField("p_size", IntegerType()),
                        StructField("p_retailprice", DoubleType())]),
}


@register("load_tables", """
    SELECT 'customer' AS "table", count(*) AS rows, 5 AS columns FROM customer
    UNION ALL SELECT 'supplier', count(*), 4 FROM supplier
    UNION ALL SELECT 'part', count(*), 6 FROM part""")
def q_load_tables(spark, sf):
    t = Tables(spark, sf)
    paths = {}
    for name in EXPORTS:
        path = _scratch(spark, f"export-{name}")
        src = getattr(t, name).select(F.to_json(F.struct("*")).alias("json"))
        src.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        paths[name] = path
    _, report = J.load_tables(spark, paths, EXPORTS)
    return report.select("table", F.col("rows").cast("long"), F.col("columns").cast("int"))


@register("materialize_or_reuse", D.fact_sql("SELECT * FROM rv_weather"))
def q_materialize_or_reuse(spark, sf):
    path = _scratch(spark, "weather")
    t = Tables(spark, sf)
    W.materialize_or_reuse(spark, path, lambda: D.clean_weather(t))          # builds and writes
    return W.materialize_or_reuse(spark, path, lambda: D.clean_weather(t))   # reuses


@register("write_dataset", D.fact_sql(
    "SELECT business_id, user_id, review_year, satisfied, city, weather_prcp FROM rv_fact"))
def q_write_dataset(spark, sf):
    path = _scratch(spark, "dataset")
    SK.write_dataset(D.load(spark, sf, reuse=False).select("business_id", "user_id", "review_year",
                                                          "satisfied", "city", "weather_prcp"), path)
    return spark.read.parquet(path).select("business_id", "user_id",
                                           F.col("review_year").cast("int").alias("review_year"),
                                           "satisfied", "city", "weather_prcp")


@register("write_result", D.fact_sql(
    "SELECT city, count(*) AS reviews FROM rv_fact GROUP BY city"))
def q_write_result(spark, sf):
    path = _scratch(spark, "result")
    res = E.scope_summary(D.load(spark, sf, reuse=False), keys=("city",))
    SK.write_result(res, path, fmt="csv")
    return spark.read.schema("city string, reviews long").option("header", True).csv(path)


# ---------------------------------------------------------------------------
# Ordering jobs (the order is part of the result; the compare is set-based,
# so the ordinal/rank is also returned as a column)
# ---------------------------------------------------------------------------

@register("topn_then_resort", D.fact_sql(
    "SELECT market, reviews, CAST(row_number() OVER (ORDER BY market) AS INTEGER) AS position FROM ("
    "SELECT " + D.sql_trim("coalesce(city, 'Unknown')") + " || ', ' || "
    + D.sql_trim("coalesce(state, 'Unknown')") + " AS market, count(*) AS reviews "
    "FROM rv_fact GROUP BY 1 ORDER BY reviews DESC, market LIMIT 10)"))
def q_topn_then_resort(spark, sf):
    top = E.market_topn(D.load(spark, sf, reuse=False), top_n=10, min_year=None)
    rows = top.orderBy("market").collect()          # at most top_n rows: a report
    return spark.createDataFrame([(r["market"], r["reviews"], i + 1) for i, r in enumerate(rows)],
                                 "market string, reviews long, position int")


@register("nlargest", """
    SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10""")
def q_nlargest(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc(),
                                                      "c_custkey").limit(10)


SEGMENT_ORDER = ["MACHINERY", "HOUSEHOLD", "FURNITURE", "BUILDING", "AUTOMOBILE"]


@register("sort_by_custom_order", """
    SELECT c_mktsegment, count(*) AS customers,
           CAST(list_position(['MACHINERY', 'HOUSEHOLD', 'FURNITURE', 'BUILDING', 'AUTOMOBILE'],
                              c_mktsegment) AS BIGINT) AS ordinal
    FROM customer GROUP BY c_mktsegment ORDER BY ordinal""")
def q_sort_by_custom_order(spark, sf):
    c = Tables(spark, sf).customer
    g = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    return g.withColumn("ordinal", order_index("c_mktsegment", SEGMENT_ORDER)).orderBy("ordinal")


@register("ordered_output", FX.sql_with(
    "SELECT city, state, review_date, station FROM rv_weather ORDER BY city, state, review_date",
    "rv_weather_raw", extra=dict(D.WEATHER_SQL)))
def q_ordered_output(spark, sf):
    w = D.clean_weather(Tables(spark, sf))
    return w.select("city", "state", "review_date", "station").orderBy("city", "state",
                                                                        "review_date")
