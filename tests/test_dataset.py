"""Which columns and rows of the enriched dataset travel and are written."""

import datetime as dt

import pytest

from revlens.catalog import flow, io, modelling
from revlens.plans import dataset as D

DAY = dt.datetime(1999, 5, 6)


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables with repeated, missing and unmatched keys."""
    made = {
        "region": ([(0, "AFRICA"), (1, "AMERICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "NATION_0", 0), (1, "NATION_1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"c{k}", k % 2, 100.0 * k) for k in (1, 2, 3, 3)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "part": ([(k, f"red box {k}", "Brand#1", "SMALL TIN", k) for k in (1, 2, 2, 5)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": ([(k, k % 4 + 1, "F", 1500.0 * k, DAY, f"{k % 5 + 1}-X") for k in range(1, 13)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                   "o_orderpriority string"),
        "lineitem": ([(k % 12 + 1, None if k % 9 == 0 else k % 4, k, k % 7 + 1, float(k), 10.0 * k, 0.05, 0.02, "R", "F", DAY)
                      for k in range(40)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz"),
        "events": ([(k, k % 4, ["view", "click", "error"][k % 3], float(k), DAY) for k in range(30)],
                   "event_id long, user_id long, event_type string, value double, ts timestamp_ntz"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    D.forget()
    yield str(tmp_path)
    D.forget()


@pytest.mark.parametrize("query", [
    flow.q_scope_summary, flow.q_scope_summary_by_year, flow.q_attach_lookup, flow.q_clean_values, flow.q_anti_join_missing,
    flow.q_scope_join, flow.q_select_model_columns, flow.q_market_topn, io.q_write_dataset, modelling.q_log_and_replace])
def test_a_query_that_reads_once_does_not_write_the_dataset(spark, tables, monkeypatch, query):
    whole = D.load(spark, tables)
    D.forget()
    with monkeypatch.context() as m:
        m.setattr(D, "materialize", lambda *a: pytest.fail("the dataset is written"))
        got = sorted(map(str, query(spark, tables).collect()))
    monkeypatch.setattr(D, "load", lambda *a, **kw: whole)
    assert got == sorted(map(str, query(spark, tables).collect()))
