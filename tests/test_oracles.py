"""Every registered job with an oracle agrees with DuckDB on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from revlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:  # noqa: BLE001
        pass
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "satisfaction_rate_percent" in df.columns


ORACLE_NAMES = sorted(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


# parts of a search come before the search of all of them, which reuses their results
OTHER_NAMES = sorted(set(entry.queries()) - set(ORACLE_NAMES), key=lambda n: (n == "grid_search", n))


@pytest.mark.parametrize("name", OTHER_NAMES)
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.schema is not None
    df.limit(5).collect()
