"""Located rows met with places: as a plain join would, without a shuffle of the texts."""

import pytest
from pyspark.sql import functions as F

from revlens.llm import exact_stream, near_omh
from revlens.llm.common import BLOCK_ROWS, MAP_BYTES, by_place, with_locator
from tests.llm.helpers import SCHEMA, prose, row


@pytest.fixture
def no_small_tables(spark):
    """Joins are planned as for tables that are too large to broadcast unasked."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def stored(spark, path, data):
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("map_bytes", [MAP_BYTES, 0])
def test_places_select_what_a_join_selects(spark, tmp_path, map_bytes):
    n = 2 * BLOCK_ROWS + 100
    path = str(tmp_path / "rows")
    spark.range(n).selectExpr("id", "id AS block", "'x' AS bits", "id AS last").coalesce(1).write.parquet(path)
    spark.range(n, n + 50).selectExpr("id", "id AS block", "'x' AS bits", "id AS last").coalesce(1).write.mode(
        "append").parquet(path)
    located = with_locator(spark.read.parquet(path))
    wanted = [0, 1, 7, 8, BLOCK_ROWS - 1, BLOCK_ROWS, 2 * BLOCK_ROWS - 1, 2 * BLOCK_ROWS, n - 1, n, n + 3, n + 49]
    places = located.filter(F.col("id").isin(wanted)).select("__file", "__row")
    places = places.unionByName(places).unionByName(  # repeated, and in no row or file
        spark.createDataFrame([("nowhere", 3)], "__file string, __row bigint"))
    held = by_place(located, places, "left_semi", map_bytes)
    assert held.columns == located.columns
    assert sorted(r["id"] for r in held.collect()) == wanted
    rest = by_place(located, places, "left_anti", map_bytes).select("id").collect()
    assert sorted(r["id"] for r in rest) == sorted(set(range(n + 50)) - set(wanted))
    assert by_place(located, places.limit(0), "left_semi", map_bytes).count() == 0
    assert by_place(located, places.limit(0), "left_anti", map_bytes).count() == n + 50


def test_dropped_documents_shuffle_no_texts(spark, tmp_path, no_small_tables, capsys):
    data = [row(i, prose(i % 30, 60)) for i in range(90)]
    docs = stored(spark, tmp_path / "docs", data)
    for drop in (exact_stream.drop_copies, near_omh.drop_near_copies):
        left = drop(docs)
        found = plan(left, capsys)
        assert "Exchange hash" not in found and "SortMergeJoin" not in found, found
        assert len({r["text"] for r in left.collect()}) == left.count() == 30


def test_only_texts_of_candidates_and_hits_are_shuffled(spark, tmp_path, no_small_tables, monkeypatch):
    data = [row(i, prose(i, 60)) for i in range(40)] + [row(100, prose(7, 60)), row(101, prose(8, 59) + " end")]
    docs, seen = stored(spark, tmp_path / "docs", data), {}
    for module in (exact_stream, near_omh):
        def kept(rows, places, how, name=module.__name__):
            out = by_place(rows, places, how)
            if how == "left_semi":
                seen[name] = sorted(r["doc_id"] for r in out.collect())
            return out
        monkeypatch.setattr(module, "by_place", kept)
    assert exact_stream.dedup(docs).rows.filter("kept").count() == 41
    assert near_omh.classes(docs).rows.filter("kept").count() == 40
    assert seen[exact_stream.__name__] == [7, 100]
    assert set(seen[near_omh.__name__]) == {8, 101}
