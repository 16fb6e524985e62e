"""Streaming exact dedup against grouping by text."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from revlens.llm import exact_stream
from tests.llm.helpers import HARD, SCHEMA, hard, nothing, row, rows


def expected(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        out += [(i, top, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def result(df):
    got = rows(df)
    return got, sorted(repr((g["doc_id"], g["keep_id"], g["group_size"], g["digest"])) for g in got)


def test_hard_cases(spark):
    got, flat = result(exact_stream.dedup(hard(spark)).rows)
    assert flat == sorted(map(repr, expected(HARD)))
    kept = [g for g in got if g["kept"]]
    assert len(kept) == len({r[1] or "" for r in HARD})  # one row of each text, of repeated rows too
    assert all(g["doc_id"] == g["keep_id"] for g in kept)


def test_drop_copies_keeps_rows_and_columns(spark):
    got = exact_stream.drop_copies(hard(spark))
    assert got.columns == SCHEMA.names
    assert sorted(r["text"] or "" for r in got.collect()) == sorted({r[1] or "" for r in HARD})


def test_empty_table(spark):
    assert exact_stream.dedup(nothing(spark)).rows.collect() == []
    assert exact_stream.drop_copies(nothing(spark)).collect() == []


def test_hot_group_and_equal_digests_of_different_bytes(spark, monkeypatch):
    data = [row(i, "copy") for i in range(300)] + [row(1000 + i, f"t{i % 40}") for i in range(80)]
    docs = spark.createDataFrame(data, SCHEMA)
    assert result(exact_stream.dedup(docs).rows)[1] == sorted(map(repr, expected(data)))
    # all texts of equal length share a digest now: the byte check must tell them apart
    monkeypatch.setattr(exact_stream.F, "sha2", lambda col, bits: F.lit("same"))
    got = rows(exact_stream.dedup(docs).rows)
    flat = sorted((g["doc_id"], g["keep_id"], g["group_size"]) for g in got)
    assert flat == sorted(e[:3] for e in expected(data))


def test_state_goes_on_with_later_files(spark, tmp_path):
    schema = "digest string, n_bytes bigint, doc_id bigint, __file string, __row bigint"
    feed, state = str(tmp_path / "feed"), str(tmp_path / "state")
    for part in ([("a", 1, 1, "f", 0), ("b", 1, 2, "f", 1)], [("a", 1, 9, "g", 0)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(feed)
        exact_stream.run_state(spark.readStream.schema(schema).parquet(feed), state)
    got = {r["digest"]: (r["copies"], r["keeper"]["doc_id"]) for r in exact_stream.read_state(spark, state).collect()}
    assert got == {"a": (2, 9), "b": (1, 2)}
