"""Source guards: one-column JSON CSV contract, strict / permissive parsing,
incomplete weather feeds, materialize-or-reuse."""

import os
import tempfile

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from revlens.sources import json_text as J
from revlens.sources import weather as W

SCHEMA = StructType([StructField("business_id", StringType()), StructField("stars", LongType()),
                     StructField("attributes", StructType([StructField("WiFi", StringType())]))])


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="revlens-src-")
    p = os.path.join(d, "part.csv")
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_json_csv_scan_flattens(spark):
    path = _write('json\n"{""business_id"": ""b1"", ""stars"": 4, ""attributes"": {""WiFi"": ""u\'free\'""}}"\n'
                  '"{""business_id"": ""b2"", ""stars"": 2}"\n')
    df = J.json_text_scan(spark, path, SCHEMA)
    assert df.columns == ["business_id", "stars", "attributes_WiFi"]
    rows = {r.business_id: r for r in df.collect()}
    assert rows["b1"].attributes_WiFi == "u'free'" and rows["b2"].attributes_WiFi is None


def test_json_csv_rejects_two_columns(spark):
    path = _write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        J.read_json_csv(spark, path)


def test_json_strict_fails_and_permissive_counts(spark):
    path = _write('json\n"{""business_id"": ""b1""}"\n"{not json"\n')
    with pytest.raises(Exception):
        J.json_text_scan(spark, path, SCHEMA, strict=True).collect()
    loose = J.json_text_scan(spark, path, SCHEMA, strict=False)
    assert J.count_corrupt(loose) == 1


def test_feed_completeness_raises(spark):
    loaded = spark.createDataFrame([("Reno", "NV")], "city string, state string")
    expected = spark.createDataFrame([("Reno", "NV"), ("Tampa", "FL")], "city string, state string")
    assert [tuple(r) for r in W.feed_completeness(loaded, expected).collect()] == [("Tampa", "FL")]
    with pytest.raises(RuntimeError):
        W.feed_completeness(loaded, expected, raise_on_missing=True)


def test_materialize_or_reuse(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="revlens-mat-"), "w")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1,)], "x int")

    assert W.materialize_or_reuse(spark, path, build).count() == 1
    assert W.materialize_or_reuse(spark, path, build).count() == 1
    assert len(calls) == 1
    W.materialize_or_reuse(spark, path, build, refresh=True)
    assert len(calls) == 2
