"""Hand-computed edge rows for the column expressions (null, malformed, quoted)."""

import math

from pyspark.sql import functions as F

from revlens.functions import expr as X


def _one(spark, value, fn, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(fn("v").alias("o")).first()["o"]


def test_hours_parts(spark):
    cases = {"7:0-21:30": (1, 14.5), "18:0-2:0": (1, 8.0), "0:0-0:0": (1, 24.0),
             "bad": (0, 0.0), "": (0, 0.0), None: (0, 0.0), "7:0-21": (0, 0.0),
             " 9:15-17:45 ": (1, 8.5)}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    flag, dur = X.hours_parts("v")
    got = {r["v"]: (r["f"], r["d"]) for r in df.select("v", flag.alias("f"), dur.alias("d")).collect()}
    for k, (f, d) in cases.items():
        assert got[k][0] == f, k
        assert math.isclose(got[k][1], d), k


def test_dict_keys_and_true_keys(spark):
    text = "{'garage': False, u'street': True, 'lot': None}"
    assert sorted(_one(spark, text, X.dict_keys)) == ["garage", "lot", "street"]
    assert _one(spark, text, X.dict_true_keys) == ["street"]
    for bad in ["None", "{bad", None, "{'a': }"]:
        assert _one(spark, bad, X.dict_keys) == []


def test_strip_quotes_and_unknown(spark):
    cases = {"u'quiet'": "quiet", "'quiet'": "quiet", "quiet": "quiet", ' "loud" ': "loud",
             "u'none'": "none"}
    for k, v in cases.items():
        assert _one(spark, k, X.strip_repr_quotes) == v
    assert _one(spark, None, X.strip_repr_quotes) is None
    for k, v in {"None": "Unknown", "nan": "Unknown", None: "Unknown", "none": "none"}.items():
        assert _one(spark, k, X.unknown_level) == v


def test_comma_count_and_items(spark):
    for k, v in {"a,b,c": 3, "": 0, None: 0, "a,": 2}.items():
        assert _one(spark, k, X.comma_count) == v
    assert _one(spark, "Bars, Restaurants, Bars, None, ", X.comma_items) == [
        "Bars", "Restaurants", "Bars"]


def test_user_bucket(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 5, 6, 100, 101, None, -1]], "v int")
    got = [r["b"] for r in df.select(X.user_bucket("v").alias("b")).collect()]
    assert got == ["1", "1", "2-5", "6-20", "21-100", "100+", "Unknown", "Unknown"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (3.0,)], "v double")
    assert [r["c"] for r in df.select(X.clip_lower("v").alias("c")).collect()] == [0, None, 3.0]


def test_weekday_and_season(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-07-07",)], "d string") \
        .select(F.to_date("d").alias("d"))
    rows = df.select(X.weekday0("d").alias("w"), X.season_of_month(F.month("d")).alias("s"),
                     X.weekday_name(X.weekday0("d")).alias("n")).collect()
    assert [(r.w, r.s, r.n) for r in rows] == [(0, "Winter", "Mon"), (6, "Summer", "Sun")]


def test_round_half_even(spark):
    df = spark.createDataFrame([(12.5,), (13.5,), (2.675,)], "v double")
    got = [r["r"] for r in df.select(X.round_half_even(F.col("v") / 10, 1).alias("r")).collect()]
    assert got == [1.2, 1.4, 0.3]


def test_sanitize(spark):
    for k, name in [("Bars & Pubs", "bars_pubs"), ("  Café__Bar ", "café_bar"), ("", "unknown"),
                    ("---", "unknown")]:
        assert _one(spark, k, X.sanitize_name) == name
