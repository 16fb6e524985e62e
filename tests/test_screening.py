"""Candidate screen, pair-drop rule, VIF reduction and quota invariants."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from revlens.operators import enrich as E
from revlens.operators import sampling as SP
from revlens.operators import screen as SC


def _frame(spark):
    rows = [(i, float(i % 7), float((i * 3) % 11), float(i % 7), 1.0, None, i % 2,
             float(i % 5)) for i in range(200)]
    return spark.createDataFrame(rows, "user_id long, a double, b double, a_copy double, "
                                       "const double, all_null double, flag int, c double")


def test_candidate_screen_reasons(spark):
    df = _frame(spark)
    cont, binary, audit = SC.candidate_screen(df)
    reasons = {r.variable: r.reason for r in audit.collect()}
    assert "identifier" in reasons["user_id"]
    assert "constant" in reasons["const"] and "all values missing" in reasons["all_null"]
    assert binary == ["flag"] and set(cont) == {"a", "b", "a_copy", "c"}


def test_pair_drop_and_vif_reduce(spark):
    df = _frame(spark)
    kept, audit = SC.screening_workflow(df, ["a", "b", "a_copy", "c"], threshold=0.8)
    rows = {r.variable: r for r in audit.collect()}
    # exact duplicates: same score, the larger name is dropped
    assert "a_copy" in rows and rows["a_copy"].correlated_with == "a"
    assert rows["a_copy"].vif == float("inf")
    assert "a_copy" not in kept and "a" in kept


def test_drop_score_rules(spark):
    names = ["weather_tmin", "weather_tmax", "photo_food", "photo_count", "log_x", "a_ratio", "is_x", "x"]
    assert SC.drop_scores(spark, names) == dict(zip(names, [90, 0, 80, 0, 70, 65, 55, 50]))
    pairs = spark.createDataFrame([("weather_tmin", "weather_tmax", 0.9), ("photo_food", "photo_count", 0.9),
                                   ("x_b", "x_a", 0.9)], "feature_1 string, feature_2 string, correlation double")
    assert {(r["drop"], r["keep"]) for r in SC.judged_pairs(pairs).collect()} == {
        ("weather_tmin", "weather_tmax"), ("photo_food", "photo_count"), ("x_b", "x_a")}


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 2.0, 2.5, 40000), (3, None, 1.0, -5)],
                               "a bigint, b double, c double, d int")
    out = dict(E.narrow_types(df).dtypes)
    assert out["a"] == "tinyint" and out["b"] == "double" and out["c"] == "double"
    assert out["d"] == "int"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from(list("abcde")), st.integers(0, 1000), min_size=1),
       st.integers(0, 5000))
def test_quota_invariants(counts, n):
    total = sum(counts.values())
    n = min(n, total)
    q = SP.quotas(counts, n)
    assert sum(q.values()) == n
    for k, c in counts.items():
        assert 0 <= q[k] <= c or total == 0
        if total:
            assert abs(q[k] - n * c / total) < 1.0 + 1e-9
