"""Hard cases: NULL labels and groups, repeated keys, ties, malformed records, codes of unseen levels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import ranking as RK
from revlens.operators import sampling as SP
from revlens.operators.knn import knn_scores
from revlens.plans import blocks as BL
from revlens.plans import models as MD
from revlens.sources import json_text as J


def _labelled(spark):
    rows = [(i, None if i % 7 == 0 else i % 2) for i in range(300)]
    return spark.createDataFrame(rows, "k long, y int")


def test_null_labels_are_a_class(spark):
    df = _labelled(spark)
    counts = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    want = SP.quotas(counts, 100)
    got = {r["y"]: r["count"] for r in SP.stratified_sample(df, "y", 100, ["k"]).groupBy("y").count().collect()}
    assert got == want
    split = {(r["y"], r["is_test"]): r["count"]
             for r in SP.stratified_split(df, "y", ["k"]).groupBy("y", "is_test").count().collect()}
    assert {y: split[y, 1] for y in counts} == SP.quotas(counts, 60)
    folds = SP.stratified_folds(df, "y", ["k"]).groupBy("y", "fold").count().collect()
    assert len(folds) == 9 and all(abs(r["count"] - counts[r["y"]] / 3) < 1 for r in folds)


def test_null_groups_keep_their_running_sums(spark):
    rows = [(None if i % 3 == 0 else i % 3, i, 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, o long, v double").repartition(5)
    out = RK.cumulative(df, ["o"], ["v"], ["g"], partitions=7)
    got = {r["g"]: (r["m"], r["n"]) for r in out.groupBy("g").agg(
        F.max("cum_v").alias("m"), F.count_distinct("cum_v").alias("n")).collect()}
    assert got == {None: (200.0, 200), 1: (200.0, 200), 2: (200.0, 200)}


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(i // 50,) for i in range(1000)], "k long")
    with pytest.raises(ValueError, match="repeats"):
        SP.sample_n(df, 101, ["k"])


def test_knn_ties_are_broken_by_id_across_chunks(spark):
    train = spark.createDataFrame([(i, [1.0, 0.0], int(i < 3)) for i in range(50)],
                                  "tid long, vec array<double>, label int")
    query = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "qid long, vec array<double>")
    for chunk in (7, 1000):
        got = {r["qid"]: r["score"] for r in knn_scores(train, query, k=3, chunk_rows=chunk).collect()}
        assert got == {1: 1.0, 2: 1.0}
    assert knn_scores(train.limit(0), query, k=3).collect() == []


def test_strict_load_fails_on_a_malformed_record(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    inner = StructType([StructField("x", StructType([StructField("y", StringType())]))])
    schema = StructType([StructField("a", LongType()), StructField("deep", inner)])
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('json\n"{""a"": 1, ""deep"": {""x"": {""y"": ""z""}}}"\n"{""a"": 2}"\n')
    bad.write_text('json\n"{""a"": 1}"\n"{not json"\n')
    tables, report = J.load_tables(spark, {"t": str(good)}, {"t": schema})
    assert tables["t"].columns == ["a", "deep_x_y"] and tables["t"].first()["deep_x_y"] == "z"
    assert [(r["rows"], r["columns"]) for r in report.collect()] == [(2, 2)]
    with pytest.raises(Exception):
        J.load_tables(spark, {"t": str(bad)}, {"t": schema})[1].select("table", "rows").collect()


def test_ordinal_codes_of_unseen_and_missing(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    rows = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    got = [r["c__ord"] for r in MD.OrdinalCoder(["c"]).fit(train).transform(rows).collect()]
    assert got == [0.0, 1.0, -1.0, -1.0]


def test_every_feature_needs_a_block(spark):
    assert BL.grouped_features(spark, ["state", "weather_x", "is_hot"]) == {
        "location": ["state"], "external (weather)": ["weather_x", "is_hot"]}
    with pytest.raises(ValueError, match="amount"):
        BL.grouped_features(spark, ["state", "amount"])


def test_permutation_keeps_values_and_rows(spark):
    from revlens.plans.evaluate import permuted_copies
    df = spark.createDataFrame([(i, float(i), str(i % 3)) for i in range(200)], "id long, a double, b string")
    out = permuted_copies(df, ["a", "b"], 2).toPandas()
    assert len(out) == 800
    for (f, _), g in out.groupby(["feature", "repeat"]):
        assert sorted(g["id"]) == list(range(200)) and sorted(g["a"]) == list(map(float, range(200)))
        moved = (g["a"] != g["id"]).sum() if f == "a" else (g["b"] != (g["id"] % 3).astype(str)).sum()
        still = (g["b"] != (g["id"] % 3).astype(str)).sum() if f == "a" else (g["a"] != g["id"]).sum()
        assert moved > 60 and still == 0


def test_a_whole_column_is_permuted(spark):
    from revlens.plans.evaluate import bijection, permuted_copies
    for n in (1, 2, 3, 64, 65, 1000, 4097):
        for key in ([1], [2, 3]):
            assert sorted(bijection(np.arange(n), n, key)) == list(range(n))
    # ordered values in many partitions: shuffles inside partitions would keep them near their place
    df = spark.range(3000).selectExpr("id", "double(id) as a", "string(id % 7) as b", "cast(id as int) as c").repartition(9)
    out = permuted_copies(df, ["a", "b", "c"], 2).toPandas()
    assert len(out) == 3000 * 6
    for (f, r), g in out.groupby(["feature", "repeat"]):
        own = {"a": g["id"].astype(float), "b": (g["id"] % 7).astype(str), "c": g["id"]}
        for c in "abc":
            assert sorted(g[c]) == sorted(own[c]) and (g[c] != own[c]).any() == (c == f)
        if f != "b":
            assert abs(np.corrcoef(g[f].astype(float), g["id"])[0, 1]) < 0.08
    first, second = (out[(out.feature == "a") & (out.repeat == r)].sort_values("id")["a"].to_numpy() for r in (0, 1))
    assert (first != second).mean() > 0.9


def test_importance_finds_the_informative_feature(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from revlens.plans.evaluate import permutation_importance
    rng = np.random.default_rng(0)
    data = [(i, float(a), float(b), int(a > 0)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    df = spark.createDataFrame(data, "id long, a double, b double, satisfied int")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                            LogisticRegression(labelCol="satisfied")]).fit(df)
    got = {r["feature"]: r["importance"] for r in permutation_importance({"m": pipe}, df, ["a", "b"]).collect()}
    assert 0.35 < got["a"] <= 0.6 and 0 <= got["b"] < 0.02  # in units of AUC


def test_preprocessors_are_fitted_on_all_training_rows(spark, monkeypatch):
    from revlens.catalog import modelling as MO
    sf = "/root/testdata/sf0.001"
    MO.forget()
    monkeypatch.setattr(MO, "FIT_ROWS", 60)
    try:
        sp = MO.Split(spark, sf)
        train = sp.train.select("id")
        codes = MO.q_ordinal_encode(spark, sf).join(train, "id")
        known = sp.train.select("id", *[F.col(c).alias(f"{c}__v") for c in sp.cat])
        lost = codes.join(known, "id").agg(*[F.count_if(F.col(f"{c}__v").isNotNull() & (F.col(c) < 0)).alias(c)
                                             for c in sp.cat]).first().asDict()
        assert not any(lost.values()), lost
        parts = MO.q_standardize(spark, sf).join(train, "id").select(F.posexplode(F.array(*sp.num)))
        for r in parts.groupBy("pos").agg(F.avg("col").alias("m"), F.stddev("col").alias("s")).collect():
            assert abs(r["m"]) < 1e-6 and (abs(r["s"] - 1) < 1e-6 or r["s"] == 0)
    finally:
        MO.forget()


def test_permutation_does_not_depend_on_the_partition_setting(spark):
    from revlens.plans.evaluate import permuted_copies
    df = spark.createDataFrame([(i, float(i)) for i in range(200)], "id long, a double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        out = permuted_copies(df, ["a"], 1).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(out["id"]) == list(range(200)) and (out["a"] != out["id"]).sum() > 150


def test_folds_hold_out_every_training_row(spark, monkeypatch):
    from revlens.catalog import modelling as MO
    from revlens.plans import evaluate as EV
    sf = "/root/testdata/sf0.001"
    MO.forget()
    monkeypatch.setattr(MO, "FIT_ROWS", 300)
    scored = []
    monkeypatch.setattr(EV, "metrics_table", lambda s, by: scored.append(s) or s.groupBy(*by).agg(
        *[F.avg("score").alias(c) for c in ("balanced_accuracy", "f1_1", "gini")]))
    try:
        sp = MO.Split(spark, sf)
        for fit, held in sp.folds():
            assert fit.count() == 300 and fit.join(held, "id").count() == 0
        out = EV.cross_validate(sp.models(["decision_tree"]), sp.folds()).collect()
        assert len(out) == 1
        ids = sorted(r["id"] for r in scored[0].select("id").collect())
        assert ids == sorted(r["id"] for r in sp.train.select("id").collect()) and len(ids) > 300
    finally:
        MO.forget()


def test_learning_curve_sizes_are_nested_and_large_ones_listed(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from revlens.plans.evaluate import learning_curve
    rng = np.random.default_rng(1)
    data = [(i, float(a), int(a + rng.normal() > 0)) for i, a in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(data, "id long, a double, satisfied int").withColumn("is_test", F.col("id") % 3)
    pool, test = df.where("is_test > 0"), df.where("is_test = 0")
    seen = []

    class Spy(Pipeline):
        def _fit(self, rows):
            seen.append({r["id"] for r in rows.select("id").collect()})
            return super()._fit(rows)

    def build():
        return Spy(stages=[VectorAssembler(inputCols=["a"], outputCol="features"),
                           LogisticRegression(labelCol="satisfied")])
    out = {r["n_train"]: r for r in learning_curve({"lr": build}, pool, test, (50, 200, 5000), test_rows=120).collect()}
    assert {n: r["status"] for n, r in out.items()} == {50: "fitted", 200: "fitted", 5000: "skipped"}
    assert out[200]["lr"] > 0.5 and out[5000]["lr"] is None
    small, large = sorted(seen, key=len)
    assert (len(small), len(large)) == (50, 200) and small < large


def test_values_move_in_blocks_to_their_places(spark, monkeypatch):
    """Every block gets the values, NULLs too, that the bijection sends to its rows."""
    from revlens.operators.ranking import global_rank
    from revlens.plans import evaluate as EV
    monkeypatch.setattr(EV, "BLOCK_ROWS", 64)
    df = spark.range(500).selectExpr("id", "if(id % 5 = 0, null, double(id)) as a", "if(id % 3 = 0, null, string(id)) as b")
    order = [F.xxhash64(F.col("id"), F.lit(42)), F.col("id")]
    ranked = global_rank(df, order, name="at").orderBy("at").toPandas()
    out = EV.permuted_copies(df, ["a", "b"], 2).toPandas()
    assert len(out) == 2000
    for k, f in enumerate("ab"):
        for r in (0, 1):
            given = out[(out.feature == f) & (out.repeat == r)].set_index("id")[f]
            to = EV.bijection(np.arange(500), 500, [42, k, r])
            for at, place in enumerate(to):
                was, now = ranked[f][at], given[ranked["id"][place]]
                assert was == now or (was != was or was is None) and (now != now or now is None)


def test_models_are_fitted_on_all_training_rows(spark, monkeypatch):
    """Neither the split's fit rows nor those of the folds are a sample."""
    from revlens.catalog import modelling as MO
    df = spark.range(6000).selectExpr("id", "double(id % 13) as a", "cast(id % 3 > 0 as int) as satisfied")
    monkeypatch.setattr(MO, "model_frame", lambda *_, **__: (df, ["a"], None))
    MO.forget()
    try:
        sp = MO.Split(spark, "own rows")
        train = {r["id"] for r in sp.train.select("id").collect()}
        assert len(train) == 4800 and {r["id"] for r in sp.fit.select("id").collect()} == train
        weights = {r["satisfied"]: r["w"] for r in sp.fit.groupBy("satisfied").agg(F.sum("weight").alias("w")).collect()}
        assert all(abs(w - 2400) < 1e-6 for w in weights.values())
        for fit, held in sp.folds():
            assert {r["id"] for r in fit.select("id").collect()} == train - {r["id"] for r in held.select("id").collect()}
            assert abs(fit.count() - 3200) < 3
    finally:
        MO.forget()
