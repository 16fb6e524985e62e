"""Two-level cumulative sums, exact metrics and sampling invariants."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from revlens.operators import metrics as M
from revlens.operators import ranking as RK
from revlens.operators import sampling as SP
from revlens.operators import screen as SC


def test_cumulative_matches_pandas_and_survives_union(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "k": rng.permutation(500),
                        "v": rng.integers(0, 10, 500).astype(float)})
    df = spark.createDataFrame(pdf)
    out = RK.cumulative(df, ["k"], ["v"], ["g"], partitions=7)
    both = out.unionByName(out.withColumn("g", F.col("g") + 10))
    got = both.toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(cum_v=lambda d: d.groupby("g")["v"].cumsum())
    a = got[got.g < 10].sort_values(["g", "k"])
    assert np.allclose(a["cum_v"].to_numpy(), exp["cum_v"].to_numpy())
    b = got[got.g >= 10].sort_values(["g", "k"])
    assert np.allclose(b["cum_v"].to_numpy(), exp["cum_v"].to_numpy())


def test_auc_symmetry_and_ties(spark):
    rows = [(i, i % 2, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, score double")
    auc = M.roc_auc(df).first().auc
    neg = M.roc_auc(df.withColumn("score", -F.col("score"))).first().auc
    assert abs(auc + neg - 1) < 1e-12
    one_class = df.withColumn("y", F.lit(1))
    assert M.roc_auc(one_class).first().auc is None


def test_lift_zero_base_and_classification_zero_division(spark):
    df = spark.createDataFrame([(i, 0, float(i), 0) for i in range(20)],
                               "id long, y int, score double, pred int")
    assert M.top_decile_lift(df).first().lift is None
    cm = M.classification_metrics(df).first()
    assert cm.precision_1 == 0.0 and cm.f1_1 == 0.0 and cm.recall_0 == 1.0


def test_stratified_split_keeps_shares(spark):
    rows = [(i, 1 if i % 10 < 3 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = SP.stratified_split(df, "y", ["id"], test_size=0.2).groupBy("y").agg(
        F.sum("is_test").alias("t")).collect()
    assert {r.y: r.t for r in s} == {0: 140, 1: 60}
    n = SP.stratified_sample(df, "y", 101, ["id"])
    assert n.count() == 101
    assert SP.quotas({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}


def test_vif_orthogonal_and_exact_combination(spark):
    rows = [(float(a), float(b)) for a in range(-2, 3) for b in range(-2, 3)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("c", F.col("a") + F.col("b"))
    v = {r.variable: r.VIF for r in SC.vif(df.select("a", "b"), ["a", "b"]).collect()}
    assert abs(v["a"] - 1) < 1e-9 and abs(v["b"] - 1) < 1e-9
    v3 = {r.variable: r.VIF for r in SC.vif(df, ["a", "b", "c"]).collect()}
    assert all(np.isinf(x) for x in v3.values())


def test_bootstrap_self_difference_is_zero(spark):
    from revlens.operators import bootstrap as BS
    base = spark.createDataFrame([(i, i % 3 == 0, float(i % 11)) for i in range(300)],
                                 "id long, y boolean, score double").withColumn("y", F.col("y").cast("int"))
    two = base.withColumn("model", F.lit("a")).unionByName(base.withColumn("model", F.lit("b")))
    res = {r.model: r for r in BS.paired_bootstrap(two, "a", replicates=20).collect()}
    assert res["b"].delta_vs_full_lo == 0 and res["b"].delta_vs_full_hi == 0
    assert res["b"].delta_vs_full == 0 and not res["b"].differs_from_full_bonf


def test_rank_cutoffs_match_brute_force_and_widen(spark):
    import hashlib
    rows = [(i, "a" if i % 7 else "b") for i in range(700)]
    df = spark.createDataFrame(rows, "id long, y string")
    counts = {"a": 600, "b": 100}
    targets = [("a", 1), ("a", 123), ("a", 599), ("b", 50), ("b", 99)]
    for margin in (6.0, 0.001):          # the tiny margin forces the widening loop
        cuts = SP.rank_cutoffs(df, ["id"], "y", counts, targets, margin=margin)
        for c, r in targets:
            ordered = sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), i)
                             for i, cc in rows if cc == c)
            assert cuts[(c, r)] == ordered[r - 1]


def test_cutoffs_after_a_draw_with_the_same_seed_rank_few_rows(spark, monkeypatch):
    """What a draw leaves has no hashes below its cutoff: bands are counted, not widened over the rows."""
    import hashlib
    ranked = []
    monkeypatch.setattr(SP, "BAND_ROWS", 50)
    monkeypatch.setattr(SP, "global_rank", lambda df, *a, f=SP.global_rank, **kw: ranked.append(df.count()) or f(df, *a, **kw))
    df = spark.range(6000).selectExpr("id", "if(id % 11 = 0, null, id % 2) as y")
    left = SP.stratified_split(df, "y", ["id"], test_size=0.3).where("is_test = 0").drop("is_test")
    rows = left.toPandas()
    ranked.clear()
    got = sorted(r["id"] for r in SP.stratified_sample(left, "y", 500, ["id"]).collect())
    groups = {None if c != c else c: sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), i) for i in g["id"])
              for c, g in rows.groupby("y", dropna=False)}
    quota = SP.quotas({c: len(g) for c, g in groups.items()}, 500)
    assert got == sorted(i for c, g in groups.items() for _, i in g[:quota[c]]) and len(got) == 500
    assert len(ranked) == 1 and ranked[0] <= 3 * 50


def test_exact_quantiles_match_numpy(spark):
    from revlens.operators.quantiles import exact_quantiles, quantiles_checked
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=301), 1)
    pdf = pd.DataFrame({"a": vals, "b": np.where(np.arange(301) % 5 == 0, np.nan, vals * 3)})
    df = spark.createDataFrame(pdf).withColumn("b", F.nanvl("b", F.lit(None).cast("double")))
    got = {r.variable: (r.q0, r.q1, r.q2) for r in
           exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9], partitions=5).collect()}
    for c in ("a", "b"):
        exp = np.nanquantile(pdf[c].to_numpy(), [0.25, 0.5, 0.9])
        assert np.allclose(got[c], exp)
    fast = quantiles_checked(df, ["a", "b"], [0.25, 0.5, 0.9])
    slow = quantiles_checked(df, ["a", "b"], [0.25, 0.5, 0.9], max_distinct=1)
    assert np.allclose(fast["a"], slow["a"]) and np.allclose(fast["b"], slow["b"])


def test_knn_matches_brute_force(spark):
    from revlens.operators.knn import knn_scores
    rng = np.random.default_rng(5)
    tr = rng.normal(size=(120, 4))
    qs = rng.normal(size=(30, 4))
    lab = (rng.random(120) < 0.4).astype(int)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(lab[i])) for i in range(120)],
                                  "tid long, vec array<double>, label int").repartition(4)
    query = spark.createDataFrame([(i, qs[i].tolist()) for i in range(30)],
                                  "qid long, vec array<double>")
    got = {r.qid: r.score for r in knn_scores(train, query, k=7, block_rows=8).collect()}
    for i in range(30):
        d = ((tr - qs[i]) ** 2).sum(axis=1)
        nn = np.lexsort((np.arange(120), d))[:7]
        assert abs(got[i] - lab[nn].mean()) < 1e-12


def test_every_resample_has_n_rows(spark):
    from revlens.operators.bootstrap import exact_draws, replicate_sums
    rng = np.random.default_rng(3)
    for n in (1, 4, 300):
        rows = [(i, m, float(rng.normal()), int(rng.random() < 0.4)) for i in range(n) for m in ("a", "b")]
        df = spark.createDataFrame(rows, "id long, model string, score double, y int").repartition(5)
        got = replicate_sums(df, replicates=200).collect()
        assert len(got) == 400 and {r["p"] + r["n"] for r in got} == {float(n)}
        assert len({r["p"] for r in got}) > 1 or n == 1
    # the counts of a row are those of n even draws: mean 1, variance 1 - 1/n
    keys = spark.createDataFrame([(str(i),) for i in range(400)], "key string")
    draws = exact_draws(keys, 400)
    rows = keys.join(draws.extra, "key", "left").collect()
    counts = draws.counts([r["key"] for r in rows], [r["extra"] for r in rows])
    assert (counts.sum(axis=0) == 400).all() and not draws.off
    assert abs(counts.astype(float).var() - 1) < 0.03


def test_a_resample_beyond_n_is_drawn_anew(spark, monkeypatch):
    from revlens.operators import bootstrap as BS
    monkeypatch.setattr(BS, "poisson_rate", lambda n: 1.0)
    df = spark.createDataFrame([(i, "a", float(i), i % 2) for i in range(30)],
                               "id long, model string, score double, y int")
    assert BS.exact_draws(df.selectExpr("cast(id as string) as key"), 50).off
    assert {r["p"] + r["n"] for r in BS.replicate_sums(df, replicates=50).collect()} == {30.0}


def test_few_scores_are_added_up_by_key(spark, monkeypatch):
    """The same sums as by score ranges, where a frequent score is one task's; also when replicates start from zero."""
    from revlens.operators import bootstrap as BS
    data = [(m, i, i * i % 3 % 2, float(i * k % 5)) for m, k in (("a", 3), ("b", 7)) for i in range(4000)]
    df = spark.createDataFrame(data + [("b", 10_000, 1, 9.0)], "model string, id long, y int, score double")

    def sums():
        return {(r["replicate"], r["variant"]): (r["u"], r["p"], r["n"]) for r in BS.replicate_sums(df, replicates=24).collect()}

    for rate in (BS.poisson_rate, lambda n: 1.0):
        with monkeypatch.context() as m:
            m.setattr(BS, "poisson_rate", rate)
            m.setattr(BS, "MAX_SCORES", 0)
            by_range = sums()
            m.setattr(BS, "MAX_SCORES", 1024)
            m.setattr(BS, "_range_sums", None)
            assert sums() == by_range and len(by_range) == 48
            assert all(p + n == 4001 for (_, v), (_, p, n) in by_range.items() if v == "b")


def test_auc_writes_no_rows(spark, monkeypatch):
    """Score ranges are added up where they are; groups with NULL, ties and many batches."""
    from revlens.operators import metrics as M
    from revlens.operators import ranking as RK
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id % 3) as g", "cast(id % 7 > 2 as int) as y",
                                        "double(id * 7919 % 20011) as score")
    monkeypatch.setattr(RK, "materialize", None)
    got = {r["g"]: r["auc"] for r in M.roc_auc(df, by=["g"], partitions=3).collect()}
    rows = df.toPandas()
    for g, auc in got.items():
        some = rows[rows["g"].isna() if g is None else rows["g"] == g]
        rank = some["score"].rank()
        p = int(some["y"].sum())
        want = (rank[some["y"] == 1].sum() - p * (p + 1) / 2) / (p * (len(some) - p))
        assert abs(auc - want) < 1e-12
    assert set(got) == {None, 1, 2}


def test_missing_draws_are_not_broadcast(spark):
    """A number per replicate becomes replicates x sqrt(n) rows: a broadcast would hold them all in the driver."""
    from revlens.operators import bootstrap as BS
    draws = BS.exact_draws(spark.range(400).selectExpr("cast(id as string) as key"), 50)
    drawn = sum(len(r["extra"]) for r in draws.extra.collect())
    assert drawn > 50 * 20
    plan = draws.extra._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan.split("Initial Plan")[0] and "SortMergeJoin" in plan


def test_digests_of_many_keys_are_md5():
    """All lengths around the words and the block of a digest; no keys and repeated keys too."""
    import hashlib
    keys = [bytes([65 + i % 26]) * i for i in range(70)] + [b"7", b"7", "\u00e9".encode()]
    ends = [f"|{b}|42".encode() for b in (0, 9, 10, 249)]
    got = SP.md5_of_pairs(keys, ends)
    assert [bytes(got[i, j]) for i in range(len(keys)) for j in range(4)] == [hashlib.md5(k + e).digest() for k in keys for e in ends]
    assert SP.md5_of_pairs([], ends).shape == (0, 4, 16) and SP.poisson_weights([], 16).shape == (0, 16)
