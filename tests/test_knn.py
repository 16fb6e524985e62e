"""Exact neighbours with pivots: equal to brute force, with far fewer distances on clustered rows."""

import numpy as np
import pandas as pd
import pytest

from revlens.operators import knn
from revlens.operators.knn import Search, knn_scores


def frames(spark, train, label, query):
    t = spark.createDataFrame([(i, [float(x) for x in v], int(y)) for i, (v, y) in enumerate(zip(train, label))],
                              "tid long, vec array<double>, label int").repartition(4)
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(query)],
                              "qid long, vec array<double>")
    return t, q


def brute(train, label, query, k):
    out = {}
    for i, v in enumerate(query):
        near = np.lexsort((np.arange(len(train)), ((train - v) ** 2).sum(axis=1)))[:k]
        out[i] = label[near].mean()
    return out


def clustered(seed, groups=12, size=40, dim=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim)) * 20
    train = np.concatenate([b + rng.normal(size=(size, dim)) for b in base])
    query = np.concatenate([b + rng.normal(size=(5, dim)) for b in base] + [rng.normal(size=(5, dim)) * 30])
    return train, (rng.random(len(train)) < 0.4).astype(int), query


@pytest.mark.parametrize("k,pivots,chunk", [(7, 12, 1000), (7, 12, 9), (60, 5, 50), (1000, 4, 100)])
def test_pivots_are_exact(spark, k, pivots, chunk):
    train, label, query = clustered(1)
    train = np.concatenate([train, train[:30], np.repeat(train[3:4], 40, axis=0)])      # ties and copies
    label = np.concatenate([label, 1 - label[:30], np.arange(40) % 2])
    t, q = frames(spark, train, label, query)
    got = {r["qid"]: r["score"] for r in knn_scores(t, q, k, block_rows=16, chunk_rows=chunk, pivots=pivots).collect()}
    want = brute(train, label, query, k)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)


def test_few_distances_on_clusters(spark):
    train, label, query = clustered(2, groups=20, size=60)
    t, q = frames(spark, train, label, query)
    search = Search(t, q, 5, 64, 1000, 40)
    assert search.neighbours().count() == len(query)
    assert search.distances() < 0.35 * len(train) * len(query)


def test_many_numbers_of_neighbours_at_once(spark):
    train, label, query = clustered(3)
    t, q = frames(spark, train, label, query)
    for chunk in (10_000, 60):
        got = {(r["qid"], r["k"]): r["score"] for r in knn_scores(t, q, [1, 20, 5000], chunk_rows=chunk).collect()}
        for k in (1, 20, 5000):
            want = brute(train, label, query, k)
            assert all(abs(got[i, k] - want[i]) < 1e-12 for i in want)


def test_visits_are_made_a_bounded_number_at_a_time():
    """Queries that visit all of many split cells make one row per cell, few at once."""
    rng = np.random.default_rng(5)
    cells = knn.Cells(rng.normal(size=(300, 4)))
    cells.n, cells.radius, cells.parts = np.full(300, 8000), np.full(300, 1e3), np.full(300, 40)
    asked = pd.DataFrame({"qid": np.arange(500), "vec": list(rng.normal(size=(500, 4))), "kth": 1.0})
    sizes = [len(frame) for frame in knn._visits(cells, 5)([asked])]
    assert max(sizes) <= knn.VISITS_AT_ONCE and sum(sizes) == 500 * 299


def test_all_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "NUMBERS_AT_ONCE", 50)     # distances of equal rows in many slices
    t, q = frames(spark, np.ones((90, 3)), np.arange(90) % 2, np.ones((4, 3)))
    near = knn._nearest(4)(q.toPandas(), t.toPandas().assign(cell=0, slab=0))
    assert sorted(near["tid"]) == sorted([0, 1, 2, 3] * 4) and (near["d2"] == 0).all()


def test_rows_with_repeated_ids_are_scored_each(spark, monkeypatch):
    """Permuted copies repeat their ids: a join on them would square their number."""
    from pyspark.ml.functions import array_to_vector
    from revlens.operators import knn as K
    rng = np.random.default_rng(3)
    train = spark.createDataFrame([(i, [float(a)], int(a > 0)) for i, a in enumerate(rng.normal(size=60))],
                                  "id long, x array<double>, satisfied int").withColumn("features", array_to_vector("x"))
    asked = spark.createDataFrame([(i % 2, [v]) for i, v in enumerate((-2.0, -1.0, 1.0, 2.0))],
                                  "id long, x array<double>").withColumn("features", array_to_vector("x"))
    model = K.KNNClassifier(k=5).fit(train)
    for numbers in (K.NUMBERS_AT_ONCE, 10):
        monkeypatch.setattr(K, "NUMBERS_AT_ONCE", numbers)
        got = sorted((r["id"], r["x"][0], r["probability"][1]) for r in model.transform(asked).collect())
        assert got == [(0, -2.0, 0.0), (0, 1.0, 1.0), (1, -1.0, 0.0), (1, 2.0, 1.0)]


def test_several_numbers_of_neighbours_with_ties(spark):
    from revlens.operators import knn as K
    rng = np.random.default_rng(4)
    t, tids = rng.integers(0, 3, (200, 2)).astype(float), rng.permutation(200)
    labels, q = rng.integers(0, 2, 200).astype(float), rng.integers(0, 3, (30, 2)).astype(float)
    got = K._shares(tids, t, labels, [1, 7, 100, 500])(q)
    for i, x in enumerate(q):
        order = np.lexsort((tids, ((t - x) ** 2).sum(axis=1)))
        assert np.allclose(got[i], [labels[order[:k]].mean() for k in (1, 7, 100, 500)])


def test_candidates_beyond_the_kth_distance_are_not_listed():
    """The second visits' rows that are farther than the k nearest so far; ties stay."""
    rows = pd.DataFrame({"tid": range(6), "vec": [[float(i)] for i in range(6)], "label": 1.0, "cell": 0, "slab": 0})
    asked = pd.DataFrame({"qid": [1, 2], "vec": [[0.0], [0.0]], "cell": 0, "kth2": [4.0, np.inf]})
    got = knn._nearest(5)(asked, rows)
    assert got.groupby("qid")["tid"].apply(list).to_dict() == {1: [0, 1, 2], 2: [0, 1, 2, 3, 4]}
