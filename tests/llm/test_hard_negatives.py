"""Mined negatives against plain Python over all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import hard_negatives
from revlens.llm.hard_negatives import TriangleSpec
from tests.llm.helpers import rows

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
                       T.StructField("rank", T.StringType()), T.StructField("dim", T.StringType())])
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(data, every=5):
    good = []
    for k, (i, v, label, *_) in enumerate(data):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, k, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for i, k, label, v in good:
        if i % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w)), j, m, other) for j, m, other, w in good
                 if m != k and len(w) == len(v)]
        for s, j, m, _ in sorted(x for x in score if x[3] == label)[:5]:
            fit = sorted(x for x in score if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit[:3])]
    return sorted(out)


def mined(spark, data, spec=TriangleSpec(), every=5):
    frame = spark.createDataFrame(data, SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(frame, spec, anchor=F.col("vec_id") % every == 0, label=label)
    assert got.columns == COLS
    return sorted(tuple(r[c] for c in COLS) for r in rows(got))


def clustered(seed, n=160, dim=12, groups=8):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    return [(i, [float(x) for x in base[i % groups] + rng.normal(size=dim) * 0.6], int(rng.integers(4)), "n", "r", "d")
            for i in range(n)]


ODD = [(900, None, 1, "", "", ""), (905, [1.0] * 12, None, "", "", ""), (None, [1.0] * 12, 1, "", "", ""),
       (910, [1.0, None] * 6, 1, "", "", ""), (915, [math.nan] * 12, 1, "", "", ""),
       (920, [math.inf] * 12, 1, "", "", ""), (925, [0.0] * 12, 1, "", "", ""), (930, [], 1, "", "", ""),
       (931, [], 1, "", "", ""), (932, [], 2, "", "", ""), (935, [0.5] * 3, 1, "", "", ""),
       (936, [0.5] * 3, 1, "", "", ""), (937, [0.3] * 3, 2, "", "", ""), (-5, [0.7] * 12, 3, "", "", "")]


@pytest.mark.parametrize("spec", [TriangleSpec(), TriangleSpec(part_rows=16, anchor_rows=4, tile_rows=3),
                                  TriangleSpec(references=1, part_cells=40)])
def test_against_all_pairs(spark, spec):
    data = clustered(1) + ODD + [(40, clustered(1)[40][1], 2, "", "", "")] * 3  # repeated ids and rows
    data += [(2000 + i, clustered(1)[3][1], i % 2, "", "", "") for i in range(60)]  # many copies, ties by id
    want = brute(data)
    assert len(want) > 100
    assert mined(spark, data, spec) == want


def test_empty_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1, "", "", ""), (2, [1.0], 1, "", "", "")]) == []


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.integers(-2**22, 2**22, size=6)], i % 2, "", "", "") for i in range(40)]
    assert max(abs(r[4]) for r in mined(spark, data)) > 2 ** 53
    assert mined(spark, data) == brute(data)


def test_bounds_hold_and_skip_most_pairs_of_clustered_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 32))
    vectors = np.floor(256 * (base[rng.integers(20, size=2000)] + 0.02 * rng.normal(size=(2000, 32))))
    norm = np.linalg.norm(vectors, axis=1)
    refs = hard_negatives.directions(32, base[:8].tolist(), TriangleSpec())
    angle = np.arccos(np.clip(vectors / norm[:, None] @ refs, -1, 1))
    n = len(vectors)
    side = hard_negatives.Side(pa.table({
        "vec_id": np.arange(n), "node": np.arange(n), "label": np.zeros(n, int), "norm": norm,
        "whole": pa.array([v.tobytes() for v in vectors], pa.binary()),
        "angle": pa.array([v.tobytes() for v in angle], pa.binary())}), 32)
    tile = np.arange(200)
    low, high = hard_negatives.score_bounds(side, tile, side)
    score = hard_negatives.scores(side, tile, side, np.arange(n))
    assert (low <= score).all() and (score <= high).all()
    own = score >= np.partition(score, n - 6, axis=1)[:, n - 6][:, None] * 0.95
    assert (high[own] >= score[own]).all()
    assert (high >= 0.9 * (norm[tile] ** 2)[:, None]).mean() < 0.5  # most pairs can't be near
