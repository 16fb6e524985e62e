"""Vector links against all cosines."""

import numpy as np
import pytest
from pyspark.sql import types as T

from revlens.llm import near_vectors
from revlens.llm.near_vectors import SubspaceSpec
from tests.llm.helpers import rows

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("n_links", T.StringType()),
                       T.StructField("block", T.StringType())])


def as_rows(vectors, start=0):
    return [(start + i, None if v is None else [None if x is None else float(x) for x in v], 1, "clash", "clash")
            for i, v in enumerate(vectors)]


def brute(data):
    good = [(i, np.array(r[1], float)) for i, r in enumerate(data)
            if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    n, label = [0] * len(data), list(range(len(data)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for p, (i, a) in enumerate(good):
        for j, b in good[:p]:
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                n[i] += 1
                n[j] += 1
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(repr((r[0], n[i], least.get(find(i)))) for i, r in enumerate(data))


def clustered(seed, dim=64, groups=30, size=6):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = rng.normal(size=dim)
        out += [base + rng.normal(size=dim) * rng.choice([0.05, 0.25, 0.32, 0.4]) for _ in range(size)]
    return [np.float32(v) for v in out]


@pytest.mark.parametrize("spec", [SubspaceSpec(), SubspaceSpec(blocks=8, slab=0.1, part_rows=16, tile_rows=5),
                                  SubspaceSpec(part_rows=2, tile_rows=3)])
def test_against_all_pairs(spark, spec):
    data = as_rows(clustered(3)) + as_rows([clustered(3)[0]] * 5, 500)
    data.append((700, [float(2 * x) for x in clustered(3)[7]], 0, "x", "x"))  # a multiple links too
    got = rows(near_vectors.links(spark.createDataFrame(data, SCHEMA), spec))
    assert sorted(repr((g["vec_id"], g["n_links"], g["component_id"])) for g in got) == brute(data)
    assert all(g["kept"] == (g["vec_id"] == g["component_id"]) for g in got)


def test_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = as_rows([None, [], [0.0, 0.0], [1.0, nan], [inf, 1.0], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0],
                    [3.0], [-1.0, 0.0], [1e30, 1e30], [1.0, 1.0], [-0.0, 5.0], [0.0, 5.0]])
    data += [(6, [1.0, 0.0], 2, "r", "r"), (None, [0.0, -3.0], 1, "n", "n"), (None, None, 1, "n", "n")]
    got = rows(near_vectors.links(spark.createDataFrame(data, SCHEMA)))
    assert sorted(repr((g["vec_id"], g["n_links"], g["component_id"])) for g in got) == brute(data)


def test_empty_table(spark):
    assert near_vectors.links(spark.createDataFrame([], SCHEMA)).collect() == []
