"""Hard negatives by angular triangle filtering.

Each component is turned into the integer ``floor(scale * x)``.  With a row its norm
and its angles to some reference directions are stored.  For an anchor a, a row v
and any reference r the triangle inequality on the sphere gives
``|ar - vr| <= angle(a, v) <= min(ar + vr, 2 pi - ar - vr)``: an interval of
the cosine, which times the norms, with a margin for rounding, bounds the integer
score.  Only pairs whose interval reaches what is looked for are scored:

* positives: the interval's upper end reaches the k-th best lower end in the part;
* negatives: the interval overlaps one of the anchor's score windows, which follow
  from its positives.

Scores are exact: products of doubles below 2**52, Python integers above.  Anchors
(a stated query set) meet all rows in blocks: rows and anchors are dealt to parts of
bounded size, a task returns a few rows per anchor, and Spark ranks those.
Positives are looked for among rows of the anchor's label only; a label of any size
is split into parts.  References decide what is skipped, not what is returned: they
are ``references`` rows with the least hashes (a bounded sample), or fixed random
directions for vectors of a length that none of them has.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part; vectors of different length never meet; empty and
zero vectors score 0; repeated rows and ids count as separate rows, each repeated
anchor with its own results; a positive without fitting negatives gives no row; an
empty table gives an empty result; other columns are ignored.  A score that a
64-bit integer can't hold is an error, not a wrapped number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import join_by_key, materialize

OUT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
       "positive_score bigint, negative_score bigint")


@dataclass(frozen=True)
class TriangleSpec:
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50    # of the positive's score
    high_percent: int = 95
    scale: int = 256
    references: int = 8
    anchor_rows: int = 2048
    part_rows: int = 8192
    part_cells: int = 1 << 22  # components of a part, for long vectors
    tile_rows: int = 64
    seed: int = 11


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def directions(dim: int, given: list[list[float]], spec: TriangleSpec) -> np.ndarray:
    """Unit reference directions (dim x references)."""
    found = [v for v in given if any(v)]
    if not found:
        found = np.random.default_rng(spec.seed).normal(size=(spec.references, dim))
    found = np.array(found, float)
    return (found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)).T


def angled(rows: DataFrame, spec: TriangleSpec) -> DataFrame:
    """Rows with their integer vector (as doubles), norm and angles to the references."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(spec.seed)), "vec_id").limit(spec.references)
    given: dict[int, list] = {}
    for r in sample.select("vector").collect():
        given.setdefault(len(r["vector"]), []).append(list(r["vector"]))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                vectors = part.column("vector").to_pylist()
                by_dim: dict[int, list[int]] = {}
                for k, v in enumerate(vectors):
                    by_dim.setdefault(len(v), []).append(k)
                for dim, ks in by_dim.items():
                    whole = np.floor(spec.scale * np.array([vectors[k] for k in ks], float).reshape(len(ks), dim))
                    norm = np.sqrt((whole * whole).sum(axis=1))
                    cosine = (whole / np.where(norm > 0, norm, 1)[:, None]) @ directions(dim, given.get(dim, []), spec)
                    angle = np.arccos(np.clip(cosine, -1, 1))
                    kept = part.select(["vec_id", "label", "anchor"]).take(pa.array(ks))
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, pa.array([dim] * len(ks), pa.int32()), pa.array(norm),
                         pa.array([x.tobytes() for x in whole], pa.binary()),
                         pa.array([x.tobytes() for x in angle], pa.binary())],
                        names=["vec_id", "label", "anchor", "dim", "norm", "whole", "angle"])

    return rows.mapInArrow(run, "vec_id bigint, label bigint, anchor boolean, dim int, norm double, "
                                "whole binary, angle binary")


class Side:
    """One side of a part: integer vectors, norms and angles of some rows."""

    def __init__(self, table: pa.Table, dim: int):
        self.table, self.n = table, table.num_rows
        self.vec_id = table.column("vec_id").to_numpy()
        self.node = table.column("node").to_numpy()
        self.label = table.column("label").to_numpy()
        self.norm = table.column("norm").to_numpy()
        self.whole = np.frombuffer(b"".join(table.column("whole").to_pylist()), "<f8").reshape(self.n, dim)
        angle = np.frombuffer(b"".join(table.column("angle").to_pylist()), "<f8").reshape(self.n, -1 if self.n else 1)
        self.cos, self.sin = np.cos(angle), np.sin(angle)


def score_bounds(left: Side, tile: np.ndarray, right: Side) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of ``left[tile]`` with all of ``right``."""
    low = np.full((len(tile), right.n), -1.0)
    high = np.full((len(tile), right.n), 1.0)
    for r in range(right.cos.shape[1]):
        along = np.outer(left.cos[tile, r], right.cos[:, r])
        across = np.outer(left.sin[tile, r], right.sin[:, r])
        np.maximum(low, along - across, out=low)   # cosine of the sum of the angles
        np.minimum(high, along + across, out=high)  # cosine of their difference
    norms = np.outer(left.norm[tile], right.norm)
    return (low - 1e-6) * norms - 1, (high + 1e-6) * norms + 1


def scores(left: Side, tile: np.ndarray, right: Side, cols: np.ndarray) -> np.ndarray:
    """Exact integer scores of ``left[tile]`` with ``right[cols]``."""
    if not len(cols):
        return np.zeros((len(tile), 0), np.int64)
    if left.norm[tile].max() * right.norm[cols].max() < 2.0 ** 52:  # bounds every partial sum
        return (left.whole[tile] @ right.whole[cols].T).astype(np.int64)
    whole = [np.array([[int(x) for x in v] for v in m], object) for m in (left.whole[tile], right.whole[cols])]
    return whole[0] @ whole[1].T


def _tiles(side: Side, spec: TriangleSpec):
    """Anchors in tiles; those near the same reference share one."""
    order = np.lexsort((side.node, side.cos.argmax(axis=1)))
    return (order[at:at + spec.tile_rows] for at in range(0, side.n, spec.tile_rows))


def _sides(key, table: pa.Table) -> tuple[Side, Side]:
    dim = key[0].as_py()
    table = table.sort_by([("vec_id", "ascending"), ("node", "ascending")])
    asks = table.column("asks").to_numpy()
    return Side(table.filter(pa.array(asks)), dim), Side(table.filter(pa.array(~asks)), dim)


def _positives(spec: TriangleSpec):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        anchors, rows = _sides(key, table)
        k, out = spec.positives, []
        for tile in _tiles(anchors, spec) if rows.n else ():
            able = anchors.node[tile][:, None] != rows.node[None, :]
            low, high = score_bounds(anchors, tile, rows)
            if rows.n > k:
                low[~able] = -np.inf
                able &= high >= np.partition(low, rows.n - k, axis=1)[:, rows.n - k][:, None]
            cols = np.flatnonzero(able.any(axis=0))
            score = scores(anchors, tile, rows, cols)
            for i, a in enumerate(tile):
                at = np.flatnonzero(able[i, cols])
                found = score[i, at]
                if len(at) > k:
                    enough = found >= np.partition(found, len(at) - k)[len(at) - k]
                    at, found = at[enough], found[enough]
                for j in np.argsort(-found, kind="stable")[:k]:
                    row = cols[at[j]]
                    out.append((int(anchors.node[a]), int(anchors.vec_id[a]), int(rows.node[row]),
                                int(rows.vec_id[row]), int(found[j])))
        return _table(out, ["node", "anchor_id", "positive_node", "positive_id", "positive_score"])
    return run


def _negatives(spec: TriangleSpec):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        anchors, rows = _sides(key, table)
        given = anchors.table.column("windows").to_pylist()
        windows = [[(-(-spec.low_percent * w["positive_score"] // 100),
                     spec.high_percent * w["positive_score"] // 100, w) for w in ws] for ws in given]
        windows = [[w for w in ws if w[0] <= w[1]] for ws in windows]
        out = []
        for tile in _tiles(anchors, spec) if rows.n else ():
            low, high = score_bounds(anchors, tile, rows)
            able = np.zeros(low.shape, bool)
            for i, a in enumerate(tile):
                for least, most, _ in windows[a]:
                    able[i] |= (high[i] >= least) & (low[i] <= most)
            able &= anchors.label[tile][:, None] != rows.label[None, :]
            cols = np.flatnonzero(able.any(axis=0))
            score = scores(anchors, tile, rows, cols)
            for i, a in enumerate(tile):
                at = np.flatnonzero(able[i, cols])
                falling = -score[i, at]
                order = np.argsort(falling, kind="stable")
                at, falling = at[order], falling[order]
                for least, most, w in windows[a]:
                    first = int(np.searchsorted(falling, -most, side="left"))
                    stop = int(np.searchsorted(falling, -least, side="right"))
                    for j in range(first, min(stop, first + spec.negatives)):
                        out.append((int(anchors.node[a]), int(anchors.vec_id[a]), w["positive_node"],
                                    w["positive_id"], w["positive_score"], int(rows.vec_id[cols[at[j]]]),
                                    -int(falling[j])))
        return _table(out, ["node", "anchor_id", "positive_node", "positive_id", "positive_score", "negative_id",
                            "negative_score"])
    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)})


def meetings(anchors: DataFrame, rows: DataFrame, cell: list[str], spec: TriangleSpec) -> DataFrame:
    """Anchors (``asks``) and rows of a cell, dealt to pairs of parts (p, q) of bounded size."""
    rows = rows.select("vec_id", "node", "label", "dim", "norm", "whole", "angle")
    asked = anchors.groupBy(*cell).agg(F.count(F.lit(1)).alias("n_anchors"))
    here = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n_rows"))
    limit = F.greatest(F.lit(1), F.least(F.lit(spec.part_rows),
                                         F.floor(F.lit(spec.part_cells) / F.greatest("dim", F.lit(1)))))
    sizes = materialize(asked.join(here, cell).select(
        *cell, "n_rows", "n_anchors", F.ceil(F.col("n_anchors") / F.least(limit, F.lit(spec.anchor_rows))).alias("ps"),
        F.ceil(F.col("n_rows") / limit).alias("qs")), "cells")
    total = sizes.agg(F.sum("n_rows"), F.sum("n_anchors")).first()
    own = F.xxhash64("node", F.lit(spec.seed))

    def others(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    held = (join_by_key(rows, sizes, cell, "n_rows", total[0] or 0)
            .withColumn("p", others("ps")).withColumn("q", F.pmod(own, F.col("qs")))
            .withColumn("asks", F.lit(False)))
    asking = (join_by_key(anchors, sizes, cell, "n_anchors", total[1] or 0)
              .withColumn("p", F.pmod(own, F.col("ps"))).withColumn("q", others("qs"))
              .withColumn("asks", F.lit(True)))
    return asking.unionByName(held, allowMissingColumns=True).drop("n_rows", "n_anchors", "ps", "qs")


def best(found: DataFrame, by: list[str], order: list, k: int, name: str) -> DataFrame:
    return found.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
        F.col(name) <= k)


def mine(vectors: DataFrame, spec: TriangleSpec = TriangleSpec(), *, anchor: Column, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors and ``label``, if given, replaces the label
    column; both may use any column of ``vectors``."""
    wanted = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        (F.col(label_col) if label is None else label).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = wanted.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = materialize(angled(good, spec).withColumn("node", F.monotonically_increasing_id()), "angles")
    anchors = rows.filter("anchor").drop("anchor")

    near = (meetings(anchors, rows, ["dim", "label"], spec).groupBy("dim", "label", "p", "q")
            .applyInArrow(_positives(spec), "node bigint, anchor_id bigint, positive_node bigint, "
                                            "positive_id bigint, positive_score bigint"))
    positives = materialize(best(near, ["node"], [F.desc("positive_score"), "positive_id", "positive_node"],
                                 spec.positives, "place").drop("place"), "positives")

    windows = positives.groupBy("node").agg(F.collect_list(F.struct(  # spec.positives at most
        "positive_node", "positive_id", "positive_score")).alias("windows"))
    far = (meetings(anchors.join(windows, "node"), rows, ["dim"], spec).groupBy("dim", "p", "q")
           .applyInArrow(_negatives(spec), "node bigint, anchor_id bigint, positive_node bigint, positive_id bigint, "
                                           "positive_score bigint, negative_id bigint, negative_score bigint"))
    ranked = best(far, ["node", "positive_node"], [F.desc("negative_score"), "negative_id"], spec.negatives, "rank")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score",
                         "negative_score")
