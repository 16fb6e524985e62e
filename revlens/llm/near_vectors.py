"""Near-duplicate embeddings by a subspace pigeonhole join.

For unit vectors, cosine >= c means a squared distance of at most 2 - 2c.  After
a rotation (orthogonal, from the seed) a vector is split into ``blocks`` blocks
of coordinates, and the budget is split in proportion to the blocks' sizes: a
linked pair is within the budget of at least one block.  Each block is
range-joined by itself: vectors are dealt to slabs of the block's leading
coordinate and copied to every lower slab that their range touches, so two block
neighbours meet in the lower of their home slabs.  Candidates are verified with the
cosine of the original values in double precision.

A pair is computed once: in the first block whose budget it meets, in the lower home
slab, for both of its ends.  A task returns numbers of links per vector and a
spanning forest of its links.  Equal vectors are collapsed first (with their
number); slabs of more than ``part_rows`` vectors are split and verified as pairs of
parts, in tiles.

Defined results: vectors that are null, empty or zero or hold null or non-finite
components link with nothing; vectors of different length never link; equal
vectors of repeated rows or ids count as separate vectors; a null id has a null
component unless a linked vector has an id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import join_by_key, materialize
from revlens.llm.components import components


@dataclass(frozen=True)
class SubspaceSpec:
    cosine: float = 0.9
    blocks: int = 4
    slab: float = 0.25
    part_rows: int = 32_768
    tile_rows: int = 512
    seed: int = 5

    @property
    def budget(self) -> float:
        return 2 - 2 * self.cosine


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]


def block_bounds(dim: int, spec: SubspaceSpec) -> list[tuple[int, int, float]]:
    """(start, stop, squared-distance budget) of each block."""
    cuts = np.linspace(0, dim, min(spec.blocks, dim) + 1).astype(int)
    return [(int(a), int(b), spec.budget * (b - a) / dim) for a, b in zip(cuts, cuts[1:])]


def turned(vectors: np.ndarray, spec: SubspaceSpec) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return unit @ rotation(vectors.shape[1], spec.seed)


def usable(embedding):
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(True))
            & F.exists(embedding, lambda x: x != 0))


def deal(vectors: DataFrame, kind: str, spec: SubspaceSpec) -> DataFrame:
    """Each vector's home slab and the lower slabs in its range, for each block."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                by_dim: dict[int, list[int]] = {}
                rows = part.column(1).to_pylist()
                for k, v in enumerate(rows):
                    by_dim.setdefault(len(v), []).append(k)
                for dim, ks in by_dim.items():
                    raw = np.array([rows[k] for k in ks], kind)
                    yield _dealt(np.array(part.column(0).to_pylist())[ks], part.column(2).take(pa.array(ks)),
                                 raw, dim, spec)

    return vectors.select("node", "embedding", "copies").mapInArrow(
        run, "dim int, block int, slab int, home boolean, node bigint, copies bigint, vector binary")


def _dealt(node, copies, raw, dim, spec) -> pa.RecordBatch:
    place = turned(raw.astype(float), spec)
    data = [x.tobytes() for x in raw]
    block, slab, home, who = [], [], [], []
    for b, (start, _, budget) in enumerate(block_bounds(dim, spec)):
        reach = np.sqrt(budget) + 1e-6
        own = np.floor(place[:, start] / spec.slab).astype(int)
        low = np.floor((place[:, start] - reach) / spec.slab).astype(int)
        for step in range(int((own - low).max()) + 1):
            at = np.flatnonzero(low + step <= own)
            block.append(np.full(len(at), b))
            slab.append(low[at] + step)
            home.append(low[at] + step == own[at])
            who.append(at)
    who = np.concatenate(who)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(who), dim), pa.int32()), pa.array(np.concatenate(block), pa.int32()),
         pa.array(np.concatenate(slab), pa.int32()), pa.array(np.concatenate(home)),
         pa.array(node[who], pa.int64()), copies.take(pa.array(who)),
         pa.array([data[k] for k in who], pa.binary())],
        names=["dim", "block", "slab", "home", "node", "copies", "vector"])


class Labels:
    """Components over rows of a task, with links in arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.ties: list[tuple[int, int]] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            apart = np.flatnonzero(self.label[left] != self.label[right])
            if not len(apart):
                return
            left, right = left[apart], right[apart]
            low = np.minimum(self.label[left], self.label[right])
            high = np.maximum(self.label[left], self.label[right])
            tops, first = np.unique(high, return_index=True)  # each tree is hung on another once
            self.ties += list(zip(left[first].tolist(), right[first].tolist()))
            jump = np.arange(len(self.label))
            jump[tops] = low[first]
            while (jump[jump] != jump).any():
                jump = jump[jump]
            self.label = jump[self.label]


def _meetings(home: np.ndarray, side: np.ndarray, within: bool):
    """(rows, rows they meet, whether each meets only those after it): homes meet homes and
    visitors, of the same part or of the other one; visitors don't meet each other."""
    mine, visit = np.flatnonzero(home & ~side), np.flatnonzero(~home & ~side)
    if within:
        yield mine, np.concatenate([mine, visit]), True
    else:
        yield mine, np.flatnonzero(side), False
        yield visit, np.flatnonzero(home & side), False


def _join_parts(kind: str, spec: SubspaceSpec):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, block = key[0].as_py(), key[1].as_py()
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        home, side = (table.column(c).to_numpy() for c in ("home", "side"))
        raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), kind).reshape(len(node), dim).astype(float)
        norm = np.linalg.norm(raw, axis=1)
        place = turned(raw, spec)
        bounds = block_bounds(dim, spec)
        start, stop, budget = bounds[block]
        links, forest = np.zeros(len(node), np.int64), Labels(len(node))
        sub = place[:, start:stop].astype(np.float32)
        half = (sub * sub).sum(axis=1, keepdims=True) / 2
        one = np.ones_like(half)
        # the product of a row of ``near`` and one of ``far`` is minus half their squared distance
        near, far = np.hstack([sub, one, half]), np.hstack([sub, -half, -one])
        for mine, theirs, after in _meetings(home, side, key[3] == key[4]):
            met = far[theirs].T
            for at in range(0, len(mine), spec.tile_rows):
                tile, skip = mine[at:at + spec.tile_rows], at if after else 0
                h, a = np.nonzero(near[tile] @ met[:, skip:] >= -(budget + 1e-4) / 2)
                if after:
                    h, a = h[a > h], a[a > h]
                for cut in range(0, len(h), 200_000):
                    left, right = tile[h[cut:cut + 200_000]], theirs[skip + a[cut:cut + 200_000]]
                    ok = _first_block(place, left, right, block, bounds)
                    left, right = left[ok], right[ok]
                    cosine = np.einsum("ij,ij->i", raw[left], raw[right]) / (norm[left] * norm[right])
                    linked = cosine >= spec.cosine
                    left, right = left[linked], right[linked]
                    np.add.at(links, left, copies[right])
                    np.add.at(links, right, copies[left])
                    forest.add(left, right)
        some = np.flatnonzero(links)
        none = [None] * len(some)
        tied = np.array(forest.ties, np.int64).reshape(-1, 2)
        return pa.table({
            "node": pa.array(np.concatenate([node[some], node[tied[:, 0]]]), pa.int64()),
            "links": pa.array(links[some].tolist() + [0] * len(tied), pa.int64()),
            "other": pa.array(none + node[tied[:, 1]].tolist(), pa.int64())})
    return run


def _first_block(place, left, right, block, bounds) -> np.ndarray:
    """Pairs within this block's budget and no earlier one's (the same for either order)."""
    ok = np.ones(len(left), bool)
    for b, (start, stop, budget) in enumerate(bounds[:block + 1]):
        gap = place[left, start:stop] - place[right, start:stop]
        near = np.einsum("ij,ij->i", gap, gap) <= budget * (1 + 1e-9)
        ok &= near if b == block else ~near
    return ok


def paired_parts(dealt: DataFrame, spec: SubspaceSpec) -> DataFrame:
    """Rows with the pairs of parts (p <= q) of their slab that they are needed in; ``side``
    tells those of part q from those of part p."""
    cell = ["dim", "block", "slab"]
    sizes = dealt.groupBy(*cell).agg(F.count_if("home").alias("n_home"), F.count(F.lit(1)).alias("n"))
    parts = (sizes.filter("n_home > 0 and n > 1")
             .select(*cell, F.ceil(F.col("n") / spec.part_rows).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least(o, own).alias("p"), F.greatest(o, own).alias("q"), (o < own).alias("side")))
    return (dealt.join(parts, cell).withColumn("meet", F.explode(meets))
            .select(*cell, "meet.p", "meet.q", "meet.side", "home", "node", "copies", "vector"))


def links(vectors: DataFrame, spec: SubspaceSpec = SubspaceSpec(), *, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, for every row."""
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType == T.FloatType() else "<f8"
    rows = vectors.select(F.col(id_col).alias("vec_id"),
                          (F.col(vector_col) if kind == "<f4" else F.col(vector_col).cast("array<double>"))
                          .alias("embedding"))
    good = rows.filter(usable(F.col("embedding")))
    distinct = materialize(
        good.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    dealt = materialize(deal(distinct, kind, spec), "vector-slabs")
    found = materialize(
        paired_parts(dealt, spec).groupBy("dim", "block", "slab", "p", "q")
        .applyInArrow(_join_parts(kind, spec), "node bigint, links bigint, other bigint"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other is not null"), "node", "other")
    nodes = (distinct.join(counts, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    smallest = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = materialize(nodes.join(smallest, "root").select(
        "embedding", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id"), "vector-classes")
    total = distinct.agg(F.sum("copies")).first()[0] or 0
    linked = join_by_key(good, named, ["embedding"], "copies", total).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
