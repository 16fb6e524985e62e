"""Exact k-nearest-neighbour scoring (Euclidean), score = positive share.

Training rows belong to the cell of their nearest pivot (pivots are training rows:
a bounded sample with the least hashes); a cell has a number of rows and a radius.
A query first visits the nearest cells that hold k rows, which bounds its k-th
distance.  By the triangle inequality no row of a cell is nearer than the
distance to its pivot less its radius, so in a second pass the query visits just the
other cells whose bound lies within its k-th distance; queries without such
cells are done.  Cells larger than ``chunk_rows`` are split into parts, parts that fit
``PIVOT_ROWS`` rows together make a slab, and a cell's visitors beyond ``block_rows`` are
split too: a task computes the distances of one block to one slab with matrix products
and returns the k nearest rows per query.  A visit is one row per query and cell, made
and sent a bounded number at a time, whatever the number of parts.  Candidates are
merged in two levels, so a query never holds more than a bounded number of them in one
place and nothing but the pivots and the cells' sizes passes through the driver.
Distances that decide are recomputed from the differences, and equal distances
are broken by ``tid``.  Training rows that fit one chunk are one cell, searched once; if they
are also few numbers (``NUMBERS_AT_ONCE``), they go to the tasks and no query is moved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from revlens.session import materialize

#: Chunks whose candidates are merged at once in the first level.
MERGE_WAYS = 32
#: Rows a pivot has on average, and how many pivots there are at most.
PIVOT_ROWS, MAX_PIVOTS = 8192, 1024
#: Visits made at once, and differences of vectors held at once.
VISITS_AT_ONCE, NUMBERS_AT_ONCE = 8192, 4_000_000


def _squared(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (i, j); many equal distances make many pairs."""
    step = max(1, NUMBERS_AT_ONCE // max(a.shape[1], 1))
    return np.concatenate([((a[i[at:at + step]] - b[j[at:at + step]]) ** 2).sum(axis=1)
                           for at in range(0, max(len(i), 1), step)])


def _nearest(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({c: [] for c in ("qid", "chunk", "d2", "tid", "label")})
        chunk = rows["cell"].iloc[0] * 65_537 + rows["slab"].iloc[0]
        q = np.stack(queries["vec"].to_numpy()).astype(float)
        t = np.stack(rows["vec"].to_numpy()).astype(float)
        tids, labels = rows["tid"].to_numpy(), rows["label"].to_numpy()
        t_sq, found = (t ** 2).sum(axis=1), []
        tile = max(1, NUMBERS_AT_ONCE // len(t))
        for at in range(0, len(q), tile):
            part = q[at:at + tile]
            size = (part ** 2).sum(axis=1)[:, None] + t_sq[None, :]
            d2 = size - 2.0 * part @ t.T
            if len(t) > k:      # keep everything that rounding could put among the k nearest
                limit = np.partition(d2, k - 1, axis=1)[:, k - 1:k]
                i, j = np.nonzero(d2 <= limit + 1e-9 * (1 + size.max(axis=1, keepdims=True)))
            else:
                i, j = np.nonzero(np.ones_like(d2, dtype=bool))
            exact = _squared(part, t, i, j)
            order = np.lexsort((tids[j], exact, i))
            i, j, exact = i[order], j[order], exact[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            best = place < k
            if "kth2" in queries:   # rows beyond the k-th distance so far are not among the k nearest
                best &= ~(exact > queries["kth2"].to_numpy()[at + i])
            found.append(pd.DataFrame({"qid": queries["qid"].to_numpy()[at + i[best]],
                                       "chunk": chunk, "d2": exact[best],
                                       "tid": tids[j[best]], "label": labels[j[best]]}))
        return pd.concat(found)
    return run


def _shares(tids: np.ndarray, t: np.ndarray, labels: np.ndarray, ks: list[int]):
    """Function of queries: the mean label of the k nearest rows, one column per k.

    Distances from the matrix product settle a query where exactly k rows lie within the k-th
    distance and what rounding could add; elsewhere they are recomputed and ties go by tid."""
    t_sq, both = (t ** 2).sum(axis=1), np.column_stack([np.ones(len(t)), labels])
    cuts = sorted({k - 1 for k in ks if k < len(t)})

    def of(q: np.ndarray) -> np.ndarray:
        out = np.full((len(q), len(ks)), labels.mean())
        tile = max(1, NUMBERS_AT_ONCE // len(t))
        for at in range(0, len(q) if cuts else 0, tile):
            part = q[at:at + tile]
            size = (part ** 2).sum(axis=1)[:, None] + t_sq[None, :]
            d2 = size - 2.0 * part @ t.T
            slack = 1e-9 * (1 + size.max(axis=1))
            least = np.partition(d2, cuts, axis=1)[:, cuts]
            for c, k in enumerate(ks):
                if k >= len(t):
                    continue
                reach = least[:, cuts.index(k - 1)] + slack
                n, hits = ((d2 <= reach[:, None]).astype(float) @ both).T
                out[at:at + tile, c] = hits / k
                for i in np.flatnonzero(n != k):
                    near = np.flatnonzero(d2[i] <= reach[i])
                    exact = ((part[i] - t[near]) ** 2).sum(axis=1)
                    out[at + i, c] = labels[near[np.lexsort((tids[near], exact))[:k]]].mean()
        return out
    return of


def small_shares(train: DataFrame, ks: list[int], chunk_rows: int = 65_536):
    """:func:`_shares` of training rows that fit one chunk and ``NUMBERS_AT_ONCE`` numbers, which go to
    the tasks with the function; None for more rows, or for none."""
    n = train.count()
    first = train.select(F.size("vec").alias("width")).first()
    if not n or n > chunk_rows or n * first["width"] > NUMBERS_AT_ONCE:
        return None
    rows = train.select("tid", F.col("vec").cast("array<double>").alias("vec"),
                        F.col("label").cast("double").alias("label")).toPandas()    # bounded by the line above
    return _shares(rows["tid"].to_numpy(), np.stack(rows["vec"].to_numpy()).astype(float), rows["label"].to_numpy(), ks)


class Cells:
    """Pivots with the number of rows, the radius and the number of parts of their cells."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.n = self.radius = self.parts = np.zeros(0)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        size = (vectors ** 2).sum(axis=1)[:, None] + (self.pivots ** 2).sum(axis=1)[None, :]
        return np.sqrt(np.maximum(size - 2.0 * vectors @ self.pivots.T, 0))

    def margin(self, vectors: np.ndarray) -> float:
        """More than rounding can add to a distance."""
        return 1e-6 * (1 + np.sqrt((vectors ** 2).sum(axis=1).max(initial=0) + (self.pivots ** 2).sum(axis=1).max(initial=0)))

    def nearest(self, away: np.ndarray, k: int) -> np.ndarray:
        """Which cells hold the first k rows, by distance to their pivots."""
        order = np.argsort(away, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        first = np.zeros_like(away, dtype=bool)
        np.put_along_axis(first, order, before < k, axis=1)
        return first & (self.n > 0)


def _assign(cells: Cells):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                away = cells.distances(np.stack(pdf["vec"].to_numpy()).astype(float))
                cell = away.argmin(axis=1)
                yield pdf.assign(cell=cell, away=away[np.arange(len(cell)), cell])
    return run


def _visits(cells: Cells, k: int):
    """Rows (query, cell, k-th squared distance so far): the first cells, or, given that distance,
    the others that may hold nearer rows."""
    def run(batches):
        step = max(1, VISITS_AT_ONCE // max(len(cells.pivots), 1))      # a query may visit all cells
        for pdf in batches:
            for at in range(0, len(pdf), step):
                some = pdf.iloc[at:at + step]
                x = np.stack(some["vec"].to_numpy()).astype(float)
                away = cells.distances(x)
                use = cells.nearest(away, k)
                kth2 = some["kth2"].to_numpy() if "kth2" in some else np.full(len(some), np.inf)
                if "kth" in some:
                    reach = some["kth"].to_numpy()[:, None] + cells.margin(x)
                    use = ~use & (cells.n > 0) & (away - cells.radius <= reach)
                q, c = np.nonzero(use)
                yield pd.DataFrame({"qid": some["qid"].to_numpy()[q], "vec": some["vec"].to_numpy()[q], "cell": c,
                                    "kth2": kth2[q]})
    return run


def _search(visits: DataFrame, rows: DataFrame, slabs, k: int, block_rows: int) -> DataFrame:
    """(qid, chunk, d2, tid, label): the k nearest rows of each slab of the visited cells."""
    sizes = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    copies = sizes.select("cell", F.col("blocks").alias("copies"))
    here = rows.join(copies, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    asked = (visits.join(sizes, "cell")
             .withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int"))
             .withColumn("slab", F.explode(F.sequence(F.lit(0), slabs - 1))))
    keys = ["cell", "slab", "block"]
    return asked.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(
        _nearest(k), "qid long, chunk long, d2 double, tid long, label double")


def _merged(near: DataFrame, k: int) -> DataFrame:
    """(qid, nn): the k nearest of all candidates, merged in two levels."""
    def nearest(items):
        return F.slice(F.array_sort(items), 1, k)

    some = near.groupBy("qid", F.pmod(F.xxhash64("chunk"), F.lit(MERGE_WAYS)).alias("part")).agg(
        nearest(F.collect_list(F.struct("d2", "tid", "label"))).alias("nn"))
    return some.groupBy("qid").agg(nearest(F.flatten(F.collect_list("nn"))).alias("nn"))


class Search:
    """The visits and neighbours of a k-nearest-neighbour search."""

    def __init__(self, train: DataFrame, query: DataFrame, k: int, block_rows: int, chunk_rows: int,
                 pivots: int | None):
        t = train.select("tid", F.col("vec").cast("array<double>").alias("vec"),
                         F.col("label").cast("double").alias("label"))
        self.n, self.k = t.count(), k
        if not self.n:
            return
        p = pivots or min(MAX_PIVOTS, -(-self.n // PIVOT_ROWS) if self.n > chunk_rows else 1)
        found = t.orderBy(F.xxhash64("tid"), "tid").limit(max(p, 1)).select("vec").collect()
        self.cells = Cells(np.unique(np.array([r["vec"] for r in found], float).reshape(len(found), -1), axis=0))
        rows = materialize(t.mapInPandas(_assign(self.cells), "tid long, vec array<double>, label double, "
                                                              "cell int, away double"), "knn-cells")
        stats = {r["cell"]: r for r in rows.groupBy("cell").agg(      # one row per pivot
            F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()}
        each = range(len(self.cells.pivots))
        self.cells.n = np.array([stats[c]["n"] if c in stats else 0 for c in each])
        self.cells.radius = np.array([stats[c]["radius"] if c in stats else 0.0 for c in each])
        self.cells.parts = -(-self.cells.n // chunk_rows)
        together = max(1, PIVOT_ROWS // chunk_rows)       # parts of a slab

        def of_cell(numbers):
            return F.element_at(F.array(*[F.lit(int(max(x, 1))) for x in numbers]), F.col("cell") + 1)

        part = F.pmod(F.xxhash64("tid"), of_cell(self.cells.parts)).cast("int")
        self.rows = rows.withColumn("part", part).withColumn("slab", F.floor(F.col("part") / together).cast("int"))
        self.slabs = of_cell(-(-self.cells.parts // together))
        self.query = query.select("qid", F.col("vec").cast("array<double>").alias("vec"))
        self.block_rows = block_rows

    def neighbours(self) -> DataFrame:
        """(qid, nn): arrays of (d2, tid, label) in order of distance and tid."""
        schema = "qid long, vec array<double>, cell int, kth2 double"
        self.first = materialize(self.query.mapInPandas(_visits(self.cells, self.k), schema), "knn-visits")
        near = materialize(_merged(_search(self.first, self.rows, self.slabs, self.k, self.block_rows), self.k), "knn-near")
        kth = near.select("qid", F.element_at("nn", -1)["d2"].alias("kth2")).withColumn("kth", F.sqrt("kth2"))
        self.second = materialize(self.query.join(kth, "qid").mapInPandas(_visits(self.cells, self.k), schema),
                                  "knn-visits")
        more = _merged(_search(self.second, self.rows, self.slabs, self.k, self.block_rows), self.k)
        both = near.unionByName(more).groupBy("qid").agg(F.flatten(F.collect_list("nn")).alias("nn"))
        return both.select("qid", F.slice(F.array_sort("nn"), 1, self.k).alias("nn"))

    def distances(self) -> int:
        """Distances that :meth:`neighbours` computed."""
        sizes = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        visits = self.first.select("cell").unionByName(self.second.select("cell"))
        return visits.join(sizes, "cell").agg(F.sum("n")).first()[0] or 0

    def scores_of_one_cell(self, ks: list[int]) -> DataFrame:
        """(qid, k, score) where all rows are in one chunk: no candidates need merging."""
        schema = "qid long, k int, score double"

        def listed(queries: pd.DataFrame, shares) -> pd.DataFrame:
            got = shares(np.stack(queries["vec"].to_numpy()).astype(float))
            return pd.DataFrame({"qid": np.repeat(queries["qid"].to_numpy(), len(ks)),
                                 "k": np.tile(ks, len(queries)), "score": got.ravel()})

        small = small_shares(self.rows, ks)
        if small is not None:
            return self.query.mapInPandas(lambda batches: (listed(q, small) for q in batches if len(q)), schema)

        def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if queries.empty or rows.empty:
                return pd.DataFrame({c: [] for c in ("qid", "k", "score")})
            return listed(queries, _shares(rows["tid"].to_numpy(), np.stack(rows["vec"].to_numpy()).astype(float),
                                           rows["label"].to_numpy(), ks))

        visits = self.query.withColumn("cell", F.lit(0))
        sizes = max(1, -(-self.query.count() // self.block_rows))
        asked = visits.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(sizes)).cast("int"))
        here = self.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(sizes - 1))))
        return asked.groupBy("block").cogroup(here.groupBy("block")).applyInPandas(
            run, schema)


def knn_scores(train: DataFrame, query: DataFrame, k: int | list[int] = 25, block_rows: int = 4096,
               chunk_rows: int = 65_536, pivots: int | None = None) -> DataFrame:
    """``train``: (tid, vec array<double>, label 0/1); ``query``: (qid, vec).
    Returns (qid, score) with score = mean label of the k nearest training
    rows (distance ties broken by tid), or (qid, k, score) for a list of numbers of
    neighbours; no training rows, no result rows."""
    ks = [k] if isinstance(k, int) else list(k)
    search = Search(train, query, max(ks), block_rows, chunk_rows, pivots)
    if not search.n:
        return query.sparkSession.createDataFrame([], "qid long, score double" if isinstance(k, int)
                                                  else "qid long, k int, score double")
    if search.cells.parts.sum() == 1:
        out = search.scores_of_one_cell(ks)
    else:
        found = search.neighbours()

        def mean(n):
            some = F.slice("nn", 1, n)
            return F.aggregate(some, F.lit(0.0), lambda acc, x: acc + x["label"]) / F.size(some)

        out = found.select("qid", F.explode(F.array(*[F.struct(F.lit(n).alias("k"), mean(n).alias("score"))
                                                      for n in ks])).alias("s")).select("qid", "s.k", "s.score")
    return out.select("qid", "score") if isinstance(k, int) else out


class KNNModel(Model):
    """Scores rows against the kept training vectors: row by row where these are few, else by
    :func:`knn_scores`, whose scores are joined back by the place of the written rows (ids may repeat)."""

    def __init__(self, train: DataFrame, k: int, id_col: str, features_col: str,
                 block_rows: int):
        super().__init__()
        self.train, self.k, self.id_col = train, k, id_col
        self.features_col, self.block_rows = features_col, block_rows

    def _transform(self, df: DataFrame) -> DataFrame:
        shares = small_shares(self.train, [self.k])
        if shares is not None:
            @F.pandas_udf("double")
            def share(x: pd.Series) -> pd.Series:
                return pd.Series(shares(np.stack(x.to_numpy()).astype(float))[:, 0] if len(x) else [], dtype=float)

            out = df.withColumn("score", share(vector_to_array(self.features_col)))
        else:
            rows = materialize(df.withColumn("__place", F.monotonically_increasing_id()), "knn-queries")
            query = rows.select(F.col("__place").alias("qid"), vector_to_array(self.features_col).alias("vec"))
            s = knn_scores(self.train, query, self.k, self.block_rows)
            out = rows.join(s.withColumnRenamed("qid", "__place"), "__place", "left").drop("__place")
        return out.withColumns({
            "probability": array_to_vector(F.array(1 - F.col("score"), F.col("score"))),
            "prediction": (F.col("score") >= 0.5).cast("double")}).drop("score")


class KNNClassifier(Estimator):
    """Pipeline stage: ``fit`` materializes the assembled training vectors in
    the shared checkpoint folder; the model scores by exact k-NN."""

    def __init__(self, k: int = 25, idCol: str = "id", featuresCol: str = "features",
                 labelCol: str = "satisfied", blockRows: int = 4096):
        super().__init__()
        self.k, self.id_col, self.features_col = k, idCol, featuresCol
        self.label_col, self.block_rows = labelCol, blockRows

    def _fit(self, df: DataFrame) -> KNNModel:
        train = materialize(df.select(F.col(self.id_col).alias("tid"),
                                      vector_to_array(self.features_col).alias("vec"),
                                      F.col(self.label_col).alias("label")), "knn-train")
        return KNNModel(train, self.k, self.id_col, self.features_col, self.block_rows)
