"""Language-model scoring with a probabilistic suffix tree over bytes.

Symbols are the bytes of the text with A-Z lower-cased, then one end.  A context
is the run of bytes before a symbol (with a start mark at the text's start).

Learning, over all training documents: tasks count runs of ``depth`` + 1 symbols,
Spark adds them up and derives every shorter context.  A context that occurs
``min_count`` times is retained if its next-symbol distribution diverges from that
of the next shorter context: number x KL divergence >= ``evidence`` nats for each
different symbol that follows (a likelihood-ratio test).  Both are absolute, so the
more text there is, the more contexts are retained.  Suffixes of retained contexts
are retained, so the tree is closed.  Distributions are smoothed towards the next
shorter context's, the empty context's towards equal shares, with ``smoothing``
pseudo-counts for each different symbol that follows the context (Witten-Bell, for 1).

The tree is a table of contexts in the shared folder.  Contexts that hold at least
``min_share`` of all symbols are at most 1/min_share a depth whatever the corpus:
this top is broadcast, with a mark for each retained context just below it.

Scoring: each symbol is predicted by the longest retained suffix before it; a text's
score is the sum of log10 probabilities.  Tasks walk the top; symbols whose suffix
leads below it are looked up: their different runs are joined with the table, once
for all texts, and each text is joined with what its runs gain.

Beside it, the unigram base over words: tokens are words (free of ASCII white
space) and one end.  Tokens with at least ``frequent_share`` of all are at most
1/frequent_share and are looked up map-side, so no hot token is shuffled; the
rest are joined by token.

Defined results: null text counts as empty (one end token); without training
documents N and V are 0, no token is known and all symbols are equally likely;
repeated rows count and each get a result; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialize

#: Bytes that never occur in UTF-8 stand for the start and the end of a text.
START, END = 0xFE, 0xFF
END_TOKEN = ""  # words are never empty


@dataclass(frozen=True)
class TreeSpec:
    depth: int = 5
    min_share: float = 2e-6
    min_count: int = 8
    evidence: float = 2.0
    smoothing: float = 1.0
    frequent_share: float = 2e-6


def _slices(batches, rows: int = 512):
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each with its end mark, and symbols per text."""
    lower = pc.ascii_lower(texts).cast(pa.binary())
    raw = pc.binary_join_element_wise(lower, pa.scalar(bytes([END])), pa.scalar(b""))
    sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
    return data, sizes


def earlier(data: np.ndarray, sizes: np.ndarray, back: int) -> np.ndarray:
    """The symbol ``back`` places before each, the start mark where the text begins."""
    out = np.full(len(data), START, np.uint8)
    out[back:] = data[:len(data) - back]
    begin = np.cumsum(sizes) - sizes
    for step in range(min(back, int(sizes.max()) if len(sizes) else 0)):
        at = begin[sizes > step] + step
        out[at] = START
    return out


def count_runs(texts: DataFrame, spec: TreeSpec) -> DataFrame:
    """code, n: runs of depth + 1 symbols; the low byte is the symbol, the next ones its context."""
    def run(batches):
        codes, counts, held = [], [], 0
        for part in _slices(batches):
            data, sizes = symbols(part.column(0))
            code = data.astype(np.int64)
            for back in range(1, spec.depth + 1):
                code |= earlier(data, sizes, back).astype(np.int64) << (8 * back)
            u, n = np.unique(code, return_counts=True)
            codes.append(u)
            counts.append(n)
            held += len(u)
            if held > 3_000_000:  # bounds a task's memory; Spark adds up what leaves
                codes, counts = _merged(codes, counts)
                held = len(codes[0])
                if held > 1_500_000:
                    yield _runs(codes[0], counts[0])
                    codes, counts, held = [], [], 0
        if codes:
            codes, counts = _merged(codes, counts)
            yield _runs(codes[0], counts[0])

    return (texts.mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")))


def _merged(codes, counts):
    every, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every)
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return [every[first]], [np.add.reduceat(n, first)]


def _runs(codes, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())],
                                      names=["code", "n"])


def shorter(depth: str = "depth") -> Column:
    """The context without its farthest byte."""
    return F.expr(f"context & (shiftleft(1L, 8 * ({depth} - 1)) - 1)")


def retained(runs: DataFrame, spec: TreeSpec) -> DataFrame:
    """The tree: (depth, context, total, nexts) of the retained contexts; ``nexts`` lists
    the symbols that follow and their numbers."""
    levels = {}
    table = runs.select(F.shiftrightunsigned("code", 8).alias("context"),
                        F.expr("code & 255").alias("symbol"), "n")
    for depth in range(spec.depth, -1, -1):
        if depth < spec.depth:
            table = (levels[depth + 1].select(shorter(str(depth + 1)).alias("context"), "symbol", "n")
                     .groupBy("context", "symbol").agg(F.sum("n").alias("n")))
        levels[depth] = table = materialize(table, f"tree-runs-{depth}")
    sums = {d: t.groupBy("context").agg(F.sum("n").alias("total")) for d, t in levels.items()}
    keep, out = None, []

    def listed(depth, rows):
        return rows.groupBy("context").agg(
            F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("nexts")).select(
            F.lit(depth).alias("depth"), "context", "total", "nexts")

    for depth in range(spec.depth, 0, -1):
        parent = shorter(str(depth))
        here = (levels[depth].join(sums[depth].filter(F.col("total") >= spec.min_count), "context")
                .withColumn("parent", parent))
        above = (levels[depth - 1].join(sums[depth - 1], "context")
                 .select(F.col("context").alias("parent"), "symbol",
                         (F.col("n") / F.col("total")).alias("above")))
        nats = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("above")))
        tested = (here.join(above, ["parent", "symbol"]).groupBy("context")
                  .agg(nats.alias("nats"), F.count(F.lit(1)).alias("symbols"))
                  .filter(F.col("nats") >= spec.evidence * F.col("symbols")).select("context"))
        keep = materialize(tested if keep is None else tested.unionByName(keep).distinct(), f"tree-kept-{depth}")
        out.append(listed(depth, levels[depth].join(keep, "context")))
        keep = keep.select(parent.alias("context")).distinct()
    model = listed(0, levels[0])
    for part in out:
        model = model.unionByName(part)
    return materialize(model, "tree-contexts")


@dataclass
class Tree:
    symbol: np.ndarray  # byte -> column
    #: node (the deepest left out), column -> node of the context one byte longer
    #: (0: none, BELOW: only in the table)
    child: np.ndarray
    logp: np.ndarray  # node, column -> log10 probability of the next symbol


BELOW = -1


def top_of(tree: DataFrame, spec: TreeSpec) -> tuple[Tree, DataFrame]:
    """The broadcast top, and the table of the contexts below it."""
    total = tree.filter("depth = 0").agg(F.max("total")).first()[0] or 0
    frequent = F.col("total") >= spec.min_share * total
    top, deep = tree.filter(frequent), tree.filter(~frequent)
    rows = top.select("depth", "context", F.explode("nexts").alias("e")).select(
        F.col("depth").cast("short"), "context", F.col("e.symbol").cast("short").alias("symbol"), "e.n")
    # contexts just below the top: at most one for each node and byte
    edge = deep.withColumn("up", shorter()).join(
        top.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("up")), ["depth", "up"])
    return build(_columns(rows), _columns(edge.select(F.col("depth").cast("short"), "context")), spec), deep


def _columns(rows: DataFrame) -> dict[str, np.ndarray]:
    table = rows.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def build(rows, below, spec: TreeSpec) -> Tree:
    """The top from (depth, context, symbol, n) and the (depth, context) just below it; node 0
    is dead, node 1 the empty context."""
    seen = np.unique(np.append(rows["symbol"], [START, END])).astype(np.int64)
    column = np.zeros(256, np.int64)  # column 0: every symbol that was never seen
    column[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1

    def key(depth, context):  # contexts have up to 7 bytes
        return depth.astype(np.int64) << 56 | context

    def above(keys):
        """The node of each context without its farthest byte, and that byte's column."""
        shift = 8 * ((keys >> 56) - 1)
        context = keys & ((1 << 56) - 1)
        up = (keys >> 56) - 1 << 56 | context & ((1 << shift) - 1)
        return np.searchsorted(listed, up) + 1, column[context >> shift & 255]

    own = key(rows["depth"], rows["context"])
    listed = np.unique(np.append(own, 0))  # shorter contexts first
    nodes = np.searchsorted(listed, own) + 1
    level = np.append(0, listed >> 56)
    size = len(level)
    parents = np.ones(size, np.int64)
    child = np.zeros((max(2, np.searchsorted(level, spec.depth)), width), np.int32)
    parents[2:], byte = above(listed[1:])
    child[parents[2:], byte] = np.arange(2, size)
    child[above(key(below["depth"], below["context"]))] = BELOW
    n, symbol = rows["n"].astype(np.float64), column[rows["symbol"]]
    pseudo = spec.smoothing * np.maximum(np.bincount(nodes, minlength=size), 1)
    total = np.bincount(nodes, n, size) + pseudo
    share = np.zeros((size, width), np.float32)
    share[nodes, symbol] = n / total[nodes]
    share[1] += pseudo[1] / 255 / total[1]  # any byte but the start mark
    rest = (pseudo / total).astype(np.float32)[:, None]
    for depth in range(1, spec.depth + 1):
        start, stop = np.searchsorted(level[2:], [depth, depth + 1]) + 2
        for at in range(start, stop, 4096):  # parents come first
            part = slice(at, min(at + 4096, stop))
            share[part] += rest[part] * share[parents[part]]
    share[0] = 1
    return Tree(column, child, np.log10(share, out=share))


def walk(tree: Tree, before: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per symbol: the node of its longest suffix in the top, its depth, and whether the tree goes on
    below; ``before`` lists the symbols one, two, ... places earlier."""
    size = len(before[0])
    node = best = np.ones(size, np.int64)
    deep, depth = np.zeros(size, bool), np.zeros(size, np.int8)
    for back, prior in enumerate(before, 1):
        node = tree.child[node, tree.symbol[prior]]
        deep |= node == BELOW
        node = np.maximum(node, 0)
        best = np.where(node > 0, node, best)
        depth[node > 0] = back
    return best, depth, deep


def tree_scores(tree: Tree, data: np.ndarray, sizes: np.ndarray, depth: int):
    """Per text: its score by the top; and runs that lead below it: (text, code, times)."""
    if not len(sizes):
        return np.zeros(0), (np.zeros(0, np.int64),) * 3
    before = [earlier(data, sizes, back) for back in range(1, depth + 1)]
    best, _, deep = walk(tree, before)
    logp = tree.logp[best, tree.symbol[data]].astype(np.float64)
    at = np.flatnonzero(deep)
    code = data[at].astype(np.int64)
    for back, prior in enumerate(before, 1):
        code |= prior[at].astype(np.int64) << (8 * back)
    text = np.searchsorted(np.cumsum(sizes), at, side="right")
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    first = np.ones(len(at), bool)
    first[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(first)
    times = np.diff(np.append(start, len(at)))
    return np.add.reduceat(logp, np.cumsum(sizes) - sizes), (text[start], code[start], times)


def deep_gains(codes: DataFrame, shared, deep: DataFrame, spec: TreeSpec) -> DataFrame:
    """(code, gain): what the contexts below the top add to log10 of the run's probability."""
    def run(batches):
        tree = shared.value[0]
        for batch in batches:
            code = batch.column(0).to_numpy()
            byte = [(code >> (8 * k) & 255).astype(np.uint8) for k in range(spec.depth + 1)]
            best, depth, _ = walk(tree, byte[1:])
            top = 10.0 ** tree.logp[best, tree.symbol[byte[0]]].astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(depth.astype(np.int32)), pa.array(top)],
                                             names=["code", "reached", "top"])

    placed = codes.mapInArrow(run, "code bigint, reached int, top double")
    each = placed.withColumn("depth", F.explode(F.sequence(F.col("reached") + 1, F.lit(spec.depth)))).select(
        "code", "top", "depth", F.expr("code & 255").alias("symbol"),
        F.expr("shiftrightunsigned(code, 8) & (shiftleft(1L, 8 * depth) - 1)").alias("context"))
    n = F.get(F.filter("nexts", lambda e: e["symbol"] == F.col("symbol")), 0)["n"]
    step = F.struct("depth", F.coalesce(n, F.lit(0)).alias("n"), "total",
                    (spec.smoothing * F.size("nexts")).alias("pseudo"))
    chain = (each.join(deep, ["depth", "context"]).groupBy("code", "top")
             .agg(F.array_sort(F.collect_list(step)).alias("chain")))
    share = F.aggregate("chain", F.col("top"), lambda up, x: (x["n"] + x["pseudo"] * up) / (x["total"] + x["pseudo"]))
    return chain.select("code", (F.log10(share) - F.log10("top")).alias("gain"))


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(tokens by dictionary, their indices, the text of each); ends are not included."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    empty = pc.index(coded.dictionary, pa.scalar("")).as_py()  # splitting leaves '' at the ends
    keep = index != empty
    return coded, index[keep], owner[keep]


def count_words(texts: DataFrame) -> DataFrame:
    """token, n over all rows, the end token with them."""
    def run(batches):
        for batch in batches:
            for part in _slices([batch], 4096):
                coded, index, _ = words(part.column(0))
                n = np.bincount(index, minlength=len(coded.dictionary))
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([coded.dictionary.take(pa.array(used)), pa.array([END_TOKEN])]),
                     pa.array(np.append(n[used], part.num_rows), pa.int64())], names=["token", "n"])

    return texts.mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    tree: Tree
    deep: DataFrame  # depth, context, total, nexts of the contexts below the top
    frequent: dict  # token -> count
    counts: DataFrame  # token, n
    n_tokens: int
    n_distinct: int


def fit(texts: DataFrame, spec: TreeSpec = TreeSpec()) -> Model:
    """Learns from a table with the one column ``text`` (no nulls)."""
    tree, deep = top_of(retained(materialize(count_runs(texts, spec), "tree-runs"), spec), spec)
    counts = materialize(count_words(texts), "tree-words")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    often = counts.filter(F.col("n") >= spec.frequent_share * total).toPandas()  # at most 1/frequent_share
    return Model(tree, deep, dict(zip(often["token"].tolist(), often["n"].tolist())), counts, total,
                 distinct)


def score(docs: DataFrame, model: Model, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.tree, model.frequent))
    rare_type = pa.list_(pa.struct([("token", pa.string()), ("times", pa.int64())]))
    deep_type = pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())]))

    def run(batches):
        tree, frequent = shared.value
        for part in _slices(batches):
            data, sizes = symbols(part.column(1))
            coded, index, owner = words(part.column(1))
            size = max(len(coded.dictionary), 1)
            pair, times = np.unique(owner * size + index, return_counts=True)
            who, code = pair // size, pair % size
            known = np.array([frequent.get(t, 0) for t in coded.dictionary.to_pylist()] or [0], np.float64)
            n = known[code]
            end = frequent.get(END_TOKEN, 0)
            base = np.bincount(who, times * np.where(n > 0, np.log10(n + 0.5), 0), part.num_rows)
            often = np.bincount(who, times * (n > 0), part.num_rows)
            if end:
                base, often = base + math.log10(end + 0.5), often + 1
            rare = n == 0
            tokens = coded.dictionary.take(pa.array(code[rare]))
            counted = pa.array(times[rare], pa.int64())
            if not end:  # too rare to be listed (or never seen): joined like any token
                tokens = pa.concat_arrays([tokens, pa.array([END_TOKEN] * part.num_rows, pa.string())])
                counted = pa.concat_arrays([counted, pa.array([1] * part.num_rows, pa.int64())])
                holder = np.concatenate([who[rare], np.arange(part.num_rows)])
                order = np.argsort(holder, kind="stable")
                tokens, counted = tokens.take(pa.array(order)), counted.take(pa.array(order))
                holder = holder[order]
            else:
                holder = who[rare]
            offsets = np.searchsorted(holder, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                [tokens, counted], fields=list(rare_type.value_type)))
            by_top, (text, run_code, run_times) = tree_scores(tree, data, sizes, spec.depth)
            deep = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(run_code), pa.array(run_times)],
                                           fields=list(deep_type.value_type)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.bincount(owner, minlength=part.num_rows) + 1, pa.int64()),
                 pa.array(often.astype(np.int64)), pa.array(base),
                 pa.array(by_top), lists, deep],
                names=["doc_id", "n_tokens", "often", "base", "score", "rare", "deep"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = materialize(
        rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, often bigint, base double, score double, "
                             "rare array<struct<token:string,times:bigint>>, "
                             "deep array<struct<code:bigint,times:bigint>>")
        .withColumn("row", F.monotonically_increasing_id()), "tree-scored")
    looked_up = (scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.times")
                 .join(model.counts.hint("shuffle_hash"), "token", "left"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    sums = looked_up.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_base"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    below = scored.select("row", F.explode("deep").alias("d")).select("row", "d.code", "d.times")
    gains = materialize(deep_gains(below.select("code").distinct(), shared, model.deep, spec), "tree-gains")
    added = below.join(gains.hint("shuffle_hash"), "code").groupBy("row").agg(
        F.sum(F.col("times") * F.col("gain")).alias("added"))
    scale = math.log10(model.n_tokens + 0.5 * (model.n_distinct + 1))
    return scored.drop("rare", "deep").join(sums, "row", "left").join(added, "row", "left").select(
        "doc_id", "n_tokens", (F.col("often") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"))
