"""Source divergence audit with duplicate texts collapsed.

Identical texts of a lang are collapsed to one, with the number of rows of every
source that holds it; that text is tokenized once and its term counts and document
frequency are weighted by those numbers.  A lang keeps the terms in at least
``min_docs`` of its documents.  Every (lang, source) group gives each kept term
``p = 1 + floor(scale * (count + add) / (N + add * V))`` (N: its occurrences of
kept terms, V: kept terms), and so does each lang.  All arithmetic is on integers.

Groups are compared pairwise without visiting the terms that neither holds.  With
p0 a group's p of a term it doesn't hold and d0 = |p0_s - p0_t|,

    sum |p_s - p_t| = V d0 + (A(s,t) - n_s d0) + (A(t,s) - n_t d0) + C(s,t)

A(s,t), the sum of |p_s - p0_t| over the n_s terms of s, needs only the histogram of
s's counts.  C corrects the terms that both hold; tasks add it up on blocks of
terms times blocks of sources, and return one number per pair of sources.

Defined results: null text, lang and source count as empty strings; a lang without
kept terms has pairs of value 0 and no terms; groups without terms are compared
like others; a source alone in its lang has no pairs; repeated rows and ids count
as separate documents; an empty table gives an empty result; other columns are
ignored.  Texts may be of any length (tokens are read in pieces); texts are
taken as identical when their sha256 is.  A task's counts are passed on whenever
``flush_terms`` are held.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import join_by_key, materialize

#: Terms and what parts them, over UTF-8: every byte of a non-ASCII character is above 0x7F.
TERMS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


@dataclass(frozen=True)
class AuditSpec:
    min_docs: int = 30
    add: int = 5
    scale: int = 1_000_000_000
    top_terms: int = 50
    flush_terms: int = 400_000
    piece_bytes: int = 1 << 20
    block_rows: int = 1 << 18   # counts in a block of terms, on average
    block_sources: int = 128


def collapsed(docs: DataFrame) -> DataFrame:
    """One row per lang and text: lang, text, uses (its sources, with their rows)."""
    rows = docs.withColumn("digest", F.sha2("text", 256))
    uses = (rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("uses")))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(uses, ["lang", "digest"]).select("lang", "text", "uses")


def terms(text: bytes, limit: int):
    """Lists of the terms of a UTF-8 text, cut between terms; only A-Z is lower-cased."""
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + limit) if len(text) - at > limit else None
        stop = cut.end() if cut else len(text)
        yield TERMS.findall(text[at:stop].lower())
        at = stop


def term_counts(texts: DataFrame, spec: AuditSpec) -> DataFrame:
    """lang, term, sources, counts: weighted occurrences in each source; beside the null
    source, the documents of the lang that hold the term.  A term may have several rows."""
    def run(batches):
        held: dict[tuple, Counter] = {}

        def passed_on():
            for lang in {lang for lang, _ in held}:
                mine = [(source, counts) for (other, source), counts in held.items() if other == lang]
                flat = pa.table({
                    "term": pa.array([t for _, counts in mine for t in counts], pa.string()),
                    "sources": pa.chunked_array([pa.array([source] * len(counts), pa.string())
                                                 for source, counts in mine]),
                    "counts": pa.array([n for _, counts in mine for n in counts.values()], pa.int64())})
                by_term = flat.group_by("term", use_threads=False).aggregate([("sources", "list"), ("counts", "list")])
                for some in by_term.to_batches(max_chunksize=20_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * some.num_rows, pa.string()), some.column("term"),
                         some.column("sources_list"), some.column("counts_list")],
                        names=["lang", "term", "sources", "counts"])
            held.clear()

        size = 0
        for batch in batches:
            for row in range(batch.num_rows):
                lang, text, uses = (batch.column(c)[row].as_py() for c in range(3))
                found = Counter()
                for some in terms(text, spec.piece_bytes):
                    found.update(some)
                copies = sum(u["n"] for u in uses)
                for source, n in [(None, 0), *((u["source"], u["n"]) for u in uses)]:
                    into = held.get((lang, source))
                    if into is None:
                        into = held[lang, source] = Counter()
                    before = len(into)
                    if source is None:
                        if copies == 1:
                            into.update(found.keys())
                        else:
                            for term in found:
                                into[term] += copies
                    elif n == 1:
                        into.update(found)
                    else:
                        for term, c in found.items():
                            into[term] += c * n
                    size += len(into) - before
                    if size >= spec.flush_terms:
                        yield from passed_on()
                        size = 0
        yield from passed_on()

    return texts.select("lang", F.col("text").cast("binary"), "uses").mapInArrow(run, "lang string, term string, sources array<string>, "
                                                                               "counts array<bigint>")


def kept_terms(texts: DataFrame, spec: AuditSpec) -> DataFrame:
    """lang, term, in_lang, each (array of source and n) of the terms in enough documents.
    One shuffle by term serves all steps."""
    found = (term_counts(texts, spec).repartition("lang", "term")
             .select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
             .select("lang", "term", F.col("e.sources").alias("source"), F.col("e.counts").alias("n")))
    sums = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    own = F.col("source").isNotNull()
    by_term = sums.groupBy("lang", "term").agg(
        F.sum(F.when(~own, F.col("n"))).alias("docs"), F.sum(F.when(own, F.col("n"))).alias("in_lang"),
        F.collect_list(F.when(own, F.struct("source", "n"))).alias("each"))
    return by_term.filter(F.col("docs") >= spec.min_docs).select("lang", "term", "in_lang", "each")


def share(count: Column, total: Column, kept: Column, spec: AuditSpec) -> Column:
    """1 + floor(scale * (count + add) / (total + add * kept)), exact."""
    wide = "decimal(19,0)"
    return 1 + F.call_function("div", F.lit(spec.scale).cast("decimal(10,0)") * (count + spec.add).cast(wide),
                               (total + spec.add * kept).cast(wide))


def audit(documents: DataFrame, spec: AuditSpec = AuditSpec(), *, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank; see the module."""
    def read(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = documents.select(read(text_col).alias("text"), read(lang_col).alias("lang"),
                            read(source_col).alias("source"))
    kept = materialize(kept_terms(collapsed(docs), spec).withColumn("term_id", F.monotonically_increasing_id()),
                       "kept-terms")
    cells = kept.select("lang", "term", "term_id", "in_lang", F.explode("each").alias("e")).select(
        "lang", "e.source", "term", "term_id", "e.n", "in_lang")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_n"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("held"))
    zero = F.lit(0).cast("bigint")
    groups = (docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_n", "group_n", "held")]))
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("group_n"), F.col("v"), spec))
                               .otherwise(zero))
    groups = materialize(groups.withColumn("place", F.row_number().over(
        Window.partitionBy("lang").orderBy("source")) - 1), "source-groups")
    total = groups.agg(F.sum("held")).first()[0] or 0
    given = join_by_key(cells, groups.withColumnRenamed("held", "rows"), ["lang", "source"], "rows", total)
    given = materialize(given.select("lang", "source", "place", "term", "term_id", "in_lang", "lang_n", "v", "p0",
                                     share(F.col("n"), F.col("group_n"), F.col("v"), spec).alias("p")),
                        "kept-shares")
    both = pair_values(given, groups, total, spec).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value",
        F.row_number().over(_by_value("other")).alias("rank"))
    return both.unionByName(top_terms(given, spec))


def _by_value(item: str):
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)


def top_terms(given: DataFrame, spec: AuditSpec) -> DataFrame:
    """The terms that a group uses more than its lang does, by the difference."""
    q = share(F.col("in_lang"), F.col("lang_n"), F.col("v"), spec)
    over = given.withColumn("value", F.col("p") - q).filter("value > 0")
    return (over.withColumn("rank", F.row_number().over(_by_value("term"))).filter(F.col("rank") <= spec.top_terms)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def pair_values(given: DataFrame, groups: DataFrame, total: int, spec: AuditSpec) -> DataFrame:
    """lang, source, other, value for each ordered pair of a lang's sources."""
    shares = given.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    hist = shares.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "terms")).alias("hist"))
    one = groups.join(hist, ["lang", "source"], "left").select("lang", "source", "place", "v", "held", "p0", "hist")
    two = groups.select("lang", F.col("source").alias("other"), F.col("place").alias("other_place"),
                        F.col("held").alias("other_held"), F.col("p0").alias("other_p0"))
    apart = F.abs(F.col("p0") - F.col("other_p0"))
    zero = F.lit(0).cast("bigint")
    own = F.aggregate(F.coalesce("hist", F.array().cast("array<struct<p:bigint,terms:bigint>>")), zero,
                      lambda s, x: s + x["terms"] * F.abs(x["p"] - F.col("other_p0")))
    ordered = materialize(one.join(two, "lang").filter("place <> other_place").select(
        "lang", "source", "other", F.least("place", "other_place").alias("a"),
        F.greatest("place", "other_place").alias("b"), "place",
        (own - F.col("held") * apart).alias("own"), (F.col("v") * apart).alias("base")), "source-pairs")
    swapped = ordered.select("lang", F.col("source").alias("other"), F.col("other").alias("source"),
                             F.col("own").alias("other_own"))
    shared = shared_terms(given, total, spec)
    return (ordered.join(swapped, ["lang", "source", "other"]).join(shared, ["lang", "a", "b"], "left")
            .select("lang", "source", "other", (F.col("base") + F.col("own") + F.col("other_own")
                                                + F.coalesce("shared", zero)).alias("value")))


def shared_terms(given: DataFrame, total: int, spec: AuditSpec) -> DataFrame:
    """lang, a, b, shared: the correction C for places a < b that hold terms in common."""
    blocks = max(1, -(-total // spec.block_rows))
    side = F.floor(F.col("place") / spec.block_sources).cast("int")
    last = F.floor((F.col("sources") - 1) / spec.block_sources).cast("int")
    sources = given.groupBy("lang").agg((F.max("place") + 1).alias("sources"), F.count(F.lit(1)).alias("rows"))
    rows = join_by_key(given, sources, ["lang"], "rows", total)
    met = F.explode(F.transform(F.sequence(F.lit(0), last), lambda o: F.struct(
        F.least(o, side).alias("i"), F.greatest(o, side).alias("j"))))
    dealt = rows.withColumn("met", met).select(
        "lang", F.pmod(F.xxhash64("term_id"), F.lit(blocks)).alias("block"), "met.i", "met.j", "place", "term_id",
        "p", "p0")
    found = dealt.groupBy("lang", "block", "i", "j").applyInArrow(
        _shared(spec), "lang string, a int, b int, shared bigint")
    return found.groupBy("lang", "a", "b").agg(F.sum("shared").alias("shared"))


def _shared(spec: AuditSpec):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[2].as_py(), key[3].as_py()
        place, p, p0 = (table.column(c).to_numpy() for c in ("place", "p", "p0"))
        terms, term = np.unique(table.column("term_id").to_numpy(), return_inverse=True)
        side = place // spec.block_sources
        right = side == j
        grid = np.full((spec.block_sources, len(terms)), -1, np.int64)  # p of the right block, -1: not held
        grid[place[right] % spec.block_sources, term[right]] = p[right]
        empty = np.zeros(spec.block_sources, np.int64)
        empty[place[right] % spec.block_sources] = p0[right]
        there = np.unique(place[right])
        a, b, shared = [], [], []
        for s in np.unique(place[side == i]):
            others = there[there > s]
            mine = np.flatnonzero(place == s)
            if not len(others) or not len(mine):
                continue
            row = others % spec.block_sources
            q = grid[row][:, term[mine]]
            ps, ps0, q0 = p[mine][None, :], p0[mine[0]], empty[row][:, None]
            fix = np.abs(ps - q) - np.abs(ps - q0) - np.abs(ps0 - q) + np.abs(ps0 - q0)
            a += [int(s)] * len(others)
            b += others.tolist()
            shared += np.where(q >= 0, fix, 0).sum(axis=1).tolist()
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.int32()),
                         "b": pa.array(b, pa.int32()), "shared": pa.array(shared, pa.int64())})
    return run
