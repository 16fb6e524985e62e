"""Suffix tree: counts, retained contexts, scores and the unigram base against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import queries
from revlens.llm import suffix_tree_lm as st
from revlens.llm.common import crc_mod
from revlens.llm.suffix_tree_lm import TreeSpec
from tests.llm.helpers import FOLD, HARD, SCHEMA, WORDS, hard, nothing, prose, row, rows

SPEC = TreeSpec(depth=3, min_share=0.003, min_count=3, evidence=1.0, frequent_share=0.02)


def symbols(text):
    return [*(text or "").translate(FOLD).encode(), st.END]


def context(seq, i, depth):
    return tuple(seq[i - k] if i >= k else st.START for k in range(1, depth + 1))  # nearest first


def plain_tree(texts, spec):
    counts = [defaultdict(Counter) for _ in range(spec.depth + 1)]
    for t in texts:
        seq = symbols(t)
        for i, s in enumerate(seq):
            for d in range(spec.depth + 1):
                counts[d][context(seq, i, d)][s] += 1
    kept = {()}
    for d in range(spec.depth, 0, -1):
        for c, nxt in counts[d].items():
            n = sum(nxt.values())
            if n >= spec.min_count:
                up = counts[d - 1][c[:-1]]
                nats = sum(v * math.log(v / n / (up[s] / sum(up.values()))) for s, v in nxt.items())
                if nats >= spec.evidence * len(nxt):
                    kept |= {c[:k] for k in range(d + 1)}
    return counts, kept


def probability(counts, kept, c, s, spec):
    n = counts[len(c)][c]
    up = probability(counts, kept, c[:-1], s, spec) if c else 1 / 255
    k = spec.smoothing * len(n)
    return (n.get(s, 0) + k * up) / (sum(n.values()) + k)


def plain_score(counts, kept, text, spec):
    seq, out = symbols(text), 0.0
    for i, s in enumerate(seq):
        d = 0
        while d < spec.depth and context(seq, i, d + 1) in kept:
            d += 1
        out += math.log10(probability(counts, kept, context(seq, i, d), s, spec))
    return out


def plain_base(train, texts):
    def tokens(t):
        return [*WORDS.findall((t or "").translate(FOLD)), "\n"]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return n, [(len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for t in texts]


DATA = [row(i, prose(i, 20 + i % 7)) for i in range(40)] + HARD[:8] + HARD[9:12]


@pytest.mark.parametrize("spec", [
    SPEC, TreeSpec(depth=2, min_share=0.01, frequent_share=2.0),
    TreeSpec(depth=7, min_share=0.002, min_count=2), TreeSpec(depth=4, min_share=1.0)])
def test_scores_and_base(spark, spec):
    docs = spark.createDataFrame(DATA, SCHEMA).repartition(3)
    train = docs.filter(F.col("doc_id") < 30).select(F.coalesce("text", F.lit("")).alias("text"))
    learned = [r[1] for r in DATA if r[0] is not None and r[0] < 30]
    counts, kept = plain_tree(learned, spec)
    n, base = plain_base(learned, [r[1] for r in DATA])
    got = rows(st.score(docs, st.fit(train, spec), spec))
    want = sorted((str(r[0]), *b, plain_score(counts, kept, r[1], spec)) for r, b in zip(DATA, base))
    have = sorted((str(g["doc_id"]), g["n_tokens"], g["n_known"], g["base_score"], g["score"]) for g in got)
    assert {g["train_tokens"] for g in got} == {n}
    assert [w[:3] for w in want] == [h[:3] for h in have]
    assert np.allclose([w[3] for w in want], [h[3] for h in have], rtol=1e-9)
    assert np.allclose([w[4] for w in want], [h[4] for h in have], rtol=1e-5)


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(r[1],) for r in DATA if r[1]], "text string")
    model = st.fit(texts, SPEC)
    seen = model.tree.logp.shape[1] - 1
    start = model.tree.symbol[st.START]
    p = 10.0 ** model.tree.logp[1:].astype(float)
    # column 0 stands for each of the symbols never seen; the start mark is never predicted
    unseen = 255 - (seen - 1)
    mass = p[:, 1:].sum(axis=1) - p[:, start] + unseen * p[:, 0]
    assert np.allclose(mass, 1, atol=1e-4)


def test_no_training_rows_and_empty_table(spark):
    empty = nothing(spark).select("text")
    model = st.fit(empty)
    got = rows(st.score(hard(spark), model))
    assert len(got) == len(HARD)
    assert all(g["n_known"] == 0 and g["train_tokens"] == 0 and abs(g["base_score"]) < 1e-9 for g in got)
    one = next(g for g in got if g["doc_id"] == 2)
    assert abs(one["score"] + math.log10(255)) < 1e-5
    assert st.score(nothing(spark), model).collect() == []


def test_tree_grows_with_the_corpus(spark):
    def contexts(n):
        texts = spark.createDataFrame([(prose(i, 60),) for i in range(n)], "text string").repartition(2)
        return st.retained(st.count_runs(texts, TreeSpec()), TreeSpec()).count()
    sizes = [contexts(n) for n in (20, 80, 320)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_query_learns_from_its_folds_only(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op8_suffix_tree_lm(spark, sf).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held", crc_mod() == 1).toPandas()
    n, base = plain_base(docs.text[~docs.held], docs.text)
    got = got.loc[docs.doc_id]
    assert (got.held_out.to_numpy() == docs.held.to_numpy()).all() and set(got.train_tokens) == {n}
    assert np.allclose(got.base_score, [b[2] for b in base]) and got.n_known.tolist() == [b[1] for b in base]


def test_longer_contexts_predict_unseen_text_better(spark):
    rng = random.Random(5)
    names = "transform cluster shuffle window partition broadcast checkpoint".split()
    texts = [" ".join(rng.choices(names, k=80)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = docs.filter("doc_id < 50").select("text")
    new = docs.filter("doc_id >= 50")

    def total(depth):
        spec = TreeSpec(depth=depth)
        return sum(g["score"] for g in rows(st.score(new, st.fit(train, spec), spec)))
    by_depth = [total(d) for d in (1, 3, 5)]
    assert by_depth[0] < 1.05 * by_depth[1] < 0  # three bytes tell more than one
    assert by_depth[1] <= by_depth[2] + 1e-6  # what five bytes add is no loss
