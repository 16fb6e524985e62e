"""The pipeline: stages in order, each against its brute-force meaning on what it was given."""

import importlib
import math
from collections import Counter

from revlens.llm import mixing, quality
from revlens.llm.common import materialize, read
from tests.llm.helpers import SCHEMA, nothing, prose, row
from tests.llm.test_mixing import plain
from tests.llm.test_near_omh import brute

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]
    docs = read(spark, SF, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs.toPandas())
        docs = materialize(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns or name.startswith("byte-level")
    seen.append(docs.toPandas())
    start, good, single, apart, mixed, coded = seen
    labels = read(spark, SF, "labels").toPandas().set_index("doc_id").quality
    right = [(i in set(good.doc_id)) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.85 * len(right)
    assert sorted(single.doc_id) == sorted(good.groupby("text").doc_id.max())
    given = [(r.doc_id, r.text) for r in single.sort_values("doc_id").itertuples()]
    assert sorted(apart.doc_id) == sorted({given[c][0] for c in brute(given)})
    _, draws = plain([(r.doc_id, r.text, r.lang, r.source) for r in apart.itertuples()], corpus_pipeline.MIX)
    assert mixed.doc_id.is_unique and sorted(mixed.doc_id) == sorted(d[0] for d in draws)
    assert sorted(coded.doc_id) == sorted(mixed.doc_id) and coded.n_tokens.gt(0).all()


def test_empty_documents(spark):
    docs = nothing(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        assert docs.columns == SCHEMA.names or name.startswith("byte-level")
        assert docs.count() == 0


def test_entry_lists_the_queries():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
    assert quality.QualitySpec().threshold == 0.3


def test_mixing_loses_nothing_where_shares_are_even(spark):
    data = [row(i, prose(i, 30 + i % 5), f"s{i % 6}") for i in range(90)] + [row(900, "", "s1")]
    got = corpus_pipeline.mixing_stage(spark, spark.createDataFrame(data, SCHEMA), SF).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in data]


def test_mixing_reaches_the_target_beside_a_large_source(spark):
    data = ([row(i, "w " * 10, "big") for i in range(200)]
            + [row(1000 + i, "w " * 10, f"s{i % 20}") for i in range(400)] + [row(5000, "w " * 40, "alone")])
    docs = spark.createDataFrame(data, SCHEMA)
    mixed = mixing.mix(docs, corpus_pipeline.MIX)
    weights = [b["weight"] for b in mixed.budgets.collect()]
    assert -sum(w * math.log(w) for w in weights) >= 0.95 * math.log(22) - 1e-6
    drawn = Counter(r["doc_id"] for r in corpus_pipeline.mixing_stage(spark, docs, SF).collect())
    assert {r[0] for r in data if r[3] != "big"} <= set(drawn) and max(drawn.values()) <= 5
    assert sum(drawn.values()) >= len(data) - 5
