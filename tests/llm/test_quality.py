"""Quality classifier: held-out accuracy, whole texts, defined results of hard cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revlens.llm import quality, queries
from revlens.llm.common import read
from revlens.llm.quality import SCORE, QualitySpec
from tests.llm.helpers import HARD, SCHEMA, hard, nothing, rows

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op7_random_indexing_quality(spark, SF).collect()}
    assert len(got) == read(spark, SF, "documents").count()
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
               for i, r in got.items())
    tested = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in read(spark, SF, "labels").collect()
              if held(r["doc_id"])]
    assert np.mean([p == q for p, q in tested]) > 0.9
    assert np.mean([p for p, q in tested if q]) > 0.95


def test_scores_ignore_labels_of_held_out_rows_and_other_columns(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    spec = QualitySpec(epochs=2)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.fit(docs, labels, spec)
    b = quality.fit(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s")), flipped, spec)
    assert all(np.array_equal(x, y) for x, y in zip(a.layers, b.layers)) and a.temperature == b.temperature


@pytest.fixture(scope="module")
def labels(spark):
    data = [(5, 1), (6, 0), (7, 0), (8, 1), (8, 1), (9, 0), (9, 1), (10, None), (12, 7), (None, 1), (999, 0)]
    return spark.createDataFrame(data, "doc_id long, quality int")


def test_hard_cases(spark, labels):
    net = quality.fit(hard(spark), labels)
    got = quality.score(hard(spark), net)
    assert got.columns == [*SCHEMA.names, SCORE]
    out = rows(got)
    assert len(out) == len(HARD) and all(0 <= r[SCORE] <= 1 for r in out)
    by_text = {}
    for r in out:  # the score depends on the text alone
        assert by_text.setdefault(r["text"] or "", r[SCORE]) == r[SCORE]
    kept = quality.accepted(hard(spark), labels)
    assert kept.columns == SCHEMA.names
    assert kept.count() == sum(r[SCORE] >= 0.3 for r in out)


def test_label_table(spark, labels):
    got = {r["doc_id"]: r["quality"] for r in quality.label_table(labels).collect()}
    want = {5: 1, 6: 0, 7: 0, 8: 1, 999: 0}
    assert got == {i: q for i, q in want.items() if not held(i)}


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = rows(quality.score(hard(spark), quality.fit(hard(spark), none)))
    assert {r[SCORE] for r in got} == {0.5}
    assert quality.accepted(nothing(spark), none).collect() == []


def test_codes_and_pooling():
    texts = pa.array(["ab ab ab cd", "", "Ab!! 12 x_y", None]).fill_null("")
    codes, sizes = quality.coded(texts, 512)
    assert sizes.tolist() == [4, 0, 6, 0]
    ab = quality.word_codes("ab", 512)
    assert codes[:4].tolist() == [*ab, 0, 0, *quality.word_codes("cd", 512)]
    words = np.random.default_rng(0).normal(size=(512, 8)).astype(np.float32)
    pooled = quality.pooled(texts, words)
    assert np.allclose(pooled[0], words[codes[:4]].mean(axis=0)) and not pooled[1].any()


def test_random_indexing_sums_neighbours(spark):
    spec = QualitySpec(buckets=64, dims=16)
    texts = ["a b c a", "b b a", "c"]
    place, sign = quality.index_vectors(spec)
    table = np.zeros((64, 16))
    for t in texts:
        codes, _ = quality.coded(pa.array([t]), 64)
        for i, c in enumerate(codes):
            for k in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= k < len(codes):
                    for j in range(spec.nonzero):
                        table[c, place[j][codes[k]]] += sign[j][codes[k]]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert np.allclose(quality.word_vectors(docs, spec), table / np.where(norm > 0, norm, 1), atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality._temperature(3 * z, y) - 3) < 0.4
