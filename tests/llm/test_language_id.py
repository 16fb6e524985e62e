"""Language profiles against a plain re-statement, and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import language_id
from revlens.llm.common import crc_mod, read
from revlens.llm.language_id import ProfileSpec
from tests.llm.helpers import HARD, SCHEMA, hard, nothing, row, rows

SPEC = ProfileSpec(dim=64)


def plain(text, spec=SPEC):
    """The bundle of one text, letter by letter."""
    text = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    text = " " + " ".join(text.split(" ")) + " "
    while "  " in text:
        text = text.replace("  ", " ")
    total = np.zeros(spec.dim)
    for k in range(len(text) - spec.n + 1):
        bound = np.ones(spec.dim)
        for i, c in enumerate(text[k:k + spec.n]):
            bound = bound * np.roll(language_id.letter_vector(ord(c), spec.dim, spec.seed), spec.n - 1 - i)
        total += bound
    return total


@pytest.mark.parametrize("spec", [SPEC, ProfileSpec(dim=64, piece_chars=7, block_grams=3),
                                  ProfileSpec(dim=64, n=1), ProfileSpec(dim=64, n=2, piece_chars=2)])
def test_bundles(spec):
    texts = ["The cat", "", "a", "  ,. ", "Straße ÄÖ 12 ab", "日本語 İi", "x  y", "aaaaaaaaaaaaaaaaaaaaaaaa b", "...\tz\n"]
    got = language_id.bundles(texts, np.arange(len(texts)), len(texts), spec)
    assert np.array_equal(got, [plain(t, spec) for t in texts])
    both = language_id.bundles(texts, np.arange(len(texts)) % 2, 2, spec)
    assert np.array_equal(both, [got[::2].sum(axis=0), got[1::2].sum(axis=0)])


def test_prediction_is_nearest_prototype(spark):
    texts = {"en": ["the house and the garden", "this is the end"], "de": ["das Haus und der Garten", "dies ist das Ende"],
             "el": ["το σπίτι και ο κήπος"]}
    train = [(t, lang) for lang, ts in texts.items() for t in ts] + [("unknown tongue", None), (None, "de")]
    learned = language_id.learn(spark.createDataFrame(train, "text string, lang string"), SPEC)
    by_lang = {r["lang"]: np.array(r["prototype"]) for r in learned.collect()}
    assert set(by_lang) == set(texts)
    for lang, ts in texts.items():
        assert np.array_equal(by_lang[lang], sum(plain(t) for t in ts))
    for spec in (SPEC, ProfileSpec(dim=64, block_langs=1)):
        got = {r["doc_id"]: r for r in rows(language_id.predict(hard(spark).filter("doc_id is not null"), learned, spec))}
        for doc in HARD:
            if doc[0] is None:
                continue
            r = got[doc[0]]
            if doc[1] is None or not any(c.isalpha() for c in doc[1]):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            elif doc[0] not in (11, 12):  # repeated ids
                v = plain(doc[1])
                cos = {k: round(v @ p / np.linalg.norm(v) / np.linalg.norm(p), 12) for k, p in by_lang.items()}
                best = min(cos, key=lambda k: (-cos[k], k))
                assert r["lang_pred"] == best and abs(r["score"] - (1 + cos[best]) / 2) < 1e-9


def test_nulls_empty_tables_and_ties(spark):
    assert rows(language_id.learn(nothing(spark), SPEC)) == []
    none = language_id.learn(nothing(spark), SPEC)
    got = rows(language_id.predict(hard(spark), none, SPEC))
    assert len(got) == len(HARD) and {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    twins = language_id.learn(spark.createDataFrame([("abc abd", "zz"), ("abc abd", "aa")], "text string, lang string"), SPEC)
    for spec in (SPEC, ProfileSpec(dim=64, block_langs=1)):
        one = rows(language_id.predict(spark.createDataFrame([row(1, "abc")], SCHEMA), twins, spec))
        assert one[0]["lang_pred"] == "aa"
    assert rows(language_id.predict(nothing(spark), twins, SPEC)) == []


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    held = crc_mod(modulus=4) == 2
    learned = language_id.learn(docs.filter(~held))
    got = language_id.predict(docs.filter(held), learned).join(docs.select("doc_id", "lang"), "doc_id")
    n, right = got.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n >= 0.98
