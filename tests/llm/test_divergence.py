"""The divergence audit against plain Python over all terms."""

import re
from collections import Counter, defaultdict

import pytest

from revlens.llm import divergence
from revlens.llm.divergence import AuditSpec
from tests.llm.helpers import FOLD, HARD, SCHEMA, hard, nothing, prose, rows

TERMS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, min_docs, top=50):
    """docs: (text, lang, source)."""
    count, df, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = TERMS.findall((text or "").translate(FOLD))
        langs[lang].add(source)
        count[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}
        share = {s: p(count[lang, s]) for s in sources}
        q = p(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - share[s][t], t.encode(), t) for t in kept if count[lang, s][t] and share[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, x[2], -x[0], k + 1) for k, x in enumerate(found)]
    return sorted(out)


COLS = ["lang", "source", "part", "item", "value", "rank"]


def audited(frame, spec):
    got = divergence.audit(frame, spec)
    assert got.columns == COLS
    return sorted(tuple(r[c] for c in COLS) for r in rows(got))


def corpus():
    docs = [(prose(k, 5 + k % 40), ["en", "de", None][k % 3], f"s{k % 7}" if k % 11 else None) for k in range(200)]
    docs += [(prose(3, 30), "en", f"s{k % 5}") for k in range(60)]      # one text, many sources
    docs += [("Ünï ÜNÏ A-b a_B 日本 İX", "de", "s1")] * 9
    docs += [(None, "de", "empty"), ("12 + 3", "de", "empty"), ("", "fr", "x"), (None, "fr", "y"), ("rare words", "it", "one")]
    return docs


@pytest.mark.parametrize("spec", [AuditSpec(min_docs=8), AuditSpec(min_docs=8, block_sources=2, block_rows=40,
                                                                   flush_terms=25, piece_bytes=10),
                                  AuditSpec(min_docs=1, top_terms=3)])
def test_against_all_terms(spark, spec):
    docs = corpus()
    frame = spark.createDataFrame([(k, t, lang, s, "n", "p") for k, (t, lang, s) in enumerate(docs)],
                                  "doc_id long, text string, lang string, source string, n string, p string")
    want = plain(docs, spec.min_docs, spec.top_terms)
    assert {r[2] for r in want} == {"pair", "term"}
    assert audited(frame, spec) == want


def test_hard_rows(spark):
    want = plain([(r[1], r[2], r[3]) for r in HARD], 2)
    assert audited(hard(spark), AuditSpec(min_docs=2)) == want
    assert audited(nothing(spark), AuditSpec()) == []
    assert len(SCHEMA.names) > 5


def test_texts_are_tokenized_once(spark):
    docs = [("same words here", "en", f"s{k}") for k in range(6)] + [("other", "en", "s0")]
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    found = rows(divergence.collapsed(frame))
    assert sorted((r["text"], len(r["uses"])) for r in found) == [("other", 1), ("same words here", 6)]
