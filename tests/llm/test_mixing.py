"""Temperature mixing: exponent, budgets and schedule against a plain computation."""

import hashlib
import math
from collections import defaultdict

import pytest

from revlens.llm import mixing
from revlens.llm.mixing import MixSpec
from tests.llm.helpers import HARD, SCHEMA, WORDS, hard, nothing, prose, row, rows


def plain(data, spec):
    tokens = [(r[0], r[3] or "", len(WORDS.findall(r[1] or ""))) for r in data]
    sums = defaultdict(int)
    for _, s, n in tokens:
        sums[s] += n
    sums = {s: n for s, n in sums.items() if n}
    total = sum(sums.values())
    share = {s: n / total for s, n in sums.items()}
    budget = math.floor(total * min(spec.budget_part, spec.max_epochs))

    def weights(a):
        z = sum(p ** a for p in share.values())
        return {s: p ** a / z for s, p in share.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in weights(a).values())

    def fresh(a):
        return max(w * budget / sums[s] for s, w in weights(a).items()) <= spec.max_epochs + 1e-9
    grid = range(mixing.GRID + 1)
    a = max(max(k for k in grid if entropy(k / mixing.GRID) >= spec.entropy_part * math.log(len(share)) - 1e-9),
            min(k for k in grid if fresh(k / mixing.GRID))) / mixing.GRID
    out = []
    for s, w in weights(a).items():
        b = math.floor(budget * w + 1e-6)
        if spec.crossing and a == 1.0 and min(spec.budget_part, spec.max_epochs) == 1.0:
            b = sums[s]
        epochs, rest = divmod(b, sums[s])
        for epoch in range(epochs + 1):
            def key(d, epoch=epoch):
                return hashlib.md5(f"{spec.seed}|{epoch}|{'null' if d is None else d}".encode()).hexdigest()
            own = [(key(d), d, n) for d, src, n in tokens if src == s]
            for k, d, n in own:
                through = sum(m for k2, _, m in own if k2 <= k)
                start = sum(m for k2, _, m in own if k2 < k)
                if epoch < epochs or (start < rest if spec.crossing else through <= rest):
                    pos = epoch * sums[s] + through
                    place = min(pos, b) if spec.crossing else pos
                    out.append((d, s, epoch, max(place - 1, 0) * spec.blocks // b, pos, n, k))
    return a, out


DATA = [row(i, prose(i, 5 + i % 9), "big" if i % 3 else f"s{i % 4}") for i in range(120)]


@pytest.mark.parametrize("spec", [MixSpec(), MixSpec(budget_part=2.5, entropy_part=0.99, max_epochs=3.0, blocks=7),
                                  MixSpec(budget_part=0.5, entropy_part=0.6), MixSpec(budget_part=0.9, max_epochs=1.0),
                                  MixSpec(budget_part=9.0, max_epochs=2.0), MixSpec(crossing=True),
                                  MixSpec(budget_part=0.7, entropy_part=0.99, max_epochs=2.0, crossing=True)])
def test_schedule(spark, spec):
    mixed = mixing.mix(spark.createDataFrame(DATA, SCHEMA), spec)
    a, want = plain(DATA, spec)
    assert mixed.exponent == a
    got = [tuple(r) for r in mixed.draws.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_hard_cases(spark):
    spec = MixSpec(budget_part=1.5)
    mixed = mixing.mix(hard(spark), spec)
    a, want = plain(HARD, spec)
    assert mixed.exponent == a
    assert sorted(repr(tuple(r)) for r in mixed.draws.collect()) == sorted(map(repr, want))


def test_mixed_rows_are_the_draws(spark):
    spec = MixSpec(budget_part=1.5, entropy_part=0.99)
    docs = spark.createDataFrame(DATA, SCHEMA)
    got = mixing.mixed_rows(docs, spec)
    assert got.columns == SCHEMA.names
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(w[0] for w in plain(DATA, spec)[1])


def test_empty_tables(spark):
    assert mixing.mix(nothing(spark)).draws.collect() == []
    assert mixing.mixed_rows(nothing(spark)).collect() == []
    blank = spark.createDataFrame([row(1, None), row(2, " ")], SCHEMA)
    assert rows(mixing.mix(blank).draws) == []


def drawn_tokens(spark, data, spec):
    mixed = mixing.mix(spark.createDataFrame(data, SCHEMA), spec)
    got = defaultdict(int)
    for d in mixed.draws.collect():
        got[d["source"]] += d["n_tokens"]
    return mixed, got


def test_crossing_documents_realise_every_budget(spark):
    data = ([row(i, "w " * 10, "big") for i in range(40)] + [row(100, "w " * 300, "big")]
            + [row(200, "w " * 50, "alone"), row(201, "w " * 400, "book")])
    spec = MixSpec(budget_part=0.5, entropy_part=0.0, max_epochs=1.0, crossing=True)
    mixed, got = drawn_tokens(spark, data, spec)
    longest = {"big": 300, "alone": 50, "book": 400}
    budgets = {b["source"]: b["source_budget"] for b in mixed.budgets.collect()}
    assert set(budgets) == set(longest)
    assert all(budgets[s] <= got[s] < budgets[s] + longest[s] for s in longest)
    assert all(0 <= d["block"] < spec.blocks for d in mixed.draws.collect())
    rows_ = mixing.mixed_rows(spark.createDataFrame(data, SCHEMA), spec).collect()
    assert sorted(r["doc_id"] for r in rows_) == sorted(d["doc_id"] for d in mixed.draws.collect())
