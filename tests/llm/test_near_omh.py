"""Near-duplicate classes against brute force over all pairs."""

import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa

from revlens.llm import near_omh
from revlens.llm.near_omh import NearSpec
from tests.llm.helpers import HARD, SCHEMA, WORDS, hard, nothing, prose, row, rows


def items(text):
    words, seen, out = WORDS.findall(text or ""), Counter(), []
    for i in range(max(1, len(words) - 4) if words else 0):
        k = tuple(words[i:i + 5])
        out.append((k, seen[k]))
        seen[k] += 1
    return out


def similarity(a, b):
    at, ends = {k: i for i, k in enumerate(a)}, []
    for k in b:
        if k in at:
            p = bisect_left(ends, at[k])
            ends[p:p + 1] = [at[k]]
    return len(ends) / (len(a) + len(b) - len(ends))


def brute(data):
    """Class of each row, as row numbers."""
    label = list(range(len(data)))
    seqs = [items(r[1]) for r in data]
    plain = [tuple(WORDS.findall(r[1] or "")) for r in data]

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(data)):
        for j in range(i):
            if plain[i] == plain[j] or (seqs[i] and seqs[j] and similarity(seqs[j], seqs[i]) >= 0.8):
                label[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(data))]


def expected(data):
    cls = brute(data)
    least = {}
    for r, c in zip(data, cls):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return sorted(repr((r[0], least.get(c))) for r, c in zip(data, cls)), len(set(cls))


def check(spark, data, spec=NearSpec()):
    got = rows(near_omh.classes(spark.createDataFrame(data, SCHEMA), spec).rows)
    want, n = expected(data)
    assert sorted(repr((g["doc_id"], g["class_id"])) for g in got) == want
    assert sum(g["kept"] for g in got) == n


def variants(seed, groups=12, copies=6, words=120):
    rng = random.Random(seed)
    data = []
    for g in range(groups):
        base = prose(100 * seed + g, words).split()
        for c in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 6, 15])):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                text = text[60:] + text[:60]  # same words in another order
            data.append(row(1000 * g + c, " ".join(text)))
    rng.shuffle(data)
    return data


def test_variants_against_all_pairs(spark):
    check(spark, variants(1) + variants(2, groups=5, copies=4, words=12))


def test_hard_cases(spark):
    check(spark, HARD)


def test_small_parts_give_the_same_classes(spark):
    check(spark, variants(3, groups=2, copies=40), NearSpec(part_rows=8, group_rows=7))


def templates(seed, n, pairs, words=150, own=14, edited=10):
    """Documents that share a template but for a run of their own words, and pairs with a changed run."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    data, planted = [], []

    def changed(text, size, tag):
        at = rng.randrange(words - size)
        return [*text[:at], *(f"{tag}x{k}" for k in range(size)), *text[at + size:]]
    for i in range(n):
        text = changed(base, own, f"own{i}")
        data.append(row(2 * i, " ".join(text)))
        if i < pairs:
            data.append(row(2 * i + 1, " ".join(changed(text, edited, f"edit{i}"))))
            planted.append((2 * i, 2 * i + 1))
    return data, planted


def test_large_buckets_lose_no_pair(spark):
    """A template's buckets exceed ``part_rows`` as set by default; every planted pair is found."""
    base = prose(31, 150)
    data, planted = templates(32, 1600, 150)
    copies = [row(10_000 + i, f"{base} end{i}") for i in range(1300)]
    got = {r["doc_id"]: r["class_id"] for r in rows(near_omh.classes(spark.createDataFrame(data + copies, SCHEMA)).rows)}
    assert {got[10_000 + i] for i in range(1300)} == {10_000}
    seqs = {r[0]: items(r[1]) for r in data}
    close = [(a, b) for a, b in planted if similarity(seqs[a], seqs[b]) >= 0.8]
    found = sum(got[a] == got[b] for a, b in close)
    assert close and found == len(close), (found, len(close))


def test_split_buckets_against_all_pairs(spark):
    data, _ = templates(5, 60, 30, words=80, own=7, edited=4)
    check(spark, data, NearSpec(part_rows=6, group_rows=16))


def test_shared_passages_are_no_near_copies(spark):
    passage = prose(77, 60)
    data = [row(i, f"{passage} {prose(500 + i, 60)}") for i in range(40)]
    check(spark, data)
    assert expected(data)[1] == 40


def test_stage_keeps_rows_and_columns(spark):
    got = near_omh.drop_near_copies(hard(spark))
    assert got.columns == SCHEMA.names
    assert got.count() == expected(HARD)[1]
    assert near_omh.drop_near_copies(nothing(spark)).collect() == []


def test_band_and_order():
    a = np.arange(100, dtype=np.uint64)
    assert near_omh.aligned(a, a, 0.8)
    assert near_omh.aligned(a, a[:90], 0.8)
    assert not near_omh.aligned(a, a[:70], 0.8)
    assert not near_omh.aligned(a, np.roll(a, 50), 0.8)  # same items, other order
    rng = random.Random(5)
    for _ in range(300):
        x = rng.sample(range(200), 40)
        y = [v for v in x if rng.random() < 0.93] + [1000 + rng.randrange(5) * 7] * (rng.random() < 0.5)
        if rng.random() < 0.5:
            i, j = rng.randrange(len(y)), rng.randrange(len(y))
            y[i], y[j] = y[j], y[i]
        assert near_omh.aligned(np.array(x, np.uint64), np.array(y, np.uint64), 0.8) == (similarity(x, y) >= 0.8 - 1e-12)


def test_occurrence_labels():
    words, sizes = near_omh.word_hashes(pa.array(["a b a b a b a b", "", " c ", "a b a b a"]))
    item, n = near_omh.labelled(words, sizes, 5)
    assert n.tolist() == [4, 0, 1, 1]
    assert len(set(item[:4].tolist())) == 4 and item[0] == item[5]


def test_a_pair_in_a_single_large_bucket_is_tied(spark):
    """Both rows share one bucket, which is large and whose pivot holds neither of them."""
    spec = NearSpec(part_rows=4)
    rng = np.random.default_rng(3)

    def row_of(name, bits):
        keys = rng.integers(1, 2**62, spec.sketches)
        keys[0] = 77
        return name, 100, [int(k) for k in keys], bytearray(bits.tobytes())

    # the first sketch's samples agree; those of the others don't, but for the pair
    def samples():
        bits = rng.integers(0, 2**16, spec.sketches * spec.picks).astype(np.uint16)
        bits[:spec.picks] = 9
        return bits

    a, b = samples(), samples()
    agree = np.arange(57, 57 - 13, -1)      # as few as may reach the threshold, and the last ones
    b[agree] = a[agree]
    data = [row_of(bytearray([k]), samples()) for k in range(12)]
    data += [row_of(bytearray([200]), a), row_of(bytearray([201]), b)]
    reps = spark.createDataFrame(data, "digest binary, n_items bigint, keys array<bigint>, bits binary")
    for part_rows in (4, 1000):
        spec = NearSpec(part_rows=part_rows)
        got = {bytes(r["node"]): bytes(r["root"]) for r in near_omh.candidate_groups(reps, spec).collect()}
        assert got == {bytes([200]): bytes([200]), bytes([201]): bytes([200])}


def test_few_open_rows_are_compared_as_they_are(spark, monkeypatch):
    """Buckets are keyed anew only where that makes fewer rows than pairs of their parts."""
    kept, write = {}, near_omh.materialize
    monkeypatch.setattr(near_omh, "materialize", lambda df, name: kept.setdefault(name, write(df, name)))
    data, _ = templates(5, 60, 30, words=80, own=7, edited=4)
    check(spark, data, NearSpec(part_rows=6, group_rows=16))
    assert kept["omh-buckets"].where("n > 6").count() and kept["omh-second-buckets"].count() == 0


def test_buckets_keyed_anew_against_all_pairs(spark, monkeypatch):
    kept, write = {}, near_omh.materialize
    monkeypatch.setattr(near_omh, "materialize", lambda df, name: kept.setdefault(name, write(df, name)))
    data, _ = templates(5, 120, 30, words=80, own=7, edited=4)
    check(spark, data, NearSpec(part_rows=1, group_rows=16))
    assert kept["omh-second-buckets"].count()
