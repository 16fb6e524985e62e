"""Byte-level BPE: equal to encoding whole texts, exact round trips, safe cuts."""

import hashlib
import random

import numpy as np
import pytest

from revlens.llm import bpe, queries
from tests.llm.helpers import HARD, hard, nothing, rows


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(bpe.rank_file())


def test_hard_cases_match_whole_text_encoding(spark, enc):
    got = rows(bpe.decode(bpe.encode(hard(spark), bpe.rank_file(), piece_chars=64), bpe.rank_file()))
    want = []
    for r in HARD:
        ids = enc.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), ids, (r[1] or "").encode()))
    assert sorted(map(repr, want)) == sorted(repr((
        g["doc_id"], g["n_tokens"], np.frombuffer(g["ids"], "<u4").tolist(), bytes(g["decoded"]))) for g in got)


def test_digests(spark, enc):
    got = {(g["doc_id"], g["decoded_sha256"]): g for g in rows(queries.bpe_digests(hard(spark)))}
    text = HARD[4][1]
    g = got[5, hashlib.sha256(text.encode()).hexdigest()]
    assert g["ids_sha256"] == hashlib.sha256(np.array(enc.encode_ordinary(text), "<u4").tobytes()).hexdigest()


def test_empty_table(spark):
    assert queries.bpe_digests(nothing(spark)).collect() == []


def test_cuts_and_long_blank_runs(enc, monkeypatch):
    monkeypatch.setattr(bpe, "RUN", 8)
    monkeypatch.setattr(bpe, "LONG_RUN", bpe.re.compile(f"[{bpe.SPACE}]{{8,}}"))
    rng = random.Random(4)
    parts = [" ", "\n", " ", "a", "é", "7", "'", "s", "!", "　", "\t", "日", "\x1c", "\xa0", "ll", "don't", "  "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(120)))
        assert bpe.encode_text(enc, text, rng.choice([3, 10, 40])).tolist() == enc.encode_ordinary(text)


def test_blank_run_that_overflows_the_pattern_engine(enc):
    ids = bpe.encode_text(enc, "a" + " " * 2_000_000 + "b", 65_536)
    assert enc.decode_bytes(ids.tolist()) == b"a" + b" " * 2_000_000 + b"b"
