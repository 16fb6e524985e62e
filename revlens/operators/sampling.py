"""Deterministic exact-size sampling, stratified splits and folds.

Selection is by the rank of a seeded hash (``md5`` of the key columns and
the seed, hex text; ties by key) inside each class.  Ranking every row would
move the whole table; instead :func:`rank_cutoffs` finds only the exact
cutoff rows (a verified narrow band around each expected position, ranked by
the two-level distributed rank), and the table is then labelled by comparing
each row with its class's cutoffs -- one filter/projection, no shuffle of the
table, no class-partitioned window.  ``DataFrame.sample`` / ``sampleBy`` are
only approximately sized, so they are not used where an exact count is
required.

Per-class quotas follow the largest-remainder rule (ties to the smaller
class label); class counts are one tiny aggregate.  Rows without a label form
a class of their own.  The key columns must identify the rows: a key that
repeats at a cutoff has no exact sample, so it raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from revlens.operators.ranking import global_rank

RANDOM_STATE = 42


def seeded_hash(keys: list[str], seed: int = RANDOM_STATE) -> Column:
    """md5 hex of ``key1|key2|...|seed`` (identical text in Spark and DuckDB)."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def quotas(counts: dict, n: int) -> dict:
    """Largest-remainder allocation of ``n`` over class ``counts``."""
    total = sum(counts.values())
    if total == 0:
        return {k: 0 for k in counts}
    raw = {k: n * c / total for k, c in counts.items()}
    out = {k: math.floor(v) for k, v in raw.items()}
    rest = n - sum(out.values())
    order = sorted(counts, key=lambda k: (-(raw[k] - out[k]), str(k)))
    for k in order[:rest]:
        out[k] += 1
    return out


def _class_counts(df: DataFrame, y: str) -> dict:
    return {r[y]: r["n"] for r in df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).collect()}


U_MAX = 1 << 60


def _hex(u: int) -> str:
    """The 15 digits of a 60-bit prefix; an md5 is below this text when its prefix is below ``u``."""
    return f"{u:015x}" if u < U_MAX else "g"


def _between(c, lo: int, hi: int) -> Column:
    """Row of class ``c`` whose md5 prefix is from ``lo`` to ``hi``, ``hi`` excluded."""
    return F.col("__y").eqNullSafe(F.lit(c)) & (F.col("__h") >= _hex(lo)) & (F.col("__h") < _hex(hi))


def rank_cutoffs(df: DataFrame, keys: list[str], y: str | None, counts: dict,
                 targets: list[tuple], seed: int = RANDOM_STATE, partitions: int | None = None,
                 margin: float = 6.0) -> dict:
    """Exact r-th smallest row in (md5, keys) order inside class c, for every
    (c, r) in ``targets``; returns {(c, r): (md5, key values)}.

    The md5's 60-bit prefix ``u`` is uniform, so the r-th row of a class of N rows sits
    near u = r / N.  One aggregate counts, per target, the rows below and up to
    a band of +-``margin`` binomial standard deviations around that position;
    if the band provably contains the r-th row (below < r <= up to), only the
    band's rows are ranked (a tiny distributed job).  The other targets (rows that
    an earlier draw with this seed selected are not uniform) get their bands from
    counted prefixes (:func:`_counted_bands`).  Nothing else of the table is moved.
    """
    proj = df.select(*keys, (F.col(y) if y else F.lit(0)).alias("__y"), seeded_hash(keys, seed).alias("__h"))
    todo = [(c, r) for c, r in targets if 0 < r < counts.get(c, 0)]
    if not todo:
        return {}
    aggs, bands = [], []
    for i, (c, r) in enumerate(todo):
        n = counts[c]
        p = r / n
        sd = math.sqrt(n * p * (1 - p)) + 1
        lo_r, hi_r = max(0.0, r - margin * sd - 2), min(float(n), r + margin * sd + 2)
        lo = 0 if lo_r <= 0 else int(lo_r / n * U_MAX)
        hi = U_MAX if hi_r >= n else min(U_MAX, int(math.ceil(hi_r / n * U_MAX)) + 1)
        bands.append((lo, hi))
        aggs += [F.count(F.when(_between(c, 0, lo), 1)).alias(f"b{i}"),
                 F.count(F.when(_between(c, lo, hi), 1)).alias(f"n{i}")]
    cnt = proj.agg(*aggs).first()
    found = {t: (*bands[i], cnt[f"b{i}"], cnt[f"n{i}"]) for i, t in enumerate(todo)
             if cnt[f"b{i}"] < t[1] <= cnt[f"b{i}"] + cnt[f"n{i}"]}
    found |= _counted_bands(proj, [t for t in todo if t not in found])
    held = [_between(t[0], *found[t][:2]) for t in todo]
    tags = F.array(*[F.when(x, F.lit(i)) for i, x in enumerate(held)])
    band = (proj.where(reduce(Column.__or__, held)).select(*keys, "__h", F.explode(tags).alias("__t"))
            .where(F.col("__t").isNotNull()))
    rows = sum(n for *_, n in found.values())
    ranked = global_rank(band, [F.col("__h")] + [F.col(k) for k in keys], ["__t"],
                         partitions or _few(df, rows), name="__r")
    want = F.lit(False)
    for i, (c, r) in enumerate(todo):
        at = r - found[c, r][2]
        want = want | ((F.col("__t") == i) & F.col("__r").isin(at, at + 1))
    out: dict = {}
    for row in ranked.where(want).orderBy("__t", "__r").collect():   # two rows per target
        target, cut = todo[row["__t"]], (row["__h"],) + tuple(row[k] for k in keys)
        if out.get(target) == cut:
            raise ValueError(f"key {cut[1:]} repeats: {keys} must identify the rows")
        out.setdefault(target, cut)
    return out


#: A band with more rows is counted by a longer prefix; also the rows of one ranking task.
BAND_ROWS = 50_000


def _few(df: DataFrame, rows: int) -> int:
    """Partitions for ``rows`` rows, at most the session's number."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, min(most, -(-rows // BAND_ROWS)))


def _counted_bands(proj: DataFrame, targets: list[tuple]) -> dict:
    """{(c, r): (from, to, rows below, rows within)} of the hash range that holds the r-th row
    of class c, whatever the hashes' distribution.

    Each pass counts the rows by three more hex digits of the hash (at most 4,096 numbers per
    target reach the driver); a range with more than ``BAND_ROWS`` rows is divided again.
    """
    out, todo, digits = {}, {t: (0, 0) for t in targets}, 0
    while todo:
        width, digits = U_MAX >> 4 * digits, digits + 3
        step = U_MAX >> 4 * digits
        counted = (proj.where(reduce(Column.__or__, [_between(c, lo, lo + width) for (c, _), (lo, _) in todo.items()]))
                   .groupBy("__y", F.substring("__h", 1, digits).alias("at")).count().collect())
        rest = {}
        for (c, r), (lo, below) in todo.items():
            for at, n in sorted((int(x["at"], 16) * step, x["count"]) for x in counted if x["__y"] == c):
                if not lo <= at < lo + width:
                    continue
                if below + n >= r:
                    break
                below += n
            if n <= BAND_ROWS or step == 1:
                out[c, r] = (at, at + step, below, n)
            else:
                rest[c, r] = (at, below)
        todo = rest
    return out


def _not_after(keys: list[str], seed: int, cut: tuple, types: dict):
    """Row is at or before ``cut`` in (md5, keys) order."""
    row = F.struct(seeded_hash(keys, seed).alias("h"), *[F.col(k).alias(k) for k in keys])
    lit = F.struct(F.lit(cut[0]).alias("h"),
                   *[F.lit(v).cast(types[k]).alias(k) for k, v in zip(keys, cut[1:])])
    return row <= lit


def _within_quota(df, keys, y, counts, quota, seed, partitions):
    """Boolean column: row is among the first quota[c] rows of its class."""
    cuts = rank_cutoffs(df, keys, y, counts, [(c, q) for c, q in quota.items()], seed, partitions)
    types = dict(df.dtypes)
    expr = F.lit(False)
    for c, q in quota.items():
        in_c = F.col(y).eqNullSafe(F.lit(c)) if y else F.lit(True)
        if q >= counts.get(c, 0):
            cond = in_c
        elif q <= 0:
            continue
        else:
            cond = in_c & _not_after(keys, seed, cuts[(c, q)], types)
        expr = expr | cond
    return expr


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = RANDOM_STATE,
             partitions: int | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the n smallest
    (md5(key, seed), key), selected by comparison with the exact cutoff row."""
    total = df.count()
    if n >= total:
        return df
    return df.where(_within_quota(df, keys, None, {0: total}, {0: n}, seed, partitions))


def stratified_sample(df: DataFrame, y: str, n: int, keys: list[str],
                      seed: int = RANDOM_STATE, partitions: int | None = None) -> DataFrame:
    """Exactly ``n`` rows with class shares kept (largest remainder)."""
    counts = _class_counts(df, y)
    if n >= sum(counts.values()):
        return df
    q = quotas(counts, n)
    return df.where(_within_quota(df, keys, y, counts, q, seed, partitions))


def stratified_split(df: DataFrame, y: str, keys: list[str], test_size: float = 0.2,
                     seed: int = RANDOM_STATE, partitions: int | None = None) -> DataFrame:
    """Adds ``is_test``: ceil(test_size * rows) test rows, allocated per class."""
    counts = _class_counts(df, y)
    n_test = math.ceil(test_size * sum(counts.values()))
    q = quotas(counts, n_test)
    return df.withColumn("is_test", _within_quota(df, keys, y, counts, q, seed, partitions)
                         .cast("int"))


def stratified_folds(df: DataFrame, y: str, keys: list[str], k: int = 3,
                     seed: int = RANDOM_STATE, partitions: int | None = None) -> DataFrame:
    """Adds ``fold`` = floor((rank - 1) * k / n_class) for the row's rank in
    (md5, key) order within its class: k contiguous hash ranges per class,
    so every fold holds each class share to within one row."""
    counts = _class_counts(df, y)
    targets = {}
    for c, n in counts.items():
        # last rank of fold j is floor(((j + 1) * n - 1) / k) + 1
        targets[c] = [((j + 1) * n - 1) // k + 1 for j in range(k - 1)]
    cuts = rank_cutoffs(df, keys, y, counts, [(c, r) for c, rs in targets.items() for r in rs],
                        seed, partitions)
    types = dict(df.dtypes)
    fold = F.lit(0)
    for c, rs in targets.items():
        for r in rs:
            if r >= counts[c]:
                continue
            after = ~_not_after(keys, seed, cuts[(c, r)], types)
            fold = fold + (F.col(y).eqNullSafe(F.lit(c)) & after).cast("int")
    return df.withColumn("fold", fold.cast("int"))


def class_weights(df: DataFrame, y: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (2 * n_class) as a column (scalar subqueries, no join)."""
    total = df.select(F.count(F.lit(1))).scalar()
    pos = df.select(F.count(F.when(F.col(y) == 1, 1))).scalar()
    neg = df.select(F.count(F.when(F.col(y) == 0, 1))).scalar()
    w = F.when(F.col(y) == 1, total / (2 * pos)).otherwise(total / (2 * neg))
    return df.withColumn(name, w.cast("double"))


POISSON_KMAX = 12


def poisson_cdf(kmax: int = POISSON_KMAX, rate: float = 1.0) -> list[float]:
    """P(X <= k) of Poisson(rate) for k < kmax."""
    cdf, total, term = [], 0.0, math.exp(-rate)
    for k in range(kmax):
        total += term
        term *= rate / (k + 1)
        cdf.append(total)
    return cdf


#: Digests computed at once: their words stay in the processor's cache.
DIGESTS_AT_ONCE = 16_384
_MD5_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_MD5_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]


def _md5_blocks(words: list[np.ndarray], shape: tuple) -> np.ndarray:
    """The digests (shape x 16 bytes) of messages of one block: ``words`` are its 16 numbers, each an array
    that can be broadcast to ``shape``."""
    start = [np.uint32(v) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(shape, v, np.uint32) for v in start)
    f, high = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
            at = i
        elif turn == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
            at = (5 * i + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
            at = (3 * i + 5) % 16
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
            at = 7 * i % 16
        f += a
        f += words[at] + _MD5_SINES[i]
        left = _MD5_TURNS[turn][i % 4]
        np.right_shift(f, np.uint32(32 - left), out=high)
        np.left_shift(f, np.uint32(left), out=f)
        f |= high
        f += b
        a, b, c, d, f = d, f, b, c, a
    return np.stack([v + s for v, s in zip((a, b, c, d), start)], axis=-1).astype("<u4").view(np.uint8)


def md5_of_pairs(keys: list[bytes], ends: list[bytes]) -> np.ndarray:
    """md5(key + end) of every key and end, keys x ends x 16 bytes."""
    out = np.empty((len(keys), len(ends), 16), np.uint8)
    lengths = np.array([len(k) for k in keys], np.int64)
    longest = max(map(len, ends), default=0)
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        if length + longest > 55:           # more than one block
            for i in of:
                out[i] = np.frombuffer(b"".join([hashlib.md5(keys[i] + e).digest() for e in ends]), np.uint8).reshape(-1, 16)
            continue
        tails = b"".join([bytes(length) + e + b"\x80" + bytes(55 - length - len(e)) + (8 * (int(length) + len(e))).to_bytes(8, "little")
                          for e in ends])
        tail = np.frombuffer(tails, "<u4").astype(np.uint32).reshape(-1, 16)
        head = np.frombuffer(b"".join([keys[i].ljust(64, b"\0") for i in of]), "<u4").astype(np.uint32).reshape(-1, 16)
        step = max(1, DIGESTS_AT_ONCE // max(len(ends), 1))
        for at in range(0, len(of), step):
            some = head[at:at + step]
            words = [some[:, w, None] | tail[None, :, w] if w <= length // 4 else tail[None, :, w] for w in range(16)]
            out[of[at:at + step]] = _md5_blocks(words, (len(some), len(ends))).reshape(len(some), len(ends), 16)
    return out


def poisson_weights(keys: list[str], replicates: int, seed: int = RANDOM_STATE, rate: float = 1.0) -> np.ndarray:
    """Poisson weights, rows x replicates, from md5(key|block|seed): a digest is
    eight 16-bit uniforms, those of replicates 8 * block ... 8 * block + 7, and
    the weight is the smallest k with CDF(k) > uniform."""
    blocks = -(-replicates // 8)
    digests = md5_of_pairs(list(map(str.encode, keys)), [f"|{b}|{seed}".encode() for b in range(blocks)])
    table = np.searchsorted(np.array(poisson_cdf(rate=rate)), np.arange(1 << 16) / 2.0 ** 16,
                            side="right").astype(np.uint8)
    return table[digests.view(">u2").reshape(len(keys), 8 * blocks)[:, :replicates]]
