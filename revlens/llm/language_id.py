"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (from a digest of its code point and
the seed).  An n-gram's vector binds the letters' vectors: the vector of its k-th
letter is permuted n-1-k times (rotated) and the permuted vectors are multiplied
element by element.  A document is the sum (bundle) of its n-grams' vectors, a
language's prototype the bundle of its training documents, and the prediction is the
language whose prototype has the largest cosine with the document.

Texts are reduced to lower-cased letters (one code point each; whatever is not a
letter becomes a space, runs of spaces one space, with a space at both ends) and
read in pieces of bounded size, so texts may have any length.  A batch's distinct
n-grams are made into vectors once; documents are their counts times these vectors.
Prototypes are summed in tasks and then by Spark; predictions take ``block_langs``
of them at a time and keep the best, so any number of languages is compared in
bounded memory.

Defined results: null texts and texts without a letter are ``und`` with score 0, and
so is every text if nothing was learned; rows with a null lang are not learned from;
of languages with equal cosines the first in code point order wins; repeated rows
count as separate documents; empty tables give empty results; other columns are
ignored.  ``score`` is (1 + cosine) / 2.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialize

UNKNOWN = "und"


@dataclass(frozen=True)
class ProfileSpec:
    dim: int = 1024
    n: int = 3  # codes of up to 3 letters fit 64 bits for any alphabet
    seed: int = 13
    batch_docs: int = 256
    piece_chars: int = 1 << 20
    block_grams: int = 16_384
    block_langs: int = 1024


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """Of each code point: its lower-case letter, or a space."""
    table = np.full(0x110000, 0x20, np.uint32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            low = c.lower()
            table[k] = ord(low) if len(low) == 1 and low.isalpha() else k
    return table


@lru_cache(maxsize=16_384)
def letter_vector(code: int, dim: int, seed: int) -> np.ndarray:
    bits = np.frombuffer(hashlib.shake_128(f"{seed}|{code}".encode()).digest((dim + 7) // 8), np.uint8)
    return np.unpackbits(bits)[:dim].astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, spec: ProfileSpec) -> np.ndarray:
    """Bound vectors (grams x dim) of n-grams, given as rows of code points."""
    bound = np.ones((len(grams), spec.dim), np.int8)
    for k in range(spec.n):
        letters, at = np.unique(grams[:, k], return_inverse=True)
        vectors = np.array([np.roll(letter_vector(int(x), spec.dim, spec.seed), spec.n - 1 - k) for x in letters])
        bound *= vectors[at]
    return bound


def pieces(texts: list[str], spec: ProfileSpec):
    """(codes, owner): the symbols of about ``piece_chars`` characters of text and the
    numbers of their texts.  A text that is cut goes on with its last n-1 symbols."""
    parts, numbers, held = [], [], 0
    for k, text in enumerate(texts):
        head = " "
        for at in range(0, max(len(text), 1), spec.piece_chars):
            last = at + spec.piece_chars >= len(text)
            parts.append(head + text[at:at + spec.piece_chars] + (" " if last else ""))
            numbers.append(k)
            held += len(parts[-1])
            if held >= spec.piece_chars or not last:
                codes, owner = _reduced(parts, numbers)
                head = "".join(map(chr, codes[owner == k][-(spec.n - 1):])) if spec.n > 1 else ""
                yield codes, owner
                parts, numbers, held = [], [], 0
    if parts:
        yield _reduced(parts, numbers)


def _reduced(parts: list[str], numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(numbers, [len(p) for p in parts])
    codes = symbols()[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
    keep = codes != 0x20
    keep[1:] |= (codes[:-1] != 0x20) | (owner[1:] != owner[:-1])
    keep[:1] = True
    return codes[keep], owner[keep]


def distinct(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (0 <= value < below) in order, and each value's place there."""
    if below > max(1 << 21, 4 * len(values)):
        return np.unique(values, return_inverse=True)
    seen = np.zeros(below, bool)
    seen[values] = True
    kinds = np.flatnonzero(seen)
    place = np.zeros(below, np.int32)
    place[kinds] = np.arange(len(kinds))
    return kinds, place[values]


def counted(texts: list[str], spec: ProfileSpec):
    """(n-grams as rows of code points, each occurrence's n-gram, its text) of pieces."""
    for codes, owner in pieces(texts, spec):
        if len(codes) < spec.n:
            continue
        letters, code = distinct(codes, 0x110000)
        packed = np.zeros(len(code) - spec.n + 1, np.int64)
        for k in range(spec.n):
            packed = packed * len(letters) + code[k:len(packed) + k]
        whole = owner[:len(packed)] == owner[spec.n - 1:]  # not across two texts
        kinds, gram = distinct(packed[whole], len(letters) ** spec.n)
        digits = [letters[kinds // len(letters) ** (spec.n - 1 - k) % len(letters)] for k in range(spec.n)]
        yield np.stack(digits, axis=1), gram, owner[:len(packed)][whole]


def bundles(texts: list[str], owners: np.ndarray, size: int, spec: ProfileSpec) -> np.ndarray:
    """Sums (size x dim) of the n-gram vectors of the texts of each owner."""
    out = np.zeros((size, spec.dim))
    for grams, gram, text in counted(texts, spec):
        if len(grams) > spec.block_grams:
            order = np.argsort(gram, kind="stable")
            gram, text = gram[order], text[order]
        for at in range(0, len(grams), spec.block_grams):
            stop = min(at + spec.block_grams, len(grams))
            here = slice(None) if len(grams) <= spec.block_grams else slice(*np.searchsorted(gram, [at, stop]))
            cell = owners[text[here]] * (stop - at) + (gram[here] - at)
            counts = np.bincount(cell, minlength=size * (stop - at)).reshape(size, stop - at)
            # sums of about ``piece_chars`` ones at most: exact in single precision
            out += counts.astype(np.float32) @ gram_vectors(grams[at:stop], spec).astype(np.float32)
    return out


def lettered(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def learn(docs: DataFrame, spec: ProfileSpec = ProfileSpec(), *, text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """(lang, prototype): the bundle of each language's texts."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(
        "lang is not null and text is not null")

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def passed_on():
            some = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))],
                names=["lang", "sums"])
            held.clear()
            return some

        for batch in batches:
            for start in range(0, batch.num_rows, spec.batch_docs):
                part = batch.slice(start, spec.batch_docs)
                langs, owner = np.unique(np.array(part.column(0).to_pylist(), object), return_inverse=True)
                sums = bundles(part.column(1).to_pylist(), owner, len(langs), spec)
                for lang, v in zip(langs, sums):
                    held[lang] = held[lang] + v if lang in held else v
                if len(held) >= spec.block_langs:
                    yield passed_on()
        if held:
            yield passed_on()

    sums = rows.mapInArrow(run, "lang string, sums array<double>")
    spread = sums.select("lang", F.posexplode("sums").alias("k", "x"))
    total = spread.groupBy("lang", "k").agg(F.sum("x").alias("x"))
    return materialize(total.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("kx"))
                       .select("lang", F.col("kx.x").alias("prototype")), "prototypes")


def predict(docs: DataFrame, prototypes: DataFrame, spec: ProfileSpec = ProfileSpec(), *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    n = prototypes.count()
    blocks = max(1, -(-n // spec.block_langs))
    scored = rows.withColumns({"lang_pred": F.lit(None).cast("string"), "cosine": F.lit(None).cast("double")})
    for k in range(blocks):
        mine = prototypes if blocks == 1 else prototypes.filter(
            F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k)
        table = mine.orderBy("lang").collect()  # block_langs on average
        scored = scored.mapInArrow(_best([r["lang"] for r in table], [r["prototype"] for r in table], spec),
                                   scored.schema)
    known = F.col("lang_pred").isNotNull()
    return scored.select("doc_id", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
                         F.when(known, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 + F.col("cosine")) / 2)))
                         .otherwise(0.0).alias("score"))


def _best(langs: list[str], vectors: list, spec: ProfileSpec):
    known = np.array(vectors, float).reshape(len(langs), spec.dim)
    norms = np.linalg.norm(known, axis=1, keepdims=True)
    known = known / np.where(norms > 0, norms, 1)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, spec.batch_docs):
                part = batch.slice(start, spec.batch_docs)
                lang, cosine = part.column("lang_pred").to_pylist(), part.column("cosine").to_pylist()
                texts = part.column("text").to_pylist()
                at = [k for k, t in enumerate(texts) if lettered(t)] if langs else []
                found = bundles([texts[k] for k in at], np.arange(len(at)), len(at), spec)
                sizes = np.linalg.norm(found, axis=1, keepdims=True)
                cosines = np.round(found / np.where(sizes > 0, sizes, 1) @ known.T, 12)
                for k, row in zip(at, cosines):
                    best = int(row.argmax())  # the first of equals
                    if cosine[k] is None or (-row[best], langs[best]) < (-cosine[k], lang[k]):
                        lang[k], cosine[k] = langs[best], float(row[best])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(lang, pa.string()),
                     pa.array(cosine, pa.float64())], names=["doc_id", "text", "lang_pred", "cosine"])
    return run
