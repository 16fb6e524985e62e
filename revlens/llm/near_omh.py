"""Near-duplicate documents by Order MinHash and banded alignment.

Similarity: a document is the sequence of its runs of five words (all words, if
fewer), each labelled with its occurrence number, so items are distinct within
a document.  Two documents are aligned in order (longest common subsequence
within the band that the threshold allows); the aligned items, divided by the
items of either, must reach ``threshold`` (0.8).

1. Order MinHash: each of ``sketches`` hash functions samples the ``picks``
   labelled k-mers of least value and keeps their order in the text.  Equal
   samples share a bucket; a pair at the threshold misses all 20 buckets with a
   probability of about 1e-6.  Copies of a word sequence are collapsed first.
2. Within a bucket, pairs whose samples agree too rarely for the threshold
   (``min_agree``) or whose lengths differ too much are passed over; the others
   tie the bucket's members together, and only the ties of a spanning forest
   leave the task.  A bucket above ``part_rows`` rows is first compared with its
   pivot; rows tied to the pivot are connected by it.  Where other rows remain, the
   bucket is compared as all pairs of parts that hold a row not tied to the pivot, if
   these hold fewer rows than keying it anew: by single samples of the other sketches,
   so many of them that a pair with ``min_agree`` agreeing samples shares one.  Buckets
   keyed anew, if still too large, are compared with a pivot and then as pairs of parts.  So the ties of a bucket connect the same rows whatever
   its size: a pair at the threshold is missed only if it shares no bucket (1e-6).
3. Candidate groups (components of the ties) are verified exactly: shared items
   are counted over postings, and pairs that can reach the threshold are
   aligned unless already connected.  Large groups are verified as pairs of
   parts.  Verified links leave the task as a spanning forest.
4. Components of the verified links are the classes.

No step emits all pairs of a group, drops rows or caps candidates.

Defined results: words are runs free of ASCII white space; null text counts as
empty; texts with equal words are one class (so are texts without words); the
row with the smallest doc_id stays (nulls last, then by place in the input); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import by_place, join_by_key, like, materialize, small_batches, with_locator
from revlens.llm.components import components

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearSpec:
    words: int = 5
    threshold: float = 0.8
    sketches: int = 20
    picks: int = 3
    #: Agreeing samples, of sketches x picks, that a pair at the threshold shows
    #: (39 expected, standard deviation 5.4).
    min_agree: int = 16
    part_rows: int = 1024
    #: Parts in the exact step hold about so many documents or characters.
    group_rows: int = 2048
    group_chars: int = 16_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' words, one text after another, and words per text."""
    lists = pc.ascii_split_whitespace(texts)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    keyed = flat.dictionary_encode()
    values = np.array([xxhash.xxh3_64_intdigest(w) for w in keyed.dictionary.to_pylist()], np.uint64)
    at = keyed.indices.to_numpy(zero_copy_only=False)
    words = values[at] if len(at) else np.empty(0, np.uint64)
    empty = xxhash.xxh3_64_intdigest("")
    keep = words != np.uint64(empty)  # splitting leaves empty strings at the ends
    if not keep.all():
        owner = np.repeat(np.arange(len(sizes)), sizes)[keep]
        sizes, words = np.bincount(owner, minlength=len(sizes)), words[keep]
    return words, sizes


def labelled(words: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' occurrence-labelled k-mers, and their number per text."""
    n = np.where(sizes > 0, np.maximum(sizes - k + 1, 1), 0)
    stop = np.cumsum(sizes)
    begin = np.repeat(stop - sizes, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    end = np.repeat(stop, n)
    item = np.zeros(len(begin), np.uint64)
    for i in range(k):
        at = begin + i
        inside = at < end
        item = np.where(inside, mixed(item * np.uint64(31) + words[np.where(inside, at, 0)]), item)
    owner = np.repeat(np.arange(len(n)), n).astype(np.uint64)
    tagged = mixed(item + mixed(owner + np.uint64(1)))
    ordered = np.sort(tagged)
    if len(ordered) and (ordered[1:] == ordered[:-1]).any():
        order = np.argsort(tagged, kind="stable")
        same = np.zeros(len(order), bool)
        same[1:] = tagged[order][1:] == tagged[order][:-1]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        label = np.empty(len(order), np.uint64)
        label[order] = (np.arange(len(order)) - first).astype(np.uint64)
        item = np.where(label > 0, mixed(item + label * MIX), item)
    return item, n


def sketch(item: np.ndarray, n: np.ndarray, spec: NearSpec) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the key of each sketch, and 16 bits of each sampled k-mer."""
    docs = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[docs]
    reps = n[docs]
    keys = np.zeros((len(n), spec.sketches), np.uint64)
    bits = np.zeros((len(n), spec.sketches * spec.picks), np.uint16)
    if not len(docs):
        return keys, bits
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for j in range(spec.sketches):
        value = mixed(item + np.uint64((j + 1) * 0xD1B54A32D192ED03 % 2**64))
        place = np.full((len(docs), spec.picks), len(item), np.int64)
        for p in range(spec.picks):
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero((value == np.repeat(least, reps)) & (value != full))
            who, first = np.unique(np.searchsorted(starts, hit, side="right") - 1, return_index=True)
            place[who, p] = hit[first]
            value[hit[first]] = full
        padded = np.append(item, np.uint64(0))
        for p in range(spec.picks):
            bits[docs, j * spec.picks + p] = (padded[place[:, p]] >> np.uint64(20)).astype(np.uint16)
        key = np.full(len(docs), j + 1, np.uint64)
        for p in np.sort(place, axis=1).T:  # in the order of the text
            key = mixed(key + padded[p])
        keys[docs, j] = key
    return keys, bits


def word_digest(words: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    stop = np.cumsum(sizes)
    return [xxhash.xxh3_128_digest(words[s - c:s].tobytes()) for s, c in zip(stop, sizes)]


def _slices(batches, rows=256):
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sketch_table(located: DataFrame, spec: NearSpec) -> DataFrame:
    """doc_id, __file, __row, digest, n_items, n_chars, keys, bits."""
    rows = located.select("doc_id", "__file", "__row", F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches):
        for part in _slices(batches):
            words, sizes = word_hashes(part.column(3))
            item, n = labelled(words, sizes, spec.words)
            keys, bits = sketch(item, n, spec)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2),
                 pa.array(word_digest(words, sizes), pa.binary()), pa.array(n, pa.int64()),
                 pc.utf8_length(part.column(3)).cast(pa.int64()),
                 pa.array([k.view(np.int64) if c else [] for k, c in zip(keys, n)], pa.list_(pa.int64())),
                 pa.array([b.tobytes() for b in bits], pa.binary())],
                names=["doc_id", "__file", "__row", "digest", "n_items", "n_chars", "keys", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, __file string, __row bigint, digest binary, "
                                "n_items bigint, n_chars bigint, keys array<bigint>, bits binary")


class Sets:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)
        return a != b


def _agreeing(bits: np.ndarray, n: np.ndarray, other: np.ndarray, m, spec: NearSpec) -> np.ndarray:
    """Which rows may reach the threshold with another document (or each with its own)."""
    near = np.minimum(n, m) >= spec.threshold * np.maximum(n, m) - 1e-9
    return ((bits == other).sum(axis=1) >= spec.min_agree) & near


def _samples(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(n, -1)


def _ties(spec: NearSpec):
    """Spanning forest of a bucket or of two of its parts: pairs that may reach the threshold.

    Rows that a pivot holds are connected already, so only pairs with a loose row are compared."""
    def run(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("side", "ascending"), ("tied", "descending")])
        digest = batch.column("digest").to_pylist()
        n = batch.column("n_items").to_numpy().astype(float)
        bits = _samples(batch.column("bits"), len(n))
        held = batch.column("tied").to_numpy()
        firsts = int(np.searchsorted(batch.column("side").to_numpy(), 1))
        sets, left, right = Sets(len(n)), [], []
        tied = np.flatnonzero(held).tolist()
        for k in tied[1:]:
            sets.join(tied[0], k)
        # alone, a bucket's held rows come first and each loose row meets all rows before it
        for i in range(len(tied), len(n)) if firsts == len(n) else range(firsts, len(n)):
            before = min(i, firsts)
            for k in np.flatnonzero(_agreeing(bits[:before], n[:before], bits[i], n[i], spec)):
                if sets.join(int(k), i):
                    left.append(digest[k])
                    right.append(digest[i])
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})
    return run


def _tied_to_pivot(spec: NearSpec):
    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("n_items", "pivot_items"))
            tied = _agreeing(_samples(batch.column("bits"), rows), n,
                             _samples(batch.column("pivot_bits"), rows), m, spec)
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("digest"), batch.column("pivot"), pa.array(tied)],
                names=["bucket", "digest", "pivot", "tied"])
    return run


def _pivoted(rows: DataFrame, reps: DataFrame, spec: NearSpec) -> DataFrame:
    """``(bucket, digest)`` with the bucket's pivot (its least digest) and whether the row ties with it."""
    drawn = reps.select("digest", "n_items", "bits")
    pivots = (rows.groupBy("bucket").agg(F.min("digest").alias("pivot"))
              .join(drawn.toDF("pivot", "pivot_items", "pivot_bits"), "pivot"))
    return materialize(
        rows.join(drawn, "digest").join(pivots, "bucket")
        .select("bucket", "digest", "n_items", "bits", "pivot", "pivot_items", "pivot_bits")
        .mapInArrow(_tied_to_pivot(spec), "bucket bigint, digest binary, pivot binary, tied boolean"), "omh-pivots")


def _pivot_ties(pivoted: DataFrame) -> DataFrame:
    return pivoted.filter("tied and digest <> pivot").select(F.col("pivot").alias("a"), F.col("digest").alias("b"))


def _unsettled(pivoted: DataFrame) -> DataFrame:
    """Buckets in which some rows don't tie with the pivot, with the numbers of both kinds.

    Rows that tie with the pivot are connected by it; only pairs with a row that doesn't are open."""
    return (pivoted.groupBy("bucket").agg(F.count_if(~F.col("tied")).alias("loose"),
                                          F.count_if("tied").alias("held")).filter("loose > 0"))


def _dealt_rows(spec: NearSpec) -> Column:
    """Rows that :func:`_parts` makes of a bucket with ``loose`` and ``held`` rows."""
    loose, held = (F.ceil(F.col(c) / spec.part_rows) for c in ("loose", "held"))
    return F.col("held") * loose + F.col("loose") * (loose + held)


def _parts(pivoted: DataFrame, spec: NearSpec) -> DataFrame:
    """Loose rows meet all rows of their bucket, as pairs of parts: loose parts come first, and a
    part of rows held by the pivot meets loose parts only."""
    dealt = pivoted.join(_unsettled(pivoted), "bucket").select(
        "bucket", "digest", "tied", F.ceil(F.col("loose") / spec.part_rows).cast("int").alias("parts"),
        F.ceil(F.col("held") / spec.part_rows).cast("int").alias("held_parts"))
    dealt = dealt.withColumn("part", F.when(
        F.col("tied"), F.col("parts") + F.pmod(F.xxhash64("digest"), F.col("held_parts")))
        .otherwise(F.pmod(F.xxhash64("digest"), F.col("parts"))).cast("int"))
    others = F.when(F.col("tied"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("parts") + F.col("held_parts") - 1))
    meets = F.explode(F.transform(others, lambda o: F.struct(
        F.least(o, F.col("part")).alias("p"), F.greatest(o, F.col("part")).alias("q"))))
    return dealt.withColumn("meet", meets).select(
        "digest", "bucket", "tied", "meet.p", "meet.q",
        ((F.col("part") == F.col("meet.q")) & (F.col("meet.p") < F.col("meet.q"))).cast("int").alias("side"))


def candidate_groups(reps: DataFrame, spec: NearSpec) -> DataFrame:
    """``(node, root)``: documents that may be similar share a root."""
    each = reps.filter("n_items > 0").select("digest", F.posexplode("keys").alias("j", "bucket"))
    size = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(each.join(size, "bucket"), "omh-buckets")
    whole = shared.filter(F.col("n") <= spec.part_rows).select("digest", "bucket", F.lit(False).alias("tied"))
    large = shared.filter(F.col("n") > spec.part_rows)

    def compared(rows):
        if "side" not in rows.columns:
            rows = rows.select("*", *(F.lit(0).alias(c) for c in ("p", "q", "side")))
        return rows.join(reps.select("digest", "n_items", "bits"), "digest").groupBy("bucket", "p", "q").applyInArrow(
            _ties(spec), "a binary, b binary")

    if large.isEmpty():
        return components(compared(whole), "a", "b")
    first = _pivoted(large.select("digest", "bucket"), reps, spec)
    # what the pivots leave open is compared part by part where that makes fewer rows than keying it anew by single
    # samples.  A pair of the bucket agrees in its sketch's picks and in min_agree - picks other samples at least,
    # hence in one of any ``keyed`` others
    others = (spec.sketches - 1) * spec.picks
    keyed = min(others, others - max(spec.min_agree - spec.picks, 1) + 1)
    unsettled = _unsettled(first).select("bucket", (_dealt_rows(spec) <= keyed * (F.col("loose") + F.col("held"))).alias("few"))
    split = first.join(unsettled.filter("few").select("bucket"), "bucket", "left_semi")
    still = large.join(first.join(unsettled.filter("not few").select("bucket"), "bucket", "left_semi")
                       .select("bucket", "digest", "tied"), ["bucket", "digest"])
    places = F.expr(f"slice(filter(sequence(0, {spec.sketches * spec.picks - 1}), p -> p div {spec.picks} <> j), "
                    f"1, {keyed})")
    doubled = still.join(reps.select("digest", "bits"), "digest").withColumn("p", F.explode(places)).select(
        "digest", "tied", F.expr("xxhash64(bucket, p, substring(bits, 2 * p + 1, 2))").alias("bucket"))
    again = doubled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bool_and("tied").alias("settled")).filter(
        "n > 1 and not settled")
    second = materialize(doubled.join(again, "bucket"), "omh-second-buckets")
    whole = whole.unionByName(second.filter(F.col("n") <= spec.part_rows).select("digest", "bucket", "tied"))
    last = _pivoted(second.filter(F.col("n") > spec.part_rows).select("digest", "bucket"), reps, spec)
    ties = compared(whole).unionByName(_pivot_ties(first)).unionByName(_pivot_ties(last)).unionByName(
        compared(_parts(split.unionByName(last), spec)))
    return components(ties, "a", "b")


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two item sequences reach the threshold under banded alignment.

    ``need`` items must align.  Then at most ``len - need`` items of either are
    skipped, so no aligned pair is further than that off the diagonal: matches
    outside the band can't be part of a sufficient alignment.  Items are
    distinct within a sequence, so the alignment is a longest increasing run."""
    need = int(np.ceil(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9))
    if need > min(len(a), len(b)):
        return False
    order = np.argsort(a)
    at = np.searchsorted(a, b, sorter=order)
    at[at == len(a)] = 0
    i = order[at]
    j = np.flatnonzero(a[i] == b)
    i = i[j]
    band = (i - j <= len(a) - need) & (j - i <= len(b) - need)
    i = i[band]
    if len(i) < need:
        return False
    if (i[1:] > i[:-1]).all():
        return True
    ends: list[int] = []
    for x in i.tolist():
        p = bisect_left(ends, x)
        if p == len(ends):
            ends.append(x)
        else:
            ends[p] = x
    return len(ends) >= need


def _verify(spec: NearSpec):
    """Verified links of one pair of parts, as a spanning forest."""
    def run(batch: pa.Table) -> pa.Table:
        texts = batch.column("text")
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        words, sizes = word_hashes(texts)
        found = word_digest(words, sizes)
        claimed = batch.column("digest").to_pylist()
        item, n = labelled(words, sizes, spec.words)
        stop = np.cumsum(n)
        side = np.array(batch.column("side").to_pylist(), np.int64)
        rows, seen = [], set()
        for k in range(len(found)):  # a repeated doc_id brings rows twice, or another text
            if found[k] == claimed[k] and (found[k], side[k]) not in seen:
                seen.add((found[k], side[k]))
                rows.append(k)
        seqs = {k: item[stop[k] - n[k]:stop[k]] for k in rows}
        within = not (side == 1).any()
        first = [k for k in rows if side[k] == 0]
        second = first if within else [k for k in rows if side[k] == 1]
        sets, left, right = Sets(len(found)), [], []
        if first and second:
            owner = np.repeat(np.arange(len(second)), [n[k] for k in second])
            posted = np.concatenate([seqs[k] for k in second])
            order = np.argsort(posted, kind="stable")
            posted, owner = posted[order], owner[order]
            size = np.array([n[k] for k in second])
            for q, k in enumerate(first):
                lo = np.searchsorted(posted, seqs[k], side="left")
                hi = np.searchsorted(posted, seqs[k], side="right")
                spans = hi - lo
                at = np.repeat(lo, spans) + (np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans))
                shared = np.bincount(owner[at], minlength=len(second))
                able = shared * (1 + spec.threshold) >= spec.threshold * (n[k] + size) - 1e-6
                for p in np.flatnonzero(able[:q] if within else able):
                    other = second[p]
                    if sets.find(other) != sets.find(k) and aligned(seqs[other], seqs[k], spec.threshold):
                        sets.join(other, k)
                        left.append(found[other])
                        right.append(found[k])
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})
    return run


def verified_links(located: DataFrame, reps: DataFrame, groups: DataFrame, spec: NearSpec) -> DataFrame:
    """Links ``(a, b)`` between digests that reach the threshold and span each class."""
    members = reps.join(groups.withColumnRenamed("node", "digest"), "digest").select(
        "digest", "root", "rep", "n_chars")
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    placed = materialize(
        join_by_key(members, sizes.filter("n > 1"), ["root"], "n", groups.count())
        .withColumn("parts", F.greatest(F.ceil(F.col("n") / spec.group_rows),
                                        F.ceil(F.col("chars") / spec.group_chars)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
        .select("digest", "root", F.col("rep.__file").alias("__file"), F.col("rep.__row").alias("__row"),
                "parts", "part"), "omh-placed")
    # only the texts of candidates are shuffled
    texts = by_place(located, placed, "left_semi").select(
        "__file", "__row", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # a part meets itself and every other part of its group
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least(o, F.col("part")).alias("p"), F.greatest(o, F.col("part")).alias("q"))))
    pairs = (placed.join(texts, ["__file", "__row"]).withColumn("meet", meets)
             .select("digest", "root", "text", "meet.p", "meet.q",
                     F.when((F.col("part") == F.col("meet.q")) & (F.col("meet.p") < F.col("meet.q")), 1)
                     .otherwise(0).alias("side")))
    return pairs.groupBy("root", "p", "q").applyInArrow(_verify(spec), "a binary, b binary")


@dataclass
class Near:
    #: One row per document: doc_id, class_id, kept, digest, __file, __row.
    rows: DataFrame
    located: DataFrame


def classes(docs: DataFrame, spec: NearSpec = NearSpec()) -> Near:
    located = with_locator(docs)
    with small_batches(docs.sparkSession):
        sketches = materialize(sketch_table(located, spec), "omh-sketches")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__file", "__row")
    reps = materialize(sketches.groupBy("digest").agg(
        F.min(place).alias("rep"), F.first("n_items").alias("n_items"), F.first("n_chars").alias("n_chars"),
        F.first("keys").alias("keys"), F.first("bits").alias("bits")), "omh-reps")
    groups = candidate_groups(reps, spec)
    found = components(verified_links(located, reps, groups, spec), "a", "b")
    named = reps.join(found.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", F.coalesce("root", "digest").alias("root"), "rep")
    keeper = named.groupBy("root").agg(F.min("rep").alias("keeper"))
    by_digest = named.join(keeper, "root").select("digest", "keeper")
    rows = sketches.select("doc_id", "__file", "__row", "digest").join(by_digest, "digest").select(
        "doc_id", F.col("keeper.doc_id").alias("class_id"),
        ((F.col("keeper.__file") == F.col("__file")) & (F.col("keeper.__row") == F.col("__row"))).alias("kept"),
        "digest", "__file", "__row")
    return Near(rows, located)


def drop_near_copies(docs: DataFrame, spec: NearSpec = NearSpec()) -> DataFrame:
    """One document of each class, unchanged."""
    found = classes(docs, spec)
    return like(by_place(found.located, found.rows.filter("not kept"), "left_anti"), docs)
