"""Personal data by bootstrapped contextual extraction.

1. Seeds.  Base patterns find e-mail addresses, IP addresses, card numbers and
   phone numbers in every whole text.  Looser patterns find candidates: other
   strings of the look of an identifier, in places that no base span covers.
2. Patterns.  An occurrence's lexical patterns are its neighbouring words: the
   word before, the two words before, and the words before and after.
3. Pattern-instance graph.  Spark counts pattern-instance edges over the whole
   corpus (seeds with their kind, candidates without) and scores both sides in
   ``rounds`` rounds: a pattern's confidence for a kind is the mean score of
   its distinct instances, smoothed by ``doubt`` instances of score 0; an instance
   that is no seed gets 1 - prod(1 - confidence) over its patterns.  Only patterns
   with at least ``min_seeds`` different seeds of the kind count.
4. A candidate beside a pattern of confidence ``accept`` or more whose look suits
   the kind is added as a span of that kind.  Base spans always stay.

Spans are (kind, start, end) in code points, end exclusive.

Defined results: null text counts as empty and has no spans; an occurrence at an
edge of the text has an empty word there; repeated rows each count and get a
result; rows with a null doc_id get their base spans and added spans too; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialize, with_locator
from revlens.llm.secrets import SPANS, span_array

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}

#: Parts of the base patterns (fixed values), cut so that long runs take linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # whole chains, so no digit is read twice
NUMBER = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Candidates: looser looks of identifiers (bounded repeats, so linear time).
CANDIDATE = re.compile(
    r"(?<![\w@.])[\w.%+-]{1,64}(?:@|\x20?[\[(](?:at|AT)[\])]\x20?|\x20at\x20(?=[\w-]{1,64}\x20dot\x20))"
    r"[\w-]{1,64}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?|\x20dot\x20)[\w-]{1,64}){0,8}"
    r"|(?<![\w.+])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){6,24}(?!\w)"
    r"|(?<![\w.:])(?:[0-9a-fA-F]{1,4}:){3,7}[0-9a-fA-F]{1,4}(?![\w:])")
DIGITS = re.compile(r"[0-9]")
WORD_BEFORE = 64

Span = tuple[str, int, int]


@dataclass(frozen=True)
class PiiSpec:
    rounds: int = 3
    min_seeds: int = 3
    doubt: float = 1.0
    accept: float = 0.75


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    if "@" not in text:
        return
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts = list(NUMBER.finditer(text, chain.start(), chain.end()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                yield four[0].start(), four[3].end()


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    return [(kind, a, b) for kind in KINDS for a, b in FINDERS[kind](text)]


def suits(kind: str, surface: str) -> bool:
    n = len(DIGITS.findall(surface))
    at = "@" in surface or re.search(r"(?i)[\[(]at[\])]|\x20at\x20", surface) is not None
    if kind == "email":
        return at
    if at:
        return False
    if kind == "ip":
        return surface.count(":") >= 3 or (surface.count(".") == 3 and n <= 12)
    return ":" not in surface and (13 <= n <= 19 if kind == "card" else 7 <= n <= 15)


def candidates(text: str, covered: list[Span]) -> list[tuple[int, int]]:
    taken = sorted((a, b) for _, a, b in covered)
    found, k = [], 0
    for m in CANDIDATE.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or taken[k][0] >= m.end():
            found.append(m.span())
    return found


def patterns(text: str, start: int, end: int) -> list[str]:
    before = text[max(0, start - 2 * WORD_BEFORE):start].lower().split()
    after = text[end:end + WORD_BEFORE].lower().split()
    one = before[-1] if before else ""
    two = before[-2] if len(before) > 1 else ""
    right = after[0] if after else ""
    return [f"before {one}", f"before {two} {one}", f"around {one} _ {right}"]


def extract(located: DataFrame) -> DataFrame:
    """doc_id, __file, __row, base_spans and occurrences (of seeds and candidates)."""
    rows = located.select("doc_id", "__file", "__row", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                      ("surface", pa.string()), ("suits", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))])

    def occurrences(text, base):
        for kind, a, b in [*base, *((None, a, b) for a, b in candidates(text, base))]:
            surface = text[a:b]
            yield {"kind": kind, "start": a, "end": b, "surface": surface,
                   "suits": [kind] if kind else [k for k in KINDS if suits(k, surface)],
                   "patterns": patterns(text, a, b)}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(3).to_pylist()
                base = [base_spans(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), span_array(base),
                     pa.array([list(occurrences(t, b)) for t, b in zip(texts, base)], pa.list_(item))],
                    names=["doc_id", "__file", "__row", "base_spans", "occurrences"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, (
        f"doc_id {kind}, __file string, __row bigint, base_spans {SPANS}, occurrences array<struct<kind:string,"
        "start:int,end:int,surface:string,suits:array<string>,patterns:array<string>>>"))


def confident_patterns(occurrences: DataFrame, spec: PiiSpec) -> DataFrame:
    """kind, pattern, confidence of the patterns that may extract."""
    edges = materialize(
        occurrences.select("kind", "surface", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "surface").agg(F.collect_set("kind").alias("kinds")), "pii-edges")
    # patterns with enough different seeds of a kind; each keeps all its instances
    able = (edges.select("pattern", F.explode("kinds").alias("kind")).groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= spec.min_seeds))
    graph = materialize(
        edges.join(able, "pattern").select("pattern", "kind", "surface", (F.size("kinds") > 0).alias("is_seed"),
                                           F.array_contains("kinds", F.col("kind")).alias("own")), "pii-graph")
    score = graph.select("kind", "surface", "is_seed", "own").distinct().groupBy("kind", "surface").agg(
        F.max("is_seed").alias("is_seed"), F.max(F.col("own").cast("double")).alias("score"))
    confidence = None
    for _ in range(spec.rounds):
        confidence = materialize(
            graph.select("pattern", "kind", "surface").join(score, ["kind", "surface"])
            .groupBy("pattern", "kind")
            .agg((F.sum("score") / (F.count(F.lit(1)) + spec.doubt)).alias("confidence")), "pii-patterns")
        belief = (graph.join(confidence, ["pattern", "kind"]).groupBy("kind", "surface").agg(
            F.max("is_seed").alias("is_seed"), F.max(F.col("own").cast("double")).alias("own"),
            (1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))))).alias("belief")))
        score = belief.select("kind", "surface", "is_seed",
                              F.when(F.col("is_seed"), F.col("own")).otherwise(F.col("belief")).alias("score"))
    return confidence.filter(F.col("confidence") >= spec.accept)


def find(docs: DataFrame, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """doc_id, base_spans, spans; both by kind as listed, then start."""
    stored = materialize(extract(with_locator(docs)), "pii-extract")
    each = stored.select("__file", "__row", F.explode("occurrences").alias("o")).select("__file", "__row", "o.*")
    sure = confident_patterns(each, spec)
    added = (each.filter("kind is null").select(
                "__file", "__row", "start", "end", "suits", F.explode(F.array_distinct("patterns")).alias("pattern"))
             .join(sure.withColumnRenamed("kind", "found"), "pattern")
             .filter(F.array_contains("suits", F.col("found")))
             .select("__file", "__row", F.struct(F.col("found").alias("kind"), "start", "end").alias("span")).distinct()
             .groupBy("__file", "__row").agg(F.collect_list("span").alias("added")))
    rank = F.create_map(*[F.lit(x) for kind in KINDS for x in (kind, ORDER[kind])])
    order = F.transform(
        F.array_sort(F.transform(F.concat("base_spans", F.coalesce("added", F.expr(f"cast(array() as {SPANS})"))),
                                 lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"),
                                                    s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return (stored.select("doc_id", "__file", "__row", "base_spans").join(added, ["__file", "__row"], "left")
            .select("doc_id", "base_spans", order.alias("spans")))
