"""URL filter: rules first, then segmented names scored by naive Bayes.

1. Words.  Unigram counts come from the visible text of all pages; names don't
   count for themselves, so a concatenated name is split where its words are
   known.  Tasks add up locally and Spark sums per word.  Each seed has
   ``seed_share`` of all words (at least one) in addition, so that names with
   seeds that no page's text holds are split at them too.
2. Segmentation.  Distinct runs of letters in hosts are joined with the counts of
   their substrings; a Viterbi pass per run picks the most likely split (a run that
   is a seed stays whole).  An
   unknown piece of n letters has the probability ``unknown * 10^-n / total``.
3. Naive Bayes (multinomial).  A host is a block example if a segmented word is
   in ``seeds``, else an allow example; tokens are the host's words and the
   path's words (digits become their count), weighted by pages.  A token's
   probability in a class is smoothed towards its probability overall with
   ``smoothing`` pseudo-counts, so a token tells nothing where nothing is known.
   Without examples of both classes every url is allowed.
4. Distinct hosts and distinct path shapes are scored once and joined back; hosts
   and shapes with many pages are joined map-side (a bounded list).

A rule fits its host and all its subdomains if the path starts with the rule's;
the longest rule wins over the score.

Defined results: a url that is null or has no ``://`` has empty host and path
and no tokens, so it gets the prior's verdict (allow unless most hosts are
block examples); repeated rows each get a result; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import fold_ascii, join_by_key, materialize

TAG = re.compile(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>")
WORD = re.compile(r"\b[a-z]{2,24}\b")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

#: Words that make a host an example of what to block.
SEEDS = ("adult bet bets betting casino crack drugs escort farm gambling hack jackpot loan loans lottery "
         "malware nude phishing pharma pill pills poker porn replica sex slots spam torrent viagra warez xxx").split()


@dataclass(frozen=True)
class UrlSpec:
    rules: tuple = RULES
    seeds: tuple = tuple(SEEDS)
    unknown: float = 1.0
    smoothing: float = 20.0
    max_word: int = 24
    #: What a seed counts in segmentation beside its page text, as a share of all words.
    seed_share: float = 1e-5


def host_of(url: Column) -> Column:
    return fold_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule's name, else null."""
    found = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), r.name)
             for r in sorted(rules, key=lambda r: -len(r.name))]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def path_shape(path: Column) -> Column:
    """The path's words, lower case, digits as their count, joined by blanks."""
    words = F.filter(F.split(fold_ascii(path), "[^a-z0-9]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.when(
        w.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(w).cast("string"))).otherwise(w)), " ")


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: ASCII words of the visible text of all pages."""
    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                seen.update(WORD.findall(TAG.sub(" ", html or "").lower()))
                if len(seen) > 200_000:  # bounds a task's memory; Spark adds up the rest
                    yield table(seen)
                    seen = Counter()
        yield table(seen)

    def table(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                           pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return (pages.select("html").mapInArrow(count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def with_seeds(words: DataFrame, total: int, spec: UrlSpec) -> tuple[DataFrame, int]:
    """``words`` with the seeds' pseudo-counts added, and the total of both."""
    seeds = sorted(set(spec.seeds))
    if not seeds:
        return words, total
    each = max(1, math.ceil(spec.seed_share * total))
    extra = words.sparkSession.createDataFrame([(w, each) for w in seeds], "word string, n bigint")
    both = words.unionByName(extra).groupBy("word").agg(F.sum("n").alias("n"))
    return both, total + each * len(seeds)


def viterbi(run: str, counts: dict[str, int], total: int, spec: UrlSpec) -> list[str]:
    """The most likely split; ties prefer the longer last word."""
    total = max(total, 1)
    best = [(0.0, 0)]
    for end in range(1, len(run) + 1):
        choices = []
        for start in range(max(0, end - spec.max_word), end):
            n = counts.get(run[start:end])
            cost = (math.log10(total) - math.log10(n) if n
                    else math.log10(total) - math.log10(spec.unknown) + (end - start))
            choices.append((best[start][0] + cost, start))
        best.append(min(choices))
    words, end = [], len(run)
    while end:
        words.append(run[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def segment(runs: DataFrame, words: DataFrame, total: int, spec: UrlSpec) -> DataFrame:
    """run, words: distinct runs of letters and their split."""
    starts = F.sequence(F.lit(1), F.length("run"))
    lengths = F.sequence(F.lit(1), F.lit(spec.max_word))
    parts = (runs.select("run", F.explode(starts).alias("s"))
             .select("run", F.explode(F.transform(lengths, lambda n: F.substring("run", F.col("s"), n))).alias("word"))
             .distinct())
    known = (parts.join(words, "word").groupBy("run")
             .agg(F.collect_list(F.struct("word", "n")).alias("known")))  # at most max_word x length of the run

    seeds = frozenset(spec.seeds)

    def split(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            out = [[run] if run in seeds else viterbi(run, {k["word"]: k["n"] for k in known or ()}, total, spec)
                   for run, known in zip(names, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))],
                                             names=["run", "words"])

    return runs.join(known, "run", "left").select("run", "known").mapInArrow(split, "run string, words array<string>")


def judge(pages: DataFrame, spec: UrlSpec = UrlSpec()) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block)."""
    urls = materialize(
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("shape", path_shape(F.col("path")))
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), spec.rules)), "urls")
    words = materialize(word_counts(pages), "url-words")
    words, total = with_seeds(words, words.agg(F.sum("n")).first()[0] or 0, spec)

    pairs = materialize(urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("pages")), "url-pairs")
    hosts = pairs.groupBy("host").agg(F.sum("pages").alias("pages"))
    host_runs = hosts.select("host", F.explode(F.split("host", "[^a-z]+")).alias("run")).filter("run <> ''")
    split = materialize(segment(host_runs.select("run").distinct(), words, total, spec), "url-split")
    host_words = (host_runs.join(split, "run").select("host", F.explode("words").alias("word")))
    seed = F.col("word").isin(list(spec.seeds))
    bad = host_words.groupBy("host").agg(F.max(seed.cast("int")).alias("block"))
    labelled = materialize(hosts.join(bad, "host", "left").select(
        "host", "pages", F.coalesce("block", F.lit(0)).alias("block")), "url-hosts")

    host_tokens = host_words.select("host", F.concat(F.lit("h:"), "word").alias("token"))
    shape_tokens = (pairs.select("shape").distinct()
                    .select("shape", F.explode(F.split("shape", " ")).alias("word")).filter("word <> ''")
                    .select("shape", F.concat(F.lit("p:"), "word").alias("token")))
    by_shape = (pairs.join(labelled.select("host", "block"), "host")
                .groupBy("shape", "block").agg(F.sum("pages").alias("pages")))
    counts = (host_tokens.join(labelled, "host").select("token", "block", "pages")
              .unionByName(shape_tokens.join(by_shape, "shape").select("token", "block", "pages"))
              .groupBy("token").agg(F.sum(F.when(F.col("block") == 1, F.col("pages")).otherwise(0)).alias("bad"),
                                    F.sum("pages").alias("n")))
    counts = materialize(counts, "url-tokens")
    sums = counts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    n_bad, n_all = float(sums["bad"] or 0), float(sums["n"] or 0)
    prior = labelled.agg(F.sum(F.col("block") * F.col("pages")).alias("bad"), F.sum("pages").alias("n")).first()
    p_bad, p_all = float(prior["bad"] or 0), float(prior["n"] or 0)
    if not 0 < p_bad < p_all or not 0 < n_bad < n_all:
        always = "block" if 0 < p_all == p_bad else "allow"
        return _verdicts(urls.withColumn("score", F.lit(1.0 if always == "block" else -1.0)), spec)

    overall = spec.smoothing * F.col("n") / n_all
    odds = counts.select("token", (
        F.log((F.col("bad") + overall) / (n_bad + spec.smoothing))
        - F.log((F.col("n") - F.col("bad") + overall) / (n_all - n_bad + spec.smoothing))).alias("odds"))
    host_odds = host_tokens.join(odds, "token").groupBy("host").agg(F.sum("odds").alias("host_odds"))
    shape_odds = shape_tokens.join(odds, "token").groupBy("shape").agg(F.sum("odds").alias("shape_odds"))
    zero = F.lit(0.0)
    all_hosts = materialize(labelled.select("host", F.col("pages").alias("host_pages")).join(host_odds, "host", "left")
                            .withColumn("host_odds", F.coalesce("host_odds", zero)), "url-host-odds")
    all_shapes = materialize(pairs.groupBy("shape").agg(F.sum("pages").alias("shape_pages"))
                             .join(shape_odds, "shape", "left")
                             .withColumn("shape_odds", F.coalesce("shape_odds", zero)), "url-shape-odds")
    n_pages = int(p_all)
    scored = join_by_key(join_by_key(urls, all_hosts, ["host"], "host_pages", n_pages),
                         all_shapes, ["shape"], "shape_pages", n_pages)
    return _verdicts(scored.withColumn(
        "score", F.lit(math.log(p_bad) - math.log(p_all - p_bad)) + F.col("host_odds") + F.col("shape_odds")), spec)


def _verdicts(scored: DataFrame, spec: UrlSpec) -> DataFrame:
    by_rule = {r.name: r.verdict for r in spec.rules}
    ruled = F.coalesce(*[F.when(F.col("rule") == name, v) for name, v in by_rule.items()],
                       F.lit(None).cast("string"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        ruled, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
