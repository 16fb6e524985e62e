"""Temperature mixing of sources (DataFrame operations only).

Source token shares ``p`` are raised to an exponent ``a`` in [0, 1] and
normalised: ``w = p^a / sum(p^a)``.  Entropy falls and the repetition of small
sources falls as ``a`` grows, so ``a`` is bisected on the grid ``k / 2^16``: the
largest value that reaches the target entropy, raised, where needed, to the
smallest one that repeats no source more than ``max_epochs`` times.  Each source
gets ``floor(budget * w)`` tokens: whole permutations of its documents first
(epochs), then the longest prefix of one more permutation that fits; with
``crossing``, also the document that starts below the budget and ends above it,
so a source is realised to within one document and none with a budget vanishes.
If ``crossing`` is set, a budget of the whole corpus at exponent 1 draws every
document of a source with tokens exactly once.  A draw's position in its source's sequence decides its block, so every block of the mixed
stream holds the sources at their weights.

A permutation orders documents by md5 of seed, epoch and doc_id.  Running token
sums over it are two-level: windows over at most 256 and 4096 sums of key
prefixes, then over the rows of one of 2^20 prefixes of a source; no window
holds a whole source.

Defined results: a token is a run of characters other than ASCII white space;
null text has none; a null source is the source named ''; rows that repeat a
doc_id in a source share their place in the order and are drawn together; a
source without tokens is not drawn; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import like, materialize

GRID = 1 << 16
WAYS = 16
WORD = r"[^\t-\r ]+"


@dataclass(frozen=True)
class MixSpec:
    #: Tokens to draw, as a part of the corpus (at most ``max_epochs`` parts).
    budget_part: float = 1.0
    #: Entropy to reach, as a part of the entropy of equal shares.
    entropy_part: float = 0.95
    #: No source is repeated more often than this.
    max_epochs: float = 4.0
    #: Blocks of the mixed stream.
    blocks: int = 64
    seed: str = "mix"
    #: Draw the document that crosses a source's budget, too.
    crossing: bool = False


def token_table(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_tokens"))


def source_shares(tokens: DataFrame) -> DataFrame:
    sums = (tokens.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
            .filter("source_tokens > 0"))
    return (sums.withColumn("total_tokens", sums.agg(F.sum("source_tokens")).scalar())
            .withColumn("n_sources", sums.agg(F.count(F.lit(1))).scalar())
            .withColumn("share", F.col("source_tokens") / F.col("total_tokens")))


def _probe(shares: DataFrame, steps: list[int], spec: MixSpec) -> list:
    """Entropy and largest repetition at each of a few exponents, one row each."""
    a = F.col("k") / F.lit(float(GRID))
    each = shares.withColumn("k", F.explode(F.array(*map(F.lit, steps)))).withColumn(
        "power", F.exp(a * F.log("share")))
    return (each.groupBy("k").agg(
        F.sum("power").alias("z"), F.sum(F.col("power") * F.log("share")).alias("u"),
        F.max(F.col("power") / F.col("source_tokens")).alias("top"),
        F.first("total_tokens").alias("total_tokens"), F.first("n_sources").alias("n_sources"))
        .select("k", (F.log("z") - a * F.col("u") / F.col("z")
                      >= spec.entropy_part * F.log("n_sources") - 1e-9).alias("entropic"),
                (F.col("top") / F.col("z") * budget(spec) <= spec.max_epochs + 1e-9).alias("fresh"))
        .collect())


def budget(spec: MixSpec):
    return F.floor(F.col("total_tokens") * F.lit(float(min(spec.budget_part, spec.max_epochs))))


def solve_exponent(shares: DataFrame, spec: MixSpec) -> float:
    """The exponent; the driver sees ``2 * WAYS`` truth values a round."""
    def narrowed(lo: int, hi: int, flags: dict, last_true: bool) -> tuple[int, int]:
        points = sorted(k for k in flags if lo <= k <= hi)
        if last_true:  # true up to the answer
            low = max([k for k in points if flags[k]], default=lo)
            return low, min([k for k in points if k > low], default=hi)
        high = min([k for k in points if flags[k]], default=hi)
        return max([k for k in points if k < high], default=lo), high

    ent, rep = (0, GRID), (0, GRID)
    while ent[1] - ent[0] > 1 or rep[1] - rep[0] > 1:
        steps = sorted({lo + (hi - lo) * i // WAYS for lo, hi in (ent, rep) for i in range(WAYS + 1)})
        rows = _probe(shares, steps, spec)
        if not rows:
            return 1.0
        ent = narrowed(*ent, {r.k: r.entropic for r in rows}, True)
        rep = narrowed(*rep, {r.k: r.fresh for r in rows}, False)
    ends = {r.k: r for r in _probe(shares, sorted({*ent, *rep}), spec)}
    if not ends:
        return 1.0
    k_ent = ent[1] if ends[ent[1]].entropic else ent[0]
    k_rep = rep[0] if ends[rep[0]].fresh else rep[1]
    return max(k_ent, k_rep) / GRID


def source_budgets(shares: DataFrame, exponent: float, spec: MixSpec) -> DataFrame:
    """source, source_tokens, weight, source_budget, epochs (whole), rest (tokens of the last one)."""
    powers = shares.withColumn("power", F.exp(F.lit(exponent) * F.log("share")))
    drawn = F.floor(budget(spec) * F.col("weight") + 1e-6)
    if spec.crossing and exponent == 1.0 and min(spec.budget_part, spec.max_epochs) == 1.0:
        drawn = F.col("source_tokens")  # the weights are the shares: no rounding
    return (powers.withColumn("weight", F.col("power") / powers.agg(F.sum("power")).scalar())
            .withColumn("source_budget", drawn)
            .filter("source_budget > 0")
            .withColumn("epochs", F.expr("source_budget div source_tokens"))
            .withColumn("rest", F.expr("source_budget % source_tokens"))
            .select("source", "source_tokens", "weight", "source_budget", "epochs", "rest"))


def draw_key(epoch, spec: MixSpec):
    return F.md5(F.concat_ws("|", F.lit(spec.seed), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def schedule(tokens: DataFrame, budgets: DataFrame, spec: MixSpec) -> DataFrame:
    """One row per draw: doc_id, source, epoch, block, position, n_tokens, draw_key."""
    draws = (tokens.join(budgets, "source")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("epochs"))))
             .withColumn("draw_key", draw_key(F.col("epoch"), spec))
             .withColumn("a", F.substring("draw_key", 1, 2))
             .withColumn("b", F.substring("draw_key", 3, 3)))
    seq = ["source", "epoch"]
    fine = draws.groupBy(*seq, "a", "b").agg(F.sum("n_tokens").alias("s"))
    coarse = fine.groupBy(*seq, "a").agg(F.sum("s").alias("s"))
    zero = F.lit(0).cast("bigint")

    def running(df, keys, order, name):
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("s").over(w), zero)).drop("s")

    base = (running(fine, [*seq, "a"], "b", "base_b")
            .join(running(coarse, seq, "a", "base_a"), [*seq, "a"])
            .withColumn("base", F.col("base_a") + F.col("base_b")).drop("base_a", "base_b"))
    inside = (Window.partitionBy(*seq, "a", "b").orderBy("draw_key")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    placed = draws.join(base, [*seq, "a", "b"]).withColumn("through", F.col("base") + F.sum("n_tokens").over(inside))
    fits = F.col("through") <= F.col("rest")
    if spec.crossing:
        tied = Window.partitionBy(*seq, "a", "b", "draw_key")
        placed = placed.withColumn("start", F.col("through") - F.sum("n_tokens").over(tied))
        fits = F.col("start") < F.col("rest")
    return (placed.filter((F.col("epoch") < F.col("epochs")) | fits)
            .withColumn("position", F.col("epoch") * F.col("source_tokens") + F.col("through"))
            .withColumn("block", F.expr(
                f"greatest(least(position, source_budget) - 1, 0L) * {spec.blocks}L div source_budget"))
            .select("doc_id", "source", "epoch", "block", "position", "n_tokens", "draw_key"))


@dataclass
class Mix:
    tokens: DataFrame
    budgets: DataFrame
    draws: DataFrame
    exponent: float


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> Mix:
    tokens = materialize(token_table(docs), "mix-tokens")
    shares = materialize(source_shares(tokens), "mix-shares")
    exponent = solve_exponent(shares, spec)
    budgets = source_budgets(shares, exponent, spec)
    return Mix(tokens, budgets, schedule(tokens, budgets, spec), exponent)


def mixed_rows(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The drawn rows of ``docs``, a row as often as it is drawn.

    Only the cut of each source's last permutation is joined to ``docs``
    (sources x epochs rows); texts are not shuffled."""
    mixed = mix(docs, spec)
    last = (mixed.draws.groupBy("source", "epoch").agg(F.max("draw_key").alias("last_key")))
    cuts = materialize(
        last.join(mixed.budgets, "source")
        .select(F.col("source").alias("__mix_source"), F.col("epoch").alias("__mix_epoch"),
                F.when(F.col("epoch") < F.col("epochs"), F.lit("g")).otherwise(F.col("last_key")).alias("__mix_cut")),
        "mix-cuts")
    keep = ((F.coalesce(F.col("source"), F.lit("")) == F.col("__mix_source"))
            & (draw_key(F.col("__mix_epoch"), spec) <= F.col("__mix_cut")))
    return like(docs.join(cuts, keep), docs)
