"""Queries for ranking, sampling, metric, bootstrap and set-operation jobs.

Scored fixture: every order is scored by three "models" (a date-based score
that is informative for the label, a rounded price and a customer-key
residue, the last two full of ties); the label is ``o_orderstatus = 'F'``.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from revlens.catalog import register
from revlens.functions.expr import sql_round_half_even as RS
from revlens.operators import bootstrap as BS
from revlens.operators import metrics as M
from revlens.operators import ranking as RK
from revlens.operators import sampling as SP
from revlens.operators import setops as SO
from revlens.sources.tables import Tables

MODELS = {
    "m_year": ("CAST(2002 - year(o_orderdate) AS DOUBLE)", 4.0),
    "m_price": ("CAST(round(o_totalprice / 10000) AS DOUBLE)", 20.0),
    "m_cust": ("CAST(o_custkey % 50 AS DOUBLE)", 25.0),
}


def scored(spark, sf):
    o = Tables(spark, sf).orders
    frames = []
    for name, (expr, thr) in MODELS.items():
        s = F.expr(expr)
        frames.append(o.select(F.lit(name).alias("model"), F.col("o_orderkey").alias("id"),
                               (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                               s.alias("score"), (s >= thr).cast("int").alias("pred")))
    return SO.union_all(frames)


SCORED_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS model, o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, "
    f"{e} AS score, CAST({e} >= {t} AS INTEGER) AS pred FROM orders"
    for n, (e, t) in MODELS.items())


def _with(body: str, **extra) -> str:
    ctes = {"scored": SCORED_SQL, "hist": "SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg "
            "FROM scored GROUP BY model, score"}
    ctes.update(extra)
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


_AUC_SQL = ("SELECT model, sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc "
            "FROM (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score "
            "ROWS UNBOUNDED PRECEDING) - neg AS neg_below FROM hist) GROUP BY model")


@register("gini", _with("SELECT model, " + RS("2 * auc - 1", 6) + " AS gini FROM auc",
                        auc=_AUC_SQL))
def q_gini(spark, sf):
    return M.gini(scored(spark, sf), by=["model"])


@register("rank_auc", _with("SELECT model, " + RS("auc", 6) + " AS auc FROM auc", auc=_AUC_SQL))
def q_rank_auc(spark, sf):
    from revlens.functions.expr import round_half_even
    a = M.roc_auc(scored(spark, sf), by=["model"])
    return a.select("model", round_half_even("auc", 6).alias("auc"))


_DESC = ("SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED "
         "PRECEDING) AS cum_pos, sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS "
         "UNBOUNDED PRECEDING) AS cum_neg FROM hist")


@register("average_precision", _with(
    "SELECT model, " + RS("sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos)", 6)
    + " AS ap FROM dc GROUP BY model", dc=_DESC))
def q_average_precision(spark, sf):
    return M.average_precision(scored(spark, sf), by=["model"])


@register("average_precision_dissatisfied", _with(
    "SELECT model, " + RS("sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos)", 6)
    + " AS ap FROM dc GROUP BY model",
    hist="SELECT model, -score AS score, sum(1 - y) AS pos, sum(y) AS neg FROM scored "
         "GROUP BY model, -score", dc=_DESC))
def q_average_precision_dissatisfied(spark, sf):
    s = scored(spark, sf).select("model", (1 - F.col("y")).alias("y"),
                                 (-F.col("score")).alias("score"))
    return M.average_precision(s, by=["model"])


@register("pr_curve", _with(
    "SELECT model, score AS threshold, " + RS("cum_pos / (cum_pos + cum_neg)", 6)
    + " AS precision, " + RS("cum_pos / sum(pos) OVER (PARTITION BY model)", 6)
    + " AS recall FROM dc", dc=_DESC))
def q_pr_curve(spark, sf):
    return M.pr_curve(scored(spark, sf), by=["model"])


@register("pr_curve_dissatisfied", _with(
    "SELECT model, score AS threshold, " + RS("cum_pos / (cum_pos + cum_neg)", 6)
    + " AS precision, " + RS("cum_pos / sum(pos) OVER (PARTITION BY model)", 6)
    + " AS recall FROM dc",
    hist="SELECT model, -score AS score, sum(1 - y) AS pos, sum(y) AS neg FROM scored "
         "GROUP BY model, -score", dc=_DESC))
def q_pr_curve_dissatisfied(spark, sf):
    s = scored(spark, sf).select("model", (1 - F.col("y")).alias("y"),
                                 (-F.col("score")).alias("score"))
    return M.pr_curve(s, by=["model"])


@register("confusion_counts", _with("SELECT model, y, pred, count(*) AS n FROM scored "
                                    "GROUP BY model, y, pred"))
def q_confusion_counts(spark, sf):
    return M.confusion_counts(scored(spark, sf), by=["model"])


def _cm_sql() -> str:
    def div(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    p1, r1 = div("tp", "tp + fp"), div("tp", "tp + fn")
    p0, r0 = div("tn", "tn + fn"), div("tn", "tn + fp")
    f1 = f"coalesce(2 * {p1} * {r1} / nullif({p1} + {r1}, 0), 0.0)"
    f0 = f"coalesce(2 * {p0} * {r0} / nullif({p0} + {r0}, 0), 0.0)"
    return _with(
        f"SELECT model, tp, fp, tn, fn, {RS(f'({r1} + {r0}) / 2', 6)} AS balanced_accuracy, "
        f"{RS(p1, 6)} AS precision_1, {RS(r1, 6)} AS recall_1, {RS(f1, 6)} AS f1_1, "
        f"{RS(p0, 6)} AS precision_0, {RS(r0, 6)} AS recall_0, {RS(f0, 6)} AS f1_0, "
        f"{RS(f'({f1} + {f0}) / 2', 6)} AS f1_macro FROM cm",
        cm="SELECT model, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, "
           "count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, "
           "count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, "
           "count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn FROM scored GROUP BY model")


@register("classification_metrics", _cm_sql())
def q_classification_metrics(spark, sf):
    return M.classification_metrics(scored(spark, sf), by=["model"])


@register("top_decile_lift", _with(
    "SELECT model, " + RS("avg(CASE WHEN rk <= greatest(1, round_even(n * 0.1, 0)) THEN y END) "
                          "FILTER (WHERE rk <= greatest(1, round_even(n * 0.1, 0))) / avg(y)", 6)
    + " AS lift FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, id) "
      "AS rk, count(*) OVER (PARTITION BY model) AS n FROM scored) GROUP BY model"))
def q_top_decile_lift(spark, sf):
    return M.top_decile_lift(scored(spark, sf), by=["model"])


@register("top_decile_lift_dissatisfied", _with(
    "SELECT model, " + RS("avg(CASE WHEN rk <= greatest(1, round_even(n * 0.1, 0)) THEN 1 - y END) "
                          "FILTER (WHERE rk <= greatest(1, round_even(n * 0.1, 0))) / avg(1 - y)", 6)
    + " AS lift FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score ASC, id) "
      "AS rk, count(*) OVER (PARTITION BY model) AS n FROM scored) GROUP BY model"))
def q_top_decile_lift_dissatisfied(spark, sf):
    return M.top_decile_lift(scored(spark, sf), by=["model"], pos_label=0)


@register("lift_topk", _with(
    "SELECT model, id, y, score, pred FROM scored WHERE model = 'm_price' "
    "ORDER BY score DESC, id LIMIT 100"))
def q_lift_topk(spark, sf):
    s = scored(spark, sf).where(F.col("model") == "m_price")
    return RK.lift_topk(s, "score", 100, "id")


@register("spearman", """
    SELECT """ + RS("corr(rx, ry)", 6) + """ AS spearman FROM (
      SELECT rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY c) + (count(*) OVER (PARTITION BY c) - 1) / 2.0 AS ry
      FROM (SELECT o_totalprice, CAST(o_custkey % 97 AS DOUBLE) AS c FROM orders))""")
def q_spearman(spark, sf):
    from revlens.functions.expr import round_half_even
    o = Tables(spark, sf).orders.select("o_totalprice",
                                        (F.col("o_custkey") % 97).cast("double").alias("c"))
    return RK.spearman(o, "o_totalprice", "c").select(
        round_half_even("spearman", 6).alias("spearman"))


@register("first_per_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                                   l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")
def q_first_per_key(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_suppkey", "l_quantity")
    return RK.first_per_key(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey",
                                                "l_quantity"])


@register("distinct_keep_first", """
    SELECT c_nationkey, c_custkey, c_name FROM (
      SELECT c_nationkey, c_custkey, c_name, row_number() OVER (PARTITION BY c_nationkey
             ORDER BY c_acctbal, c_custkey) AS rn FROM customer) WHERE rn = 1""")
def q_distinct_keep_first(spark, sf):
    c = Tables(spark, sf).customer
    first = RK.first_per_key(c.select("c_nationkey", "c_acctbal", "c_custkey", "c_name"),
                             "c_nationkey", ["c_acctbal", "c_custkey"])
    return first.select("c_nationkey", "c_custkey", "c_name")


# ---------------------------------------------------------------------------
# Sampling
# ---------------------------------------------------------------------------
HASH_SQL = "md5(CAST(o_orderkey AS VARCHAR) || '|42')"


@register("sample_n", f"SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {HASH_SQL}, "
                      f"o_orderkey LIMIT 1000")
def q_sample_n(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return SP.sample_n(o, 1000, ["o_orderkey"])


def _quota_sql(n_expr: str) -> str:
    return (f"WITH cls AS (SELECT o_orderstatus AS y, count(*) AS c FROM orders GROUP BY 1), "
            f"q0 AS (SELECT y, c, {n_expr} * c / (SELECT sum(c) FROM cls) AS raw, "
            f"floor({n_expr} * c / (SELECT sum(c) FROM cls)) AS fl FROM cls), "
            f"q AS (SELECT y, fl + CASE WHEN row_number() OVER (ORDER BY raw - fl DESC, y) <= "
            f"({n_expr} - (SELECT sum(fl) FROM q0)) THEN 1 ELSE 0 END AS quota FROM q0), "
            f"rk AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus "
            f"ORDER BY {HASH_SQL}, o_orderkey) AS r FROM orders) ")


@register("stratified_sample", _quota_sql("CAST(1000 AS DOUBLE)")
          + "SELECT o_orderkey, o_orderstatus FROM rk JOIN q ON rk.o_orderstatus = q.y "
            "WHERE r <= quota")
def q_stratified_sample(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return SP.stratified_sample(o, "o_orderstatus", 1000, ["o_orderkey"])


@register("stratified_split", _quota_sql("CAST(ceil(0.2 * (SELECT count(*) FROM orders)) AS DOUBLE)")
          + "SELECT o_orderkey, o_orderstatus, CAST(r <= quota AS INTEGER) AS is_test "
            "FROM rk JOIN q ON rk.o_orderstatus = q.y")
def q_stratified_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return SP.stratified_split(o, "o_orderstatus", ["o_orderkey"])


@register("stratified_folds", f"""
    SELECT o_orderkey, o_orderstatus, CAST(floor((row_number() OVER (PARTITION BY o_orderstatus
           ORDER BY {HASH_SQL}, o_orderkey) - 1) * 3 / count(*) OVER (PARTITION BY o_orderstatus))
           AS INTEGER) AS fold FROM orders""")
def q_stratified_folds(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    return SP.stratified_folds(o, "o_orderstatus", ["o_orderkey"])


@register("class_weights", """
    SELECT o_orderkey, y, CAST(CASE WHEN y = 1 THEN n / (2.0 * n1) ELSE n / (2.0 * n0) END
           AS DOUBLE) AS weight
    FROM (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
                 count(*) OVER () AS n,
                 count(*) FILTER (WHERE o_orderstatus = 'F') OVER () AS n1,
                 count(*) FILTER (WHERE o_orderstatus <> 'F') OVER () AS n0 FROM orders)""")
def q_class_weights(spark, sf):
    o = Tables(spark, sf).orders.select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return SP.class_weights(o, "y")


# ---------------------------------------------------------------------------
# Bootstrap and comparison (2,000 resamples of exactly n rows; the draws are
# hashes, so SQL draws the same ones)
# ---------------------------------------------------------------------------
REPLICATES = 2000


def _bootstrap_sql(reference: str, select: str) -> str:
    kmax = SP.POISSON_KMAX
    terms = [f"rate ** {k} / {math.factorial(k)}" for k in range(kmax)]
    cdf = ", ".join(f"exp(-rate) * ({' + '.join(terms[:k + 1])}) AS c{k}" for k in range(kmax))
    weight = " ".join(f"WHEN u < c{k} THEN {k}" for k in range(kmax))
    tail = 0.05 / (2 * (len(MODELS) - 1))
    return _with(
        select,
        digests=f"SELECT o_orderkey AS id, b, md5(o_orderkey || '|' || b || '|{SP.RANDOM_STATE}') AS h "
                f"FROM orders, range(0, {REPLICATES // 8}) AS r(b)",
        uniforms="SELECT id, b * 8 + j AS rep, ('0x' || substr(h, CAST(1 + 4 * j AS INTEGER), 4))::UBIGINT "
                 "/ 65536::DOUBLE AS u FROM digests, range(0, 8) AS s(j)",
        size="SELECT count(*) AS n, greatest(0::DOUBLE, 1 - 6 / sqrt(count(*))) AS rate FROM orders",
        cdf=f"SELECT {cdf} FROM size",
        base=f"SELECT id, rep, CASE {weight} ELSE {kmax} END AS w FROM uniforms, cdf",
        missing="SELECT rep, sum(w) <= n AS able, n - CASE WHEN sum(w) <= n THEN sum(w) ELSE 0 END AS missing "
                "FROM base, size GROUP BY rep, n",
        ranked="SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey::VARCHAR) AS place FROM orders",
        added="SELECT rep, unnest(range(missing::BIGINT)) AS k FROM missing",
        extra=f"SELECT rep, 1 + ('0x' || substr(md5('add|' || rep || '|' || k || '|{SP.RANDOM_STATE}'), 1, 15))::UBIGINT "
              "% n AS place FROM added, size",
        weights="SELECT id, rep, w FROM base SEMI JOIN (FROM missing WHERE able) USING (rep) "
                "UNION ALL SELECT id, rep, 1 FROM extra JOIN ranked USING (place)",
        sums="SELECT model, rep, score, sum(w * y)::DOUBLE AS pos, sum(w * (1 - y))::DOUBLE AS neg "
             "FROM scored JOIN weights USING (id) WHERE w > 0 GROUP BY model, rep, score",
        drawn="SELECT model, rep, 2 * sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) - 1 AS g FROM ("
              "SELECT *, sum(neg) OVER (PARTITION BY model, rep ORDER BY score ROWS UNBOUNDED PRECEDING) "
              "- neg AS below FROM sums) GROUP BY model, rep HAVING sum(pos) > 0 AND sum(neg) > 0",
        auc=_AUC_SQL, point="SELECT model, 2 * auc - 1 AS g FROM auc",
        best=f"SELECT {reference} AS ref",
        deltas="SELECT d.model, d.g, d.g - r.g AS delta FROM drawn d JOIN drawn r ON d.rep = r.rep "
               "WHERE r.model = (SELECT ref FROM best)",
        bounds=f"SELECT model, count(*) AS replicates, quantile_cont(g, [0.025, 0.975]) AS gq, "
               f"quantile_cont(delta, [0.025, 0.975, {tail!r}, {1 - tail!r}]) AS dq FROM deltas GROUP BY model",
        result="SELECT b.*, p.g, p.g - (SELECT g FROM point WHERE model = (SELECT ref FROM best)) AS delta "
               "FROM bounds b JOIN point p USING (model)")


def _r(e: str) -> str:
    return f"round({e}, 6)"


@register("paired_bootstrap", _bootstrap_sql("'m_year'", f"""
    SELECT model, replicates, {_r("g")} AS gini, {_r("gq[1]")} AS gini_lo, {_r("gq[2]")} AS gini_hi,
           {_r("delta")} AS delta_vs_full, {_r("dq[1]")} AS delta_vs_full_lo,
           {_r("dq[2]")} AS delta_vs_full_hi, {_r("dq[3]")} AS delta_bonf_lo,
           {_r("dq[4]")} AS delta_bonf_hi, dq[1] > 0 OR dq[2] < 0 AS differs_from_full,
           dq[3] > 0 OR dq[4] < 0 AS differs_from_full_bonf
    FROM result"""))
def q_paired_bootstrap(spark, sf):
    return BS.paired_bootstrap(scored(spark, sf), "m_year", replicates=REPLICATES)


@register("model_comparison", _bootstrap_sql("(SELECT model FROM point ORDER BY g DESC, model LIMIT 1)", f"""
    SELECT model, {_r("g")} AS gini, (SELECT ref FROM best) AS best, {_r("delta")} AS delta_vs_full,
           {_r("dq[1]")} AS delta_vs_full_lo, {_r("dq[2]")} AS delta_vs_full_hi,
           {_r("dq[3]")} AS delta_bonf_lo, {_r("dq[4]")} AS delta_bonf_hi,
           NOT (dq[3] > 0 OR dq[4] < 0) AS indistinguishable
    FROM result"""))
def q_model_comparison(spark, sf):
    return BS.model_comparison(scored(spark, sf), replicates=REPLICATES)


# ---------------------------------------------------------------------------
# Set operations
# ---------------------------------------------------------------------------

@register("union_all", """
    SELECT o_orderkey AS k, o_totalprice AS v, NULL::VARCHAR AS tag FROM orders
    UNION ALL SELECT l_orderkey AS k, NULL::DOUBLE AS v, l_returnflag AS tag FROM lineitem""")
def q_union_all(spark, sf):
    t = Tables(spark, sf)
    a = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("tag"))
    return SO.union_all([a, b])


_RANK_A = "SELECT p_partkey AS k, p_retailprice AS v FROM part"
_RANK_B = "SELECT p_partkey AS k, CAST(p_size AS DOUBLE) * 31 + p_partkey % 7 AS v FROM part"


@register("overlap_and_difference", f"""
    WITH a AS (SELECT k FROM ({_RANK_A}) ORDER BY v DESC, k LIMIT 25),
         b AS (SELECT k FROM ({_RANK_B}) ORDER BY v DESC, k LIMIT 25)
    SELECT k, 'both' AS membership FROM a WHERE k IN (SELECT k FROM b)
    UNION ALL SELECT k, 'only_a' FROM a WHERE k NOT IN (SELECT k FROM b)
    UNION ALL SELECT k, 'only_b' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def q_overlap_and_difference(spark, sf):
    p = Tables(spark, sf).part
    a = p.select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("v"))
    b = p.select(F.col("p_partkey").alias("k"),
                 (F.col("p_size").cast("double") * 31 + F.col("p_partkey") % 7).alias("v"))
    return SO.overlap_and_difference(a, b, "k", "v", k=25)
