"""Queries for the collinearity screening jobs.

Fixture: numeric columns of lineitem with a nullable copy (``nullif``) and a
near-exact linear combination, so pairwise-complete counts, high-r pairs and
large VIFs all occur.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.catalog import register
from revlens.functions.expr import sql_round_half_even as RS
from revlens.operators import screen as SC
from revlens.sources.tables import Tables

COLS = ["qty", "price", "disc", "tax_n", "qty_mix", "line"]

BASE_SQL = """
    SELECT l_quantity AS qty, l_extendedprice AS price, l_discount AS disc,
           NULLIF(l_tax, 0.0) AS tax_n, l_quantity + l_discount * 10 AS qty_mix,
           CAST(l_linenumber AS DOUBLE) AS line,
           CAST(l_returnflag = 'R' AS INTEGER) AS flag_r,
           CAST(l_linestatus = 'F' AS INTEGER) AS flag_f,
           CAST(l_shipdate >= TIMESTAMP '1999-01-01' AS INTEGER) AS satisfied
    FROM lineitem"""


def base(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select(
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax_n"),
        (F.col("l_quantity") + F.col("l_discount") * 10).alias("qty_mix"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_returnflag") == "R").cast("int").alias("flag_r"),
        (F.col("l_linestatus") == "F").cast("int").alias("flag_f"),
        (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).cast("int")
        .alias("satisfied"))


def _with(body: str) -> str:
    return f"WITH base AS ({BASE_SQL})\n{body}"


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


@register("pairwise_moments", _with(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, count({a} + {b}) AS n, "
    f"{RS(f'corr({a}, {b})', 6)} AS r FROM base" for a, b in _pairs(COLS))))
def q_pairwise_moments(spark, sf):
    m = SC.pairwise_moments(base(spark, sf), COLS).where(F.col("i") < F.col("j"))
    from revlens.functions.expr import round_half_even
    return m.select("feature_1", "feature_2", "n", round_half_even(SC._r_expr(), 6).alias("r"))


@register("correlation_matrix", _with(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {RS(f'corr({a}, {b})', 6)} AS r FROM base"
    for a, b in _pairs(["satisfied"] + COLS))))
def q_correlation_matrix(spark, sf):
    return SC.correlation_long(base(spark, sf), ["satisfied"] + COLS)


@register("target_correlation", _with(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {RS(f'corr(satisfied, {c})', 6)} AS correlation_with_satisfied "
    f"FROM base" for c in COLS)))
def q_target_correlation(spark, sf):
    return SC.target_correlation(base(spark, sf), COLS)


@register("high_corr_pairs", _with(
    "SELECT feature_1, feature_2, " + RS("r", 6) + " AS correlation FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS r FROM base"
        for a, b in _pairs(COLS)) + ") WHERE abs(r) >= 0.5 ORDER BY abs(r) DESC, 1, 2"))
def q_high_corr_pairs(spark, sf):
    return SC.high_corr_pairs(base(spark, sf), COLS, threshold=0.5)


VIF_COLS = ["qty", "disc_n", "qty_mix"]


def _vif_sql() -> str:
    r2 = {
        "qty": ("qd", "qs", "ds"),
        "disc_n": ("qd", "ds", "qs"),
        "qty_mix": ("qs", "ds", "qd"),
    }
    parts = []
    for v, (a, b, c) in r2.items():
        rsq = f"(({a} * {a} + {b} * {b} - 2 * {a} * {b} * {c}) / (1 - {c} * {c}))"
        parts.append(f"SELECT '{v}' AS variable, CASE WHEN {rsq} >= 0.9999 THEN CAST('inf' AS DOUBLE) "
                     f"ELSE {RS(f'1 / (1 - {rsq})', 3)} END AS VIF FROM cc")
    return (f"WITH base AS ({BASE_SQL}), b2 AS (SELECT qty, NULLIF(disc, 0.0) AS disc_n, qty_mix "
            f"FROM base), med AS (SELECT quantile_cont(disc_n, 0.5) AS m FROM b2), "
            f"imp AS (SELECT qty, coalesce(disc_n, m) AS disc_n, qty_mix FROM b2, med), "
            f"cc AS (SELECT corr(qty, disc_n) AS qd, corr(qty, qty_mix) AS qs, "
            f"corr(disc_n, qty_mix) AS ds FROM imp)\n" + " UNION ALL ".join(parts))


@register("vif", _vif_sql())
def q_vif(spark, sf):
    from revlens.functions.expr import round_half_even
    b = base(spark, sf).withColumn("disc_n", F.nullif(F.col("disc"), F.lit(0.0)))
    return SC.vif(b, VIF_COLS).select("variable", round_half_even("VIF", 3).alias("VIF"))


@register("is_binary_column", _with(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, (count({c}) > 0 AND coalesce(bool_and({c} IN (0, 1)), true)) "
    f"AS is_binary FROM base" for c in COLS + ["flag_r", "flag_f"])))
def q_is_binary_column(spark, sf):
    return SC.is_binary_column(base(spark, sf), COLS + ["flag_r", "flag_f"])


@register("vif_reduce")
def q_vif_reduce(spark, sf):
    return SC.vif_reduce(base(spark, sf), COLS)


PAIR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}, {b}) AS r FROM base"
                              for a, b in _pairs(COLS))


# every fixture column has the same drop score, so of a pair the larger name goes
@register("drop_correlated", f"""
    WITH RECURSIVE base AS ({BASE_SQL}),
    pairs AS (SELECT *, row_number() OVER (ORDER BY abs(r) DESC, f1, f2) AS i
              FROM ({PAIR_SQL}) WHERE abs(r) >= 0.5),
    greedy(i, gone, hit) AS (
      SELECT 0::BIGINT, []::VARCHAR[], FALSE
      UNION ALL
      SELECT p.i, CASE WHEN list_contains(gone, f1) OR list_contains(gone, f2) THEN gone
                       ELSE list_append(gone, greatest(f1, f2)) END,
             NOT (list_contains(gone, f1) OR list_contains(gone, f2))
      FROM greedy g JOIN pairs p ON p.i = g.i + 1)
    SELECT greatest(f1, f2) AS variable, 'pairwise_correlation' AS step,
           'highly correlated with ' || least(f1, f2) || ', which comes first' AS reason,
           least(f1, f2) AS correlated_with, round(r, 3) AS correlation, NULL::DOUBLE AS vif
    FROM greedy JOIN pairs USING (i) WHERE hit""")
def q_drop_correlated(spark, sf):
    return SC.drop_correlated(base(spark, sf), COLS, threshold=0.5)


_SCREENED = {"review_useful": "qty", "const": "CAST(1.0 AS DOUBLE)", "all_null": "CAST(NULL AS DOUBLE)"}
_CANDIDATES = {**{c: c for c in [*COLS, "flag_r", "flag_f"]}, **_SCREENED}
_OUT = "'not a candidate: "


@register("candidate_screen", _with(" UNION ALL ".join(
    f"SELECT {'DISTINCT ' if name == 'review_useful' else ''}'{name}' AS variable, " + (
        f"{_OUT}post-review variable' AS kind" if name == "review_useful" else
        f"CASE WHEN count({e}) = 0 THEN {_OUT}all values missing' "
        f"WHEN min({e}) = max({e}) THEN {_OUT}constant numeric variable' "
        f"WHEN bool_and({e} IN (0, 1)) THEN 'binary' ELSE 'continuous' END AS kind") + " FROM base" for name, e in _CANDIDATES.items())))
def q_candidate_screen(spark, sf):
    b = base(spark, sf).withColumns({"review_useful": F.col("qty"), "const": F.lit(1.0),
                                     "all_null": F.lit(None).cast("double")})
    return SC.screen_table(b).select("variable", F.coalesce("reason", "kind").alias("kind"))


@register("compact_select", _with("""
    SELECT CAST(place AS INTEGER) AS rank, variable FROM (
      SELECT variable, row_number() OVER (ORDER BY abs(r) DESC, variable) AS place,
             count(*) FILTER (WHERE abs(r) >= 0.05) OVER () AS strong
      FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS variable, corr(satisfied, {c}) AS r FROM base"
                                     for c in COLS) + """) WHERE r IS NOT NULL)
    WHERE place <= CASE WHEN strong < 2 THEN 2 ELSE least(strong, 4) END"""))
def q_compact_select(spark, sf):
    tc = SC.target_correlation(base(spark, sf), COLS, digits=None).collect()
    chosen = SC.compact_select([(r[0], r[1]) for r in tc], threshold=0.05, min_features=2,
                               max_features=4)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(chosen)],
                                 "rank int, variable string")


@register("screening_workflow")
def q_screening_workflow(spark, sf):
    b = base(spark, sf)
    _, audit = SC.screening_workflow(b, COLS, threshold=0.5)
    return audit
