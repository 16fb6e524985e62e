"""Queries for the descriptive tables (rates, class comparisons, profiles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.catalog import register
from revlens.functions.expr import sql_round_half_even as RS
from revlens.operators import describe as S
from revlens.plans import dataset as D
from revlens.plans.modeldata import DROP_FOR_REDUNDANCY

fact_sql = D.fact_sql


def _fact(spark, sf, **kw):
    return D.load(spark, sf, **kw)


def _rate_sql(group_expr: str, name: str, min_count: int, order_sql: str) -> str:
    return fact_sql(f"""
        SELECT {name}, review_count, satisfaction_rate_percent,
               {RS('satisfaction_rate_percent - (SELECT avg(satisfied) * 100 FROM rv_fact)', 2)}
                   AS vs_overall_pp
        FROM (SELECT {group_expr} AS {name}, count(*) AS review_count,
                     {RS('avg(satisfied) * 100', 2)} AS satisfaction_rate_percent
              FROM rv_fact WHERE ({group_expr}) IS NOT NULL GROUP BY 1)
        WHERE review_count >= {min_count} ORDER BY {order_sql}""")


@register("rate_by_city", _rate_sql("city", "city", 100, "satisfaction_rate_percent DESC, city"))
def q_rate_by_city(spark, sf):
    return S.rate_by_city(_fact(spark, sf), min_count=100)


@register("rate_by_group", _rate_sql("business_stars", "business_stars", 200,
                                     "satisfaction_rate_percent DESC, business_stars"))
def q_rate_by_group(spark, sf):
    return S.rate_by_group(_fact(spark, sf), "business_stars", min_count=200)


@register("having_min_count", _rate_sql("user_fans", "user_fans", 4700, "user_fans"))
def q_having_min_count(spark, sf):
    return S.rate_by_group(_fact(spark, sf), "user_fans", min_count=4700, sort_by="group")


_SEASON_SQL = ("CASE WHEN review_month IN (12, 1, 2) THEN 'Winter' WHEN review_month IN (3, 4, 5) "
               "THEN 'Spring' WHEN review_month IN (6, 7, 8) THEN 'Summer' "
               "WHEN review_month IN (9, 10, 11) THEN 'Autumn' END")


@register("rate_by_season", _rate_sql(_SEASON_SQL, "season", 200,
                                      "list_position(['Winter','Spring','Summer','Autumn'], season)"))
def q_rate_by_season(spark, sf):
    return S.rate_by_season(_fact(spark, sf))


_WEEKDAY_SQL = "(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'])[review_weekday + 1]"


@register("rate_by_weekday", _rate_sql(_WEEKDAY_SQL, "weekday", 200,
                                       "list_position(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'], weekday)"))
def q_rate_by_weekday(spark, sf):
    return S.rate_by_weekday(_fact(spark, sf))


@register("rate_by_year", _rate_sql("review_year", "review_year", 200, "review_year"))
def q_rate_by_year(spark, sf):
    return S.rate_by_year(_fact(spark, sf))


_BUCKET_SQL = ("CASE WHEN user_review_count IS NULL OR user_review_count < 0 THEN 'Unknown' "
               "WHEN user_review_count <= 1 THEN '1' WHEN user_review_count <= 5 THEN '2-5' "
               "WHEN user_review_count <= 20 THEN '6-20' WHEN user_review_count <= 100 THEN '21-100' "
               "ELSE '100+' END")


@register("rate_by_user_bucket", _rate_sql(
    _BUCKET_SQL, "user_experience", 200,
    "list_position(['1','2-5','6-20','21-100','100+','Unknown'], user_experience)"))
def q_rate_by_user_bucket(spark, sf):
    return S.rate_by_user_bucket(_fact(spark, sf))


FLAGS = ["is_rainy", "is_snowy", "is_hot", "is_cold"]


def _flag_sql() -> str:
    parts = []
    for c in FLAGS:
        p = f"avg(CASE WHEN {c} = 1 THEN satisfied END) * 100"
        a = f"avg(CASE WHEN {c} = 0 THEN satisfied END) * 100"
        parts.append(
            f"SELECT '{c[3:]}' AS condition, count(CASE WHEN {c} = 1 THEN 1 END) AS days_present_count, "
            f"{RS(p, 2)} AS sat_rate_present_percent, {RS(a, 2)} AS sat_rate_absent_percent, "
            f"{RS(f'({p}) - ({a})', 2)} AS difference_pp FROM rv_fact")
    return fact_sql(" UNION ALL ".join(parts))


@register("rate_flag_present_absent", _flag_sql())
def q_rate_flag_present_absent(spark, sf):
    return S.rate_flag_present_absent(_fact(spark, sf), FLAGS)


@register("flag_eq", fact_sql(
    "SELECT count(CASE WHEN is_rainy = 1 THEN 1 END) AS n_eq1, "
    "count(CASE WHEN is_rainy = 0 THEN 1 END) AS n_eq0, "
    "count(CASE WHEN is_rainy IS NULL THEN 1 END) AS n_neither FROM rv_fact"))
def q_flag_eq(spark, sf):
    f = _fact(spark, sf)
    return f.agg(F.count(F.when(F.col("is_rainy") == 1, 1)).alias("n_eq1"),
                 F.count(F.when(F.col("is_rainy") == 0, 1)).alias("n_eq0"),
                 F.count(F.when(F.col("is_rainy").isNull(), 1)).alias("n_neither"))


TAGS = {"category_hours": "review_month >= 6", "category_photo": "photo_count > 0",
        "category_tip": "tip_count > 3", "category_weekend": "review_weekday >= 5",
        "category_never": "1 = 0"}


@register("rate_by_tag", fact_sql(f"""
    SELECT substr(variable, 10) AS category, n AS review_count,
           {RS('r', 2)} AS satisfaction_rate_percent,
           {RS('r - (SELECT avg(satisfied) * 100 FROM rv_fact)', 2)} AS vs_overall_pp
    FROM (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS variable, count(CASE WHEN {v} THEN 1 END) AS n, "
    f"avg(CASE WHEN {v} THEN satisfied END) * 100 AS r FROM rv_fact" for k, v in TAGS.items())
    + """) WHERE n > 0 ORDER BY n DESC, variable LIMIT 3)
    ORDER BY satisfaction_rate_percent DESC, category"""))
def q_rate_by_tag(spark, sf):
    f = _fact(spark, sf)
    f = f.withColumns({k: F.expr(v).cast("int") for k, v in TAGS.items()})
    return S.rate_by_tag(f, top_n=3)


CLASS_COLS = ["weather_tmax", "weather_tmin", "weather_prcp", "business_review_count",
              "checkin_count", "tip_count", "photo_count", "user_review_count", "user_fans",
              "review_text_length", "review_year"]


@register("class_means", fact_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {RS(f'avg(CASE WHEN satisfied = 0 THEN CAST({c} AS DOUBLE) END)', 3)} "
    f"AS mean_dissatisfied, {RS(f'avg(CASE WHEN satisfied = 1 THEN CAST({c} AS DOUBLE) END)', 3)} "
    f"AS mean_satisfied, {RS(f'avg(CASE WHEN satisfied = 1 THEN CAST({c} AS DOUBLE) END) - avg(CASE WHEN satisfied = 0 THEN CAST({c} AS DOUBLE) END)', 3)} "
    f"AS difference FROM rv_fact" for c in CLASS_COLS)))
def q_class_means(spark, sf):
    return S.class_means(_fact(spark, sf), CLASS_COLS)


@register("class_flag_shares", fact_sql(" UNION ALL ".join(
    f"SELECT '{c[3:]}' AS weather_condition, "
    f"{RS(f'avg(CASE WHEN satisfied = 0 THEN CAST({c} AS DOUBLE) END) * 100', 2)} AS share_dissatisfied_percent, "
    f"{RS(f'avg(CASE WHEN satisfied = 1 THEN CAST({c} AS DOUBLE) END) * 100', 2)} AS share_satisfied_percent, "
    f"{RS(f'avg(CASE WHEN satisfied = 1 THEN CAST({c} AS DOUBLE) END) * 100 - avg(CASE WHEN satisfied = 0 THEN CAST({c} AS DOUBLE) END) * 100', 2)} AS difference_pp "
    f"FROM rv_fact" for c in FLAGS)))
def q_class_flag_shares(spark, sf):
    return S.class_flag_shares(_fact(spark, sf), FLAGS)


@register("target_distribution", fact_sql(
    f"SELECT satisfied, count(*) AS review_count, "
    f"{RS('count(*) * 100.0 / (SELECT count(*) FROM rv_fact)', 2)} AS percent "
    f"FROM rv_fact GROUP BY satisfied ORDER BY satisfied"))
def q_target_distribution(spark, sf):
    return S.target_distribution(_fact(spark, sf))


@register("target_distribution_stars", fact_sql(
    f"SELECT review_stars, count(*) AS review_count, "
    f"{RS('count(*) * 100.0 / (SELECT count(*) FROM rv_fact)', 2)} AS percent "
    f"FROM rv_fact GROUP BY review_stars ORDER BY review_stars"))
def q_target_distribution_stars(spark, sf):
    return S.target_distribution(_fact(spark, sf), "review_stars")


COVERAGE_COLS = ["review_year", "review_funny", "weather_prcp", "weather_tmax", "weather_snow",
                 "city", "satisfied"]


@register("yearly_coverage", fact_sql(
    "SELECT CAST(review_year AS INTEGER) AS review_year, count(*) AS review_count, "
    + RS("avg((" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in COVERAGE_COLS)
         + f") / {len(COVERAGE_COLS)} * 100)", 6)
    + " AS missing_percent FROM rv_fact WHERE review_year IS NOT NULL GROUP BY 1 ORDER BY 1"))
def q_yearly_coverage(spark, sf):
    return S.yearly_coverage(_fact(spark, sf).select(*COVERAGE_COLS))


@register("dataset_overview", fact_sql(
    f"SELECT count(*) AS rows, 7 AS columns, {RS('avg(satisfied) * 100', 2)} "
    "AS overall_satisfaction_rate_percent FROM rv_fact"))
def q_dataset_overview(spark, sf):
    return S.dataset_overview(_fact(spark, sf).select(*COVERAGE_COLS))


@register("missing_by_column", fact_sql(
    "SELECT variable, missing_count, "
    + RS("missing_count * 100.0 / (SELECT count(*) FROM rv_fact)", 2)
    + " AS missing_percent FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) - count({c}) AS missing_count FROM rv_fact"
        for c in COVERAGE_COLS) + ") WHERE missing_count > 0"))
def q_missing_by_column(spark, sf):
    return S.missing_by_column(_fact(spark, sf).select(*COVERAGE_COLS))


_DTYPES = {"review_funny": "double", "weather_prcp": "double", "city": "string", "satisfied": "int"}


@register("dropped_profile", fact_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS missing, "
    + RS(f"(count(*) - count({c})) * 100.0 / count(*)", 2) + " AS missing_percent FROM rv_fact"
    for c, t in _DTYPES.items())))
def q_dropped_profile(spark, sf):
    return S.dropped_profile(_fact(spark, sf), list(_DTYPES))


WX_NUM = S.WEATHER_NUMERIC_COLS
WX_BIN = S.WEATHER_BINARY_COLS


def _avail_sql() -> str:
    cols = WX_NUM + WX_BIN
    unmatched = ("(SELECT count(*) FROM rv_fact WHERE "
                 + " AND ".join(f"{c} IS NULL" for c in cols) + ")")
    parts = []
    for c in cols:
        role = "binary" if c in WX_BIN else "continuous"
        parts.append(
            f"SELECT '{c}' AS variable, '{role}' AS role, '{S.WEATHER_UNITS[c]}' AS unit, "
            f"count({c}) AS rows_present, count(*) - count({c}) AS rows_missing, "
            + RS(f"(count(*) - count({c})) * 1.0 / count(*) * 100", 2) + " AS missing_pct, "
            f"count(*) - count({c}) - {unmatched} AS station_gap, "
            + RS(f"avg({c})", 6) + f" AS mean, CAST(min({c}) AS DOUBLE) AS min, "
            f"CAST(max({c}) AS DOUBLE) AS max, "
            f"'{'no' if c in DROP_FOR_REDUNDANCY else 'yes'}' AS in_model FROM rv_fact")
    return fact_sql(" UNION ALL ".join(parts))


@register("availability_profile", _avail_sql())
def q_availability_profile(spark, sf):
    return S.availability_profile(_fact(spark, sf))


NUM_COLS = ["amount", "review_useful", "user_review_count", "tip_count", "weather_tmax"]


@register("numeric_summary", fact_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS count, {RS(f'avg(CAST({c} AS DOUBLE))', 6)} AS mean, "
    f"{RS(f'stddev_samp(CAST({c} AS DOUBLE))', 6)} AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"{RS(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 6)} AS p25, "
    f"{RS(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 6)} AS p50, "
    f"{RS(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 6)} AS p75, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM rv_fact" for c in NUM_COLS)))
def q_numeric_summary(spark, sf):
    return S.numeric_summary(_fact(spark, sf), NUM_COLS)


SKEW_COLS = ["review_useful", "user_review_count", "tip_count", "photo_count", "checkin_count",
             "business_review_count"]


def _g1(x: str) -> str:
    return (f"CASE WHEN count({x}) < 3 THEN NULL WHEN stddev_pop({x}) = 0 THEN 0.0 "
            f"ELSE skewness({x}) END")


@register("skewness_table", fact_sql(
    "SELECT variable, " + RS("sr", 3) + " AS skew_raw, " + RS("sl", 3) + " AS skew_log, "
    + RS("abs(sr) - abs(sl)", 3) + " AS abs_improvement FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {_g1(f'CAST({c} AS DOUBLE)')} AS sr, "
        f"{_g1(f'ln(1 + CASE WHEN CAST({c} AS DOUBLE) < 0 THEN 0 ELSE CAST({c} AS DOUBLE) END)')} AS sl "
        f"FROM rv_fact" for c in SKEW_COLS) + ")"))
def q_skewness_table(spark, sf):
    return S.skewness_table(_fact(spark, sf), SKEW_COLS)


BIN_COLS = ["is_rainy", "is_snowy", "is_hot", "is_cold", "weather_available", "is_open"]


def _corr_sql(x: str, y: str) -> str:
    return (f"(sum({x}*{y}) - sum({x})*sum({y})/count({x})) / "
            f"nullif(sqrt((sum({x}*{x}) - sum({x})*sum({x})/count({x})) * "
            f"(sum({y}*{y}) - sum({y})*sum({y})/count({x}))), 0)")


@register("binary_summary", fact_sql(
    "SELECT variable, count, " + RS("prev", 2) + " AS prevalence_percent, " + RS("r", 4)
    + " AS correlation_with_satisfied, concat_ws('; ', CASE WHEN prev < 1 THEN 'rare' END, "
    "CASE WHEN abs(r) < 0.01 THEN 'near-zero target correlation' END) AS drop_flag FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS count, avg(CAST({c} AS DOUBLE)) * 100 AS prev, "
        + _corr_sql(f"(CASE WHEN satisfied IS NOT NULL THEN CAST({c} AS DOUBLE) END)",
                    f"(CASE WHEN {c} IS NOT NULL THEN CAST(satisfied AS DOUBLE) END)")
        + " AS r FROM rv_fact" for c in BIN_COLS) + ")"))
def q_binary_summary(spark, sf):
    return S.binary_summary(_fact(spark, sf), BIN_COLS)


CAT_COLS = ["city", "state", "attributes_RestaurantsPriceRange2", "station"]


@register("categorical_summary", fact_sql(
    "SELECT variable, levels, top_level, " + RS("top_n * 100.0 / total", 2)
    + " AS top_level_percent, " + RS("nmiss * 100.0 / total", 2) + " AS missing_percent FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) AS levels, "
        f"arg_min_null(v, (-n, coalesce(v, ''))) AS top_level, max(n) AS top_n, "
        f"coalesce(sum(CASE WHEN v IS NULL THEN n END), 0) AS nmiss, "
        f"(SELECT count(*) FROM rv_fact) AS total "
        f"FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM rv_fact GROUP BY 1)"
        for c in CAT_COLS) + ")"))
def q_categorical_summary(spark, sf):
    return S.categorical_summary(_fact(spark, sf), CAT_COLS)
