"""Descriptive tables: rates by group, class comparisons, missingness,
distribution profiles.

Scale notes
-----------
* Every table is one aggregation over the fact (map-side partial aggregation,
  then a shuffle of at most #groups rows per task).  Wide tables are built as
  one wide ``agg`` followed by ``stack`` (an unpivot in the same stage), never
  one job per column.
* The overall rate a group is compared with is a scalar subquery
  (``DataFrame.scalar()``): Spark evaluates it once and inlines the value; no
  join and no driver round trip.
* Rounding follows pandas: round half to even on the scaled value
  (:func:`revlens.functions.expr.round_half_even`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions import expr as X

TARGET = "satisfied"
WEATHER_NUMERIC_COLS = ["weather_prcp", "weather_snow", "weather_snow_depth",
                        "weather_tmax", "weather_tmin", "weather_temp_range"]
WEATHER_BINARY_COLS = ["is_rainy", "is_snowy", "is_hot", "is_cold"]
# Units of the weather variables.
WEATHER_UNITS = {
    "weather_prcp": "mm",
    "weather_snow": "mm",
    "weather_snow_depth": "mm",
    "weather_tmax": "deg C",
    "weather_tmin": "deg C",
    "weather_temp_range": "deg C",
    "is_rainy": "0/1",
    "is_snowy": "0/1",
    "is_hot": "0/1",
    "is_cold": "0/1",
}
DUMMY_LOW_PREVALENCE_PERCENT = 1.0
DUMMY_LOW_ABS_TARGET_CORR = 0.01
R = X.round_half_even


def _stack(wide: DataFrame, names: list[str], fields: list[str], out: list[str]) -> DataFrame:
    """Unpivot ``wide`` (one row, columns ``{name}__{field}``) to one row per name."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts += [f"`{n}__{f}`" for f in fields]
    expr = f"stack({len(names)}, {', '.join(parts)}) as ({', '.join(['variable'] + out)})"
    return wide.selectExpr(expr)


def overall_rate(df: DataFrame, target: str = TARGET) -> Column:
    """Scalar subquery: mean of the target over all rows, in percent."""
    return df.agg((F.avg(target) * 100).alias("o")).scalar()


# --- rates -------------------------------------------------------------------------

def rate_by_group(df: DataFrame, group: str | Column, group_name: str | None = None,
                  min_count: int = 200, sort_by: str = "rate", order: list[str] | None = None,
                  target: str = TARGET) -> DataFrame:
    """Rows, satisfaction rate % and percentage-point gap per group level.

    The gap is the *rounded* rate minus the unrounded overall rate, rounded.
    NULL levels are dropped; groups below ``min_count`` rows are dropped.
    """
    name = group_name or (group if isinstance(group, str) else "group")
    gcol = F.col(group) if isinstance(group, str) else group
    overall = overall_rate(df, target)
    rate_pct = R(F.avg(target) * 100, 2)
    tbl = (df.select(gcol.alias(name), F.col(target))
           .where(F.col(name).isNotNull())
           .groupBy(name)
           .agg(F.count(F.lit(1)).alias("review_count"), rate_pct.alias("satisfaction_rate_percent"))
           .where(F.col("review_count") >= min_count)
           .withColumn("vs_overall_pp", R(F.col("satisfaction_rate_percent") - overall, 2)))
    if order is not None:
        return tbl.orderBy(X.order_index(name, order))
    if sort_by == "rate":
        return tbl.orderBy(F.col("satisfaction_rate_percent").desc(), F.col(name))
    return tbl.orderBy(name)


def rate_by_city(df: DataFrame, min_count: int = 500) -> DataFrame:
    return rate_by_group(df, "city", "city", min_count=min_count)


def rate_by_season(df: DataFrame, min_count: int = 200) -> DataFrame:
    return rate_by_group(df, X.season_of_month("review_month"), "season", min_count,
                         order=X.SEASON_ORDER)


def rate_by_weekday(df: DataFrame, min_count: int = 200) -> DataFrame:
    return rate_by_group(df, X.weekday_name("review_weekday"), "weekday", min_count,
                         order=X.WEEKDAY_NAMES)


def rate_by_year(df: DataFrame, min_count: int = 200) -> DataFrame:
    return rate_by_group(df, "review_year", "review_year", min_count, sort_by="group")


def rate_by_user_bucket(df: DataFrame, min_count: int = 200) -> DataFrame:
    return rate_by_group(df, X.user_bucket("user_review_count"), "user_experience", min_count,
                         order=X.USER_BUCKET_ORDER)


def rate_flag_present_absent(df: DataFrame, flags: list[str] | None = None,
                             target: str = TARGET) -> DataFrame:
    """Per 0/1 flag: rows with flag==1, rate when 1, rate when 0, difference.

    NULL flags are in neither group.  All flags in one scan.
    """
    flags = [c for c in (flags or WEATHER_BINARY_COLS) if c in df.columns]
    aggs = []
    for c in flags:
        v = F.col(c).try_cast("double")
        aggs += [F.count(F.when(v == 1, 1)).alias(f"{c}__n"),
                 (F.avg(F.when(v == 1, F.col(target))) * 100).alias(f"{c}__p"),
                 (F.avg(F.when(v == 0, F.col(target))) * 100).alias(f"{c}__a")]
    long = _stack(df.agg(*aggs), flags, ["n", "p", "a"], ["n", "p", "a"])
    return (long.select(
        F.regexp_replace("variable", "^is_", "").alias("condition"),
        F.col("n").alias("days_present_count"),
        R("p", 2).alias("sat_rate_present_percent"),
        R("a", 2).alias("sat_rate_absent_percent"),
        R(F.col("p") - F.col("a"), 2).alias("difference_pp"))
        .orderBy("difference_pp", "condition"))


def rate_by_tag(df: DataFrame, prefix: str = "category_", top_n: int = 15,
                target: str = TARGET) -> DataFrame:
    """Per 0/1 tag column: tagged rows, their rate and gap (unrounded both);
    the top_n most frequent tags, re-sorted by rate."""
    tags = [c for c in df.columns if c.startswith(prefix)]
    overall = overall_rate(df, target)
    aggs = []
    for c in tags:
        hit = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) == 1
        aggs += [F.count(F.when(hit, 1)).alias(f"{c}__n"),
                 (F.avg(F.when(hit, F.col(target))) * 100).alias(f"{c}__r")]
    long = _stack(df.agg(*aggs), tags, ["n", "r"], ["n", "r"]).where(F.col("n") > 0)
    top = long.orderBy(F.col("n").desc(), F.col("variable")).limit(top_n)
    return (top.select(
        F.expr(f"substring(variable, {len(prefix) + 1})").alias("category"),
        F.col("n").alias("review_count"),
        R("r", 2).alias("satisfaction_rate_percent"),
        R(F.col("r") - overall, 2).alias("vs_overall_pp"))
        .orderBy(F.col("satisfaction_rate_percent").desc(), F.col("category")))


def class_means(df: DataFrame, cols: list[str], target: str = TARGET,
                digits: int = 3) -> DataFrame:
    """Mean of each variable per target class and the satisfied-minus-dissatisfied gap."""
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for c in cols:
        v = F.col(c).try_cast("double")
        aggs += [F.avg(F.when(F.col(target) == 0, v)).alias(f"{c}__d"),
                 F.avg(F.when(F.col(target) == 1, v)).alias(f"{c}__s")]
    long = _stack(df.agg(*aggs), cols, ["d", "s"], ["d", "s"])
    return long.select("variable", R("d", digits).alias("mean_dissatisfied"),
                       R("s", digits).alias("mean_satisfied"),
                       R(F.col("s") - F.col("d"), digits).alias("difference"))


def class_flag_shares(df: DataFrame, flags: list[str] | None = None,
                      target: str = TARGET) -> DataFrame:
    flags = [c for c in (flags or WEATHER_BINARY_COLS) if c in df.columns]
    aggs = []
    for c in flags:
        v = F.col(c).try_cast("double")
        aggs += [(F.avg(F.when(F.col(target) == 0, v)) * 100).alias(f"{c}__d"),
                 (F.avg(F.when(F.col(target) == 1, v)) * 100).alias(f"{c}__s")]
    long = _stack(df.agg(*aggs), flags, ["d", "s"], ["d", "s"])
    return long.select(F.regexp_replace("variable", "^is_", "").alias("weather_condition"),
                       R("d", 2).alias("share_dissatisfied_percent"),
                       R("s", 2).alias("share_satisfied_percent"),
                       R(F.col("s") - F.col("d"), 2).alias("difference_pp"))


def target_distribution(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Rows and % per value (NULL is a value), ordered by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("review_count"))
    total = df.select(F.count(F.lit(1)).alias("t")).scalar()
    return (counts.withColumn("percent", R(F.col("review_count") / total * 100, 2))
            .orderBy(F.col(column).asc_nulls_last()))


# --- missingness / coverage ----------------------------------------------------------

def yearly_coverage(df: DataFrame, year_col: str = "review_year", digits: int = 6) -> DataFrame:
    """Per year: rows and the mean share (%) of missing cells per row.

    Rows with a NULL year are excluded; the cell count includes the year.
    """
    ncols = len(df.columns)
    missing = X.sum_cols([F.col(c).isNull().cast("int") for c in df.columns])
    return (df.where(F.col(year_col).isNotNull())
            .groupBy(F.col(year_col).cast("int").alias(year_col))
            .agg(F.count(F.lit(1)).alias("review_count"),
                 R(F.avg(missing / ncols * 100), digits).alias("missing_percent"))
            .orderBy(year_col))


def dataset_overview(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).alias("columns"),
                  R(F.avg(target) * 100, 2).alias("overall_satisfaction_rate_percent"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing count and % per column (only columns with missing values)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.col(c)).alias(f"{c}__nn") for c in cols])
    long = _stack(wide, cols, ["nn"], ["nn"])
    rows = wide.select("__rows").scalar()
    return (long.select("variable", (rows - F.col("nn")).alias("missing_count"),
                        R((rows - F.col("nn")) / rows * 100, 2).alias("missing_percent"))
            .where(F.col("missing_count") > 0)
            .orderBy(F.col("missing_percent").desc(), F.col("variable")))


def dropped_profile(df: DataFrame, dropped: list[str]) -> DataFrame:
    """For each dropped column: type, non-null, missing, missing %."""
    cols = [c for c in dropped if c in df.columns]
    types = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(f"{c}__nn") for c in cols])
    rows = wide.select("__rows").scalar()
    long = _stack(wide, cols, ["nn"], ["non_null"])
    dtype = F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))]),
                         F.col("variable"))
    return long.select("variable", dtype.alias("dtype"), "non_null",
                       (rows - F.col("non_null")).alias("missing"),
                       R((rows - F.col("non_null")) / rows * 100, 2).alias("missing_percent"))


def availability_profile(df: DataFrame, numeric=None, binary=None, units=None,
                         not_in_model=None, digits: int = 6) -> DataFrame:
    """Per weather column: role, unit, present/missing, missing %, station gap, mean/min/max,
    and whether the column survives the redundancy drop (``in_model``)."""
    if not_in_model is None:
        from revlens.plans.modeldata import DROP_FOR_REDUNDANCY
        not_in_model = DROP_FOR_REDUNDANCY
    numeric = [c for c in (numeric or WEATHER_NUMERIC_COLS) if c in df.columns]
    binary = [c for c in (binary or WEATHER_BINARY_COLS) if c in df.columns]
    units = units or WEATHER_UNITS
    cols = numeric + binary
    all_missing = F.count(F.when(X.sum_cols([F.col(c).isNull().cast("int") for c in cols])
                                 == len(cols), 1))
    aggs = [F.count(F.lit(1)).alias("__rows"), all_missing.alias("__unmatched")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__present"), F.avg(c).alias(f"{c}__mean"),
                 F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    long = _stack(wide, cols, ["present", "mean", "min", "max"], ["present", "mean", "mn", "mx"])
    totals = wide.select("__rows", "__unmatched")
    rows, unmatched = totals.select("__rows").scalar(), totals.select("__unmatched").scalar()
    role = F.when(F.col("variable").isin(*binary), "binary").otherwise("continuous")
    unit = F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(units.get(c, "")))]),
                        F.col("variable"))
    missing = rows - F.col("present")
    return long.select(
        "variable", role.alias("role"), unit.alias("unit"),
        F.col("present").alias("rows_present"), missing.alias("rows_missing"),
        R(missing / rows * 100, 2).alias("missing_pct"),
        (missing - unmatched).alias("station_gap"),
        R("mean", digits).alias("mean"), F.col("mn").alias("min"), F.col("mx").alias("max"),
        F.when(F.col("variable").isin(*not_in_model), "no").otherwise("yes").alias("in_model"))


# --- distribution profiles ----------------------------------------------------------------

def numeric_summary(df: DataFrame, cols: list[str], exact: bool = True,
                    digits: int = 6) -> DataFrame:
    """count / mean / std / min / 25% / 50% / 75% / max per column.

    ``exact`` quantiles interpolate linearly like pandas
    (:func:`revlens.operators.quantiles.quantiles_checked`: ``percentile`` for
    columns with a measured, bounded number of distinct values, the
    distributed exact job for the rest, so no column is ever held by one
    task); ``exact=False`` uses ``percentile_approx`` in the same single scan.
    """
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}__n"), F.avg(v).alias(f"{c}__mean"),
                 F.stddev_samp(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"),
                 F.max(v).alias(f"{c}__max")]
        if not exact:
            aggs.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"{c}__q"))
    fields = ["n", "mean", "std", "min", "max"] + ([] if exact else ["q"])
    long = _stack(df.agg(*aggs), cols, fields, ["n", "mean", "std", "mn", "mx"] +
                  ([] if exact else ["q"]))
    if exact:
        from revlens.operators.quantiles import quantiles_checked
        qs = quantiles_checked(df, cols, [0.25, 0.5, 0.75])
        lookup = F.create_map(*[x for c in cols for x in (
            F.lit(c), F.array(*[F.lit(v).cast("double") for v in qs[c]]))])
        long = long.withColumn("q", F.element_at(lookup, F.col("variable")))
    return long.select(
        "variable", F.col("n").alias("count"), R("mean", digits).alias("mean"),
        R("std", digits).alias("std"), F.col("mn").alias("min"),
        R(F.col("q")[0], digits).alias("p25"), R(F.col("q")[1], digits).alias("p50"),
        R(F.col("q")[2], digits).alias("p75"), F.col("mx").alias("max"))


def skew_g1(c) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``); NULL when n < 3,
    0 for a constant column.  Spark's ``skewness`` is the population g1."""
    v = X.col(c)
    n = F.count(v)
    g1 = F.skewness(v)
    corr = F.sqrt(n * (n - 1)) / (n - 2)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_pop(v) == 0, F.lit(0.0))
            .otherwise(g1 * corr))


def skewness_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Skew of each column raw and after log1p(clip >= 0), and |skew| improvement."""
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for c in cols:
        v = F.col(c).try_cast("double")
        aggs += [skew_g1(v).alias(f"{c}__raw"), skew_g1(X.log1p_clipped(v)).alias(f"{c}__log")]
    long = _stack(df.agg(*aggs), cols, ["raw", "log"], ["raw", "log"])
    return (long.select("variable", R("raw", 3).alias("skew_raw"), R("log", 3).alias("skew_log"),
                        R(F.abs("raw") - F.abs("log"), 3).alias("abs_improvement"))
            .orderBy(F.col("abs_improvement").desc_nulls_last(), "variable"))


def binary_summary(df: DataFrame, cols: list[str], target: str = TARGET) -> DataFrame:
    """Prevalence %, correlation with the target and drop flags per 0/1 column.

    Correlation is pairwise-complete Pearson from sums (no ANSI divide error
    on a constant column: it yields NULL).
    """
    cols = [c for c in cols if c in df.columns]
    y = F.col(target).cast("double")
    aggs = []
    for c in cols:
        v = F.col(c).try_cast("double")
        both = v.isNotNull() & y.isNotNull()
        aggs += [F.count(v).alias(f"{c}__n"), (F.avg(v) * 100).alias(f"{c}__prev"),
                 _pearson(F.when(both, v), F.when(both, y)).alias(f"{c}__r")]
    long = _stack(df.agg(*aggs), cols, ["n", "prev", "r"], ["n", "prev", "r"])
    flags = F.concat_ws("; ", F.when(F.col("prev") < DUMMY_LOW_PREVALENCE_PERCENT, F.lit("rare")),
                        F.when(F.abs("r") < DUMMY_LOW_ABS_TARGET_CORR,
                               F.lit("near-zero target correlation")))
    out = long.select("variable", F.col("n").alias("count"),
                      R("prev", 2).alias("prevalence_percent"),
                      R("r", 4).alias("correlation_with_satisfied"), flags.alias("drop_flag"))
    return out.orderBy(F.abs("correlation_with_satisfied").desc_nulls_last(),
                       F.col("prevalence_percent").desc(), "variable")


def _pearson(x: Column, y: Column) -> Column:
    n = F.count(x)
    sx, sy = F.sum(x), F.sum(y)
    sxx, syy, sxy = F.sum(x * x), F.sum(y * y), F.sum(x * y)
    cov = sxy - sx * sy / n
    vx = sxx - sx * sx / n
    vy = syy - sy * sy / n
    return F.try_divide(cov, F.sqrt(vx * vy))


def categorical_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Levels (NULL counts as a level), most frequent level and its %, missing %.

    One unpivot to (variable, value) and one aggregation per (variable, value);
    the top level is chosen with ``min_by`` over a (-count, value) ordering key
    so ties resolve to the smallest value.
    """
    cols = [c for c in cols if c in df.columns]
    total = df.select(F.count(F.lit(1))).scalar()
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) as (variable, value)")
    counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("variable").agg(
        F.count(F.lit(1)).alias("levels"),
        F.min_by(F.struct(F.col("n"), F.col("value")),
                 F.struct(-F.col("n"), F.coalesce(F.col("value"), F.lit("")))).alias("top"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nmiss"))
    return (per.select("variable", "levels", F.col("top.value").alias("top_level"),
                       R(F.col("top.n") / total * 100, 2).alias("top_level_percent"),
                       R(F.col("nmiss") / total * 100, 2).alias("missing_percent"))
            .orderBy(F.col("levels").desc(), "variable"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (one-row table)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


def block_totals(importance: DataFrame, block_col: str = "block",
                 value_col: str = "importance") -> DataFrame:
    return (importance.groupBy(block_col).agg(F.sum(value_col).alias("total_importance"))
            .orderBy(F.col("total_importance").desc(), block_col))
