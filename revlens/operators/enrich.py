"""Fact enrichment, cleaning, standardisation and scope jobs.

Join plan of :func:`enrich_fact`: the activity features (check-ins, tips,
photos) are computed in one aggregation at business grain and joined to the
business dimension *on the business grain* (full outer, keeping feature rows
of businesses the dimension lacks, exactly as chained left joins from the
fact would).  The fact then meets one business-grain table and the user
table: two fact-sized joins instead of five.  The join type is left to AQE:
a side whose measured size is under the threshold is broadcast, otherwise the
join is a sort-merge join whose skewed keys are split.  Literal lookup tables
(scope pairs, city aliases) have a fixed size and are broadcast explicitly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions import expr as X
from revlens.functions.city_aliases import (CANONICAL_PHILADELPHIA, CITY_ALIASES, MIN_REVIEW_YEAR,
                                           PHILADELPHIA_VARIANTS, SCOPE_PAIRS)
from revlens.operators.features import ENGINEERED_BUSINESS_PREFIXES

# Columns that get the 'Unknown' level, and zero-filled counts.
CATEGORICAL_COLUMNS = [
    "city", "state",
    "attributes_RestaurantsPriceRange2", "attributes_BusinessAcceptsCreditCards",
    "attributes_RestaurantsTakeOut", "attributes_RestaurantsDelivery",
    "attributes_OutdoorSeating", "attributes_BikeParking", "attributes_GoodForKids",
    "attributes_RestaurantsReservations", "attributes_Alcohol", "attributes_WiFi",
    "attributes_HasTV", "attributes_NoiseLevel", "attributes_RestaurantsGoodForGroups",
    "attributes_RestaurantsTableService", "attributes_Caters", "attributes_RestaurantsAttire",
]
COUNT_COLUMNS = ["checkin_count", "tip_count", "tip_compliment_count", "photo_count",
                 "photo_drink", "photo_food", "photo_inside", "photo_menu", "photo_outside"]
VOTE_COLUMNS = ["review_useful", "review_funny", "review_cool"]


def business_dimension(business: DataFrame, *features: DataFrame,
                       key: str = "business_id") -> DataFrame:
    """Business rows plus per-business feature tables, on the business grain."""
    return reduce(lambda acc, f: acc.join(f, key, "full"), features, business)


def enrich_fact(reviews: DataFrame, business: DataFrame, users: DataFrame,
                checkin_f: DataFrame | None = None, tip_f: DataFrame | None = None,
                photo_f: DataFrame | None = None,
                activity: DataFrame | None = None) -> DataFrame:
    """One wide row per review: review LEFT business(+features) LEFT user.

    Right sides are not required to be unique: duplicate keys fan out, as in
    the chained left joins this replaces.  NULL keys never match.
    ``activity`` is the combined per-business feature table
    (:func:`revlens.operators.features.activity_features`) and replaces the
    three separate ones.
    """
    feats = [f for f in (activity, checkin_f, tip_f, photo_f) if f is not None]
    dim = business_dimension(business, *feats)
    return reviews.join(dim, "business_id", "left").join(users, "user_id", "left")


def normalize_attribute_levels(df: DataFrame, prefix: str = "attributes_") -> DataFrame:
    """Strip Python repr quotes from every string ``attributes_*`` column."""
    cols = {f.name: X.strip_repr_quotes(f.name) for f in df.schema.fields
            if f.name.startswith(prefix) and f.dataType.simpleString() == "string"}
    return df.withColumns(cols) if cols else df


def attribute_level_counts(df: DataFrame, prefix: str = "attributes_") -> DataFrame:
    """Distinct levels per attribute column before and after quote stripping."""
    cols = [f.name for f in df.schema.fields
            if f.name.startswith(prefix) and f.dataType.simpleString() == "string"]
    aggs = []
    for c in cols:
        aggs += [F.count_distinct(c).alias(f"{c}__before"),
                 F.count_distinct(X.strip_repr_quotes(c)).alias(f"{c}__after")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__before`, `{c}__after`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (variable, levels_before, levels_after)")


def clean_values(df: DataFrame, categorical=None, counts=None, votes=None,
                 date_col: str = "review_date") -> DataFrame:
    """Zero-fill counts and engineered columns, 'Unknown' levels, date parts, clip votes."""
    categorical = CATEGORICAL_COLUMNS if categorical is None else categorical
    counts = COUNT_COLUMNS if counts is None else counts
    votes = VOTE_COLUMNS if votes is None else votes
    cols = {}
    for c in counts:
        if c in df.columns:
            cols[c] = F.coalesce(F.col(c), F.lit(0))
    for c in df.columns:
        if c.startswith(ENGINEERED_BUSINESS_PREFIXES):
            cols[c] = X.zero_fill(c)
    for c in categorical:
        if c in df.columns:
            cols[c] = X.unknown_level(c)
    if date_col in df.columns:
        d = F.col(date_col).try_cast("timestamp_ntz") if dict(df.dtypes)[date_col] == "string" \
            else F.col(date_col)
        cols[date_col] = d
        cols["review_year"] = F.year(d)
        cols["review_month"] = F.month(d)
        cols["review_weekday"] = X.weekday0(d)
    for c in votes:
        if c in df.columns:
            cols[c] = X.clip_lower(X.to_number(c), 0)
    return df.withColumns(cols)


# --- city standardisation -----------------------------------------------------

def alias_table(spark: SparkSession, aliases=None) -> DataFrame:
    return spark.createDataFrame(list(aliases or CITY_ALIASES), "variant string, canonical string")


def standardize_city(df: DataFrame, aliases: DataFrame | None = None,
                     city: str = "city") -> DataFrame:
    """Trim/collapse the city, then map known variants to their canonical name.

    The alias table is a literal of fixed size, so it is broadcast.
    """
    aliases = aliases if aliases is not None else alias_table(df.sparkSession)
    cleaned = df.withColumn(city, X.collapse_ws(city))
    a = F.broadcast(aliases.select(F.col("variant").alias("__variant"),
                                   F.col("canonical").alias("__canonical")))
    return (cleaned.join(a, cleaned[city] == a["__variant"], "left")
            .withColumn(city, F.coalesce(F.col("__canonical"), F.col(city)))
            .drop("__variant", "__canonical"))


def _raw_city(city: str):
    return X.trim_ws(F.coalesce(F.col(city).cast("string"), F.lit("Unknown")))


def variant_filter(df: DataFrame, variants=None, canonical=None,
                   city: str = "city") -> DataFrame:
    """Rows whose stripped raw city (NULL -> 'Unknown') is one of ``variants``
    but none of the ``canonical`` spellings; the city is returned stripped."""
    variants = PHILADELPHIA_VARIANTS if variants is None else variants
    canonical = CANONICAL_PHILADELPHIA if canonical is None else canonical
    raw = _raw_city(city)
    return (df.withColumn(city, raw)
            .where(F.col(city).isin(*variants) & ~F.col(city).isin(*canonical)))


def variant_counts(df: DataFrame, variants=None, canonical=None, city: str = "city",
                   top_n: int = 12) -> DataFrame:
    return (variant_filter(df, variants, canonical, city)
            .groupBy(city).agg(F.count(F.lit(1)).alias("reviews"))
            .orderBy(F.col("reviews").desc(), F.col(city)).limit(top_n))


# --- scope ----------------------------------------------------------------------

def filter_min_year(df: DataFrame, min_year: int = MIN_REVIEW_YEAR,
                    year_col: str = "review_year") -> DataFrame:
    """Keep year >= min_year (NULL years drop)."""
    return df.where(F.col(year_col) >= min_year)


def scope_table(spark: SparkSession, pairs=None, city: str = "city",
                state: str = "state") -> DataFrame:
    return spark.createDataFrame(list(pairs or SCOPE_PAIRS), f"{city} string, {state} string")


def filter_scope(df: DataFrame, scope: DataFrame, keys=("city", "state"),
                 check_empty: bool = False) -> DataFrame:
    """Inner join on the (fixed, small, broadcast) scope pairs.

    Scope pairs are unique, so a semi join returns exactly the inner join's
    rows without carrying the scope columns.
    """
    out = df.join(F.broadcast(scope.select(*keys).distinct()), list(keys), "left_semi")
    if check_empty and out.limit(1).count() == 0:
        raise ValueError("scope filter removed every row")
    return out


def anti_join_missing(df: DataFrame, scope: DataFrame, keys=("city", "state")) -> DataFrame:
    """Scope pairs with zero rows in ``df``."""
    present = df.select(*keys).distinct()
    return scope.select(*keys).distinct().join(present, list(keys), "left_anti")


def scope_summary(df: DataFrame, keys=("city", "state")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("reviews"))


def year_summary(df: DataFrame, year_col: str = "review_year") -> DataFrame:
    return df.groupBy(year_col).agg(F.count(F.lit(1)).alias("reviews"))


def market_topn(df: DataFrame, city: str = "city", state: str = "state", top_n: int = 15,
                min_year: int | None = MIN_REVIEW_YEAR,
                year_col: str = "review_year") -> DataFrame:
    """Top markets by review count: label 'city, state' (each part stripped,
    NULL -> 'Unknown'), ties by label."""
    if min_year is not None:
        df = df.where(F.col(year_col) >= min_year)
    label = F.concat_ws(", ", _raw_city(city), _raw_city(state))
    return (df.groupBy(label.alias("market")).agg(F.count(F.lit(1)).alias("reviews"))
            .orderBy(F.col("reviews").desc(), F.col("market")).limit(top_n))


def select_model_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered projection of the declared columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast integral, null-free numeric columns to the smallest integer type.

    One aggregation gathers min, max, null count and an integrality test for
    every numeric column; the casts are then a projection.
    """
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")]
    if not numeric:
        return df
    aggs = []
    for c in numeric:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                 F.count(c).alias(f"{c}__nn"),
                 F.bool_and(F.col(c) == F.floor(c)).alias(f"{c}__int")]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    stats = df.agg(*aggs).first()
    casts = {}
    for c in numeric:
        lo, hi, nn, integral = (stats[f"{c}__min"], stats[f"{c}__max"],
                                stats[f"{c}__nn"], stats[f"{c}__int"])
        if lo is None or nn != stats["__rows"] or not integral:
            continue
        for t, (a, b) in (("tinyint", (-128, 127)), ("smallint", (-32768, 32767)),
                          ("int", (-2**31, 2**31 - 1)), ("bigint", (-2**63, 2**63 - 1))):
            if a <= lo and hi <= b:
                casts[c] = F.col(c).cast(t)
                break
    return df.withColumns(casts) if casts else df


def narrow_types_plan(df: DataFrame) -> DataFrame:
    """The per-column decision of :func:`narrow_types` as a table."""
    out = narrow_types(df)
    before, after = dict(df.dtypes), dict(out.dtypes)
    rows = [(c, before[c], after[c]) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "variable string, dtype_before string, dtype_after string")
