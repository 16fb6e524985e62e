"""Business-grain and review-grain feature jobs.

Everything that can be computed on a dimension is computed there, before the
fact join: the business table is orders of magnitude smaller than the review
fact, so parsing categories / attribute dicts / opening hours once per
business instead of once per review is the main saving of this module.

Vocabulary-driven columns (top categories, attribute keys) are a two-step
job: one aggregation returns the bounded vocabulary (top-N rows, or the set
of distinct dict keys = future column names) and a second projection builds
the columns.  Only that vocabulary reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from revlens.functions import expr as X

# ---------------------------------------------------------------------------
# Fixed values of the analysed workload.
# ---------------------------------------------------------------------------
PHOTO_LABELS = ["drink", "food", "inside", "menu", "outside"]
CATEGORY_TOP_N = 30
EXCLUDED_CATEGORIES = ["Restaurants"]
ATTRIBUTE_SUBFEATURES = {
    "attributes_Ambience": "ambience",
    "attributes_BusinessParking": "parking",
    "attributes_GoodForMeal": "meal",
}
HOURS_DAYS = [
    ("Monday", "monday"),
    ("Tuesday", "tuesday"),
    ("Wednesday", "wednesday"),
    ("Thursday", "thursday"),
    ("Friday", "friday"),
    ("Saturday", "saturday"),
    ("Sunday", "sunday"),
]
# Engineered hours columns are named exactly; raw flattened hours are
# ``hours_<Day>`` and must not be mistaken for features.
ENGINEERED_BUSINESS_PREFIXES = ("category_", "ambience_", "parking_", "meal_", "hours_open_",
                                "hours_duration_", "hours_total_", "hours_weekend_")

BUSINESS_RENAMES = {"name": "business_name", "stars": "business_stars",
                    "review_count": "business_review_count"}
REVIEW_RENAMES = {"stars": "review_stars", "date": "review_date", "text": "review_text",
                  "useful": "review_useful", "funny": "review_funny", "cool": "review_cool"}
USER_RENAMES = {"name": "user_name", "review_count": "user_review_count",
                "average_stars": "user_average_stars", "useful": "user_useful",
                "funny": "user_funny", "cool": "user_cool", "fans": "user_fans"}

TARGET = "satisfied"


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def rename_and_label(business: DataFrame, reviews: DataFrame, users: DataFrame,
                     threshold: int = 4):
    """Prefix-rename the three tables and add ``satisfied = stars >= 4``.

    A NULL star rating labels 0 (pandas compares NaN >= 4 as False).
    """
    reviews = _rename(reviews, REVIEW_RENAMES)
    reviews = reviews.withColumn(
        TARGET, F.coalesce(F.col("review_stars") >= threshold, F.lit(False)).cast("int"))
    return _rename(business, BUSINESS_RENAMES), reviews, _rename(users, USER_RENAMES)


BUSINESS_KEEP = ["business_id", "business_stars", "business_review_count", "is_open",
                 "city", "state", "latitude", "longitude",
                 "attributes_RestaurantsPriceRange2", "attributes_BusinessAcceptsCreditCards",
                 "attributes_RestaurantsTakeOut", "attributes_RestaurantsDelivery",
                 "attributes_OutdoorSeating", "attributes_BikeParking", "attributes_GoodForKids",
                 "attributes_RestaurantsReservations", "attributes_Alcohol", "attributes_WiFi",
                 "attributes_HasTV", "attributes_NoiseLevel",
                 "attributes_RestaurantsGoodForGroups", "attributes_RestaurantsTableService",
                 "attributes_Caters", "attributes_RestaurantsAttire"]
REVIEW_KEEP = ["review_id", "business_id", "user_id", "review_stars", "review_date",
               "review_useful", "review_funny", "review_cool", "review_text_length", TARGET]
USER_KEEP = ["user_id", "user_review_count", "user_average_stars", "user_useful",
             "user_funny", "user_cool", "user_fans"]


def prune_before_join(business: DataFrame, reviews: DataFrame, users: DataFrame,
                      business_keep=None, review_keep=None, user_keep=None):
    """Text length, drop the text, keep declared columns that exist.

    Length counts code points of the text with NULL as ''.
    """
    if "review_text" in reviews.columns:
        reviews = reviews.withColumn(
            "review_text_length", F.length(F.coalesce(F.col("review_text"), F.lit(""))))
    bkeep = list(business_keep or BUSINESS_KEEP)
    bkeep += [c for c in business.columns if c.startswith(ENGINEERED_BUSINESS_PREFIXES)]
    pick = lambda df, keep: df.select(*[c for c in keep if c in df.columns])
    return (pick(business, bkeep), pick(reviews, review_keep or REVIEW_KEEP),
            pick(users, user_keep or USER_KEEP))


# --- activity tables -------------------------------------------------------------

def checkin_features(checkin: DataFrame, key: str = "business_id") -> DataFrame:
    """Check-ins per business = items in the comma list ('' / NULL -> 0).

    Rows are summed per key, so the result is unique per business whatever
    the input grain; NULL keys are dropped (they can never join).
    """
    return (checkin.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.sum(X.comma_count("date")).cast("long").alias("checkin_count")))


def tip_features(tip: DataFrame, key: str = "business_id") -> DataFrame:
    """Non-null tip texts and total compliments per business (all-NULL sum -> 0)."""
    return (tip.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count("text").alias("tip_count"),
                 F.coalesce(F.sum("compliment_count"), F.lit(0)).cast("long")
                 .alias("tip_compliment_count")))


def photo_features(photo: DataFrame, labels=None, key: str = "business_id") -> DataFrame:
    """Photos per business, in total and per label, in one conditional aggregation.

    Equivalent to a pivot with an explicit label list, without the extra job
    a pivot needs to discover its columns; absent cells are 0, not NULL.
    """
    labels = list(labels or PHOTO_LABELS)
    aggs = [F.count("photo_id").alias("photo_count")]
    aggs += [F.count(F.when(F.col("label") == lab, F.col("photo_id"))).alias(f"photo_{lab}")
             for lab in labels]
    return photo.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def activity_features(checkin: DataFrame | None = None, tip: DataFrame | None = None,
                      photo: DataFrame | None = None, labels=None,
                      key: str = "business_id") -> DataFrame:
    """Check-in, tip and photo features in ONE aggregation.

    The three raw tables are stacked (each row tagged with its source) and
    grouped once by business, so one shuffle replaces three aggregations plus
    the joins between their results.  Values match the three separate jobs
    except that a business absent from one source gets 0 instead of NULL for
    that source's columns -- exactly what the cleaning step fills anyway.
    """
    labels = list(labels or PHOTO_LABELS)
    parts = []
    if checkin is not None:
        parts.append(checkin.select(F.col(key), F.lit("c").alias("__src"),
                                    X.comma_count("date").cast("long").alias("__n"),
                                    F.lit(None).cast("string").alias("__text"),
                                    F.lit(None).cast("long").alias("__cc"),
                                    F.lit(None).cast("long").alias("__pid"),
                                    F.lit(None).cast("string").alias("__label")))
    if tip is not None:
        parts.append(tip.select(F.col(key), F.lit("t").alias("__src"), F.lit(None).cast("long"),
                                F.col("text").cast("string"), F.col("compliment_count").cast("long"),
                                F.lit(None).cast("long"), F.lit(None).cast("string")))
    if photo is not None:
        parts.append(photo.select(F.col(key), F.lit("p").alias("__src"), F.lit(None).cast("long"),
                                  F.lit(None).cast("string"), F.lit(None).cast("long"),
                                  F.col("photo_id").cast("long"), F.col("label").cast("string")))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.union(p)
    aggs = []
    if checkin is not None:
        aggs.append(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("checkin_count"))
    if tip is not None:
        aggs += [F.count("__text").alias("tip_count"),
                 F.coalesce(F.sum("__cc"), F.lit(0)).cast("long").alias("tip_compliment_count")]
    if photo is not None:
        aggs.append(F.count("__pid").alias("photo_count"))
        aggs += [F.count(F.when(F.col("__label") == lab, F.col("__pid"))).alias(f"photo_{lab}")
                 for lab in labels]
    return stacked.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def count_with_breakdown(photo: DataFrame, labels=None, key: str = "business_id") -> DataFrame:
    """Totals plus per-label breakdown: the same single aggregation as photo_features."""
    return photo_features(photo, labels, key)


# --- categories ---------------------------------------------------------------------

def category_counts(business: DataFrame, source: str = "categories",
                    exclude=None) -> DataFrame:
    """(category, n) over all rows; repeats inside one row each count."""
    exclude = list(EXCLUDED_CATEGORIES if exclude is None else exclude)
    items = business.select(F.explode(X.comma_items(source)).alias("category"))
    if exclude:
        items = items.where(~F.col("category").isin(*exclude))
    return items.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def top_categories(business: DataFrame, n: int = CATEGORY_TOP_N, source: str = "categories",
                   exclude=None) -> DataFrame:
    """Top-n categories ordered by (count desc, label asc)."""
    return (category_counts(business, source, exclude)
            .orderBy(F.col("n").desc(), F.col("category").asc())
            .limit(n))


def multi_hot_categories(business: DataFrame, n: int = CATEGORY_TOP_N,
                         source: str = "categories", exclude=None) -> DataFrame:
    """0/1 column per top-n category; the r-th category of one sanitised name
    (in vocabulary order, existing columns first) gets the suffix _r."""
    top = top_categories(business, n, source, exclude)
    base = F.concat(F.lit("category_"), X.sanitize_name("category"))
    taken = F.array(*[F.lit(c) for c in business.columns])
    turn = F.row_number().over(Window.partitionBy("base").orderBy(F.col("n").desc(), "category"))
    named = (top.withColumn("base", base)          # top-n rows: a bounded report
             .withColumn("turn", turn + F.array_contains(taken, F.col("base")).cast("int"))
             .select("category", "n", F.when(F.col("turn") == 1, F.col("base")).otherwise(
                 F.concat_ws("_", "base", "turn")).alias("name")))
    items = X.comma_items(source)
    vocab = named.orderBy(F.col("n").desc(), "category").collect()
    new_cols = {r["name"]: F.array_contains(items, F.lit(r["category"])).cast("int") for r in vocab}
    return business.withColumns(new_cols) if new_cols else business


# --- attribute dictionaries ------------------------------------------------------------

def dict_key_union(business: DataFrame, source: str) -> DataFrame:
    """Sorted distinct keys of a dict-literal column (``key_union``)."""
    return (business.select(F.explode(X.dict_keys(source)).alias("key"))
            .distinct().orderBy("key"))


def multi_hot_dict_keys(business: DataFrame, sources=None) -> DataFrame:
    """0/1 per attribute key, 1 only where the value is the literal True.

    Keys are visited in sorted order; when two keys sanitise to the same name
    the later one wins, as in a plain dict assignment.
    """
    sources = dict(ATTRIBUTE_SUBFEATURES if sources is None else sources)
    new_cols = {}
    for source, prefix in sources.items():
        if source not in business.columns:
            continue
        # the future column names: as many as the dictionary has keys
        names = dict_key_union(business, source).select(
            "key", F.concat(F.lit(f"{prefix}_"), X.sanitize_name("key")).alias("name"))
        true_keys = X.dict_true_keys(source)
        for r in names.orderBy("key").collect():
            new_cols[r["name"]] = F.array_contains(true_keys, F.lit(r["key"])).cast("int")
    return business.withColumns(new_cols) if new_cols else business


# --- opening hours --------------------------------------------------------------------------

def hours_features(business: DataFrame, days=None, source_prefix: str = "hours_") -> DataFrame:
    """Per weekday open flag and duration, plus weekly and weekend totals."""
    days = list(days or HOURS_DAYS)
    if not any(f"{source_prefix}{d}" in business.columns for d, _ in days):
        return business
    cols = {}
    for day, key in days:
        src = f"{source_prefix}{day}"
        if src in business.columns:
            flag, dur = X.hours_parts(src)
        else:
            flag, dur = F.lit(0), F.lit(0.0)
        cols[f"hours_open_{key}"] = flag
        cols[f"hours_duration_{key}"] = dur
    out = business.withColumns(cols)
    keys = [k for _, k in days]
    return out.withColumns({
        "hours_open_days_count": X.sum_cols([F.col(f"hours_open_{k}") for k in keys]),
        "hours_total_weekly_open_hours": X.sum_cols([F.col(f"hours_duration_{k}") for k in keys]),
        "hours_weekend_open": ((F.col("hours_open_saturday") + F.col("hours_open_sunday")) > 0)
        .cast("int"),
        "hours_weekend_open_hours": F.col("hours_duration_saturday")
        + F.col("hours_duration_sunday"),
    })


def business_features(business: DataFrame, top_n: int = CATEGORY_TOP_N, exclude=None,
                      attribute_sources=None) -> DataFrame:
    """Categories, attribute keys and hours, in that order, on the business grain."""
    out = multi_hot_categories(business, top_n, exclude=exclude)
    out = multi_hot_dict_keys(out, attribute_sources)
    return hours_features(out)
