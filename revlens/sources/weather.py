"""Daily weather: landed station feeds -> labelled, cleaned, de-duplicated
rows keyed by (city, state, date).

The HTTP download of the analysed workload is replaced by landed files: a
feed with one row per (station, day) and a station->city map.  One station
can serve several cities, so the label join is one-to-many by design.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from revlens.functions import expr as X

# Raw NOAA variable -> feature name.
RENAME_MAP = {
    "PRCP": "weather_prcp",
    "SNOW": "weather_snow",
    "SNWD": "weather_snow_depth",
    "TMAX": "weather_tmax",
    "TMIN": "weather_tmin",
}
WEATHER_NUMERIC_COLS = ["weather_prcp", "weather_snow", "weather_snow_depth",
                        "weather_tmax", "weather_tmin", "weather_temp_range"]
WEATHER_BINARY_COLS = ["is_rainy", "is_snowy", "is_hot", "is_cold"]
WEATHER_FEATURE_COLS = WEATHER_NUMERIC_COLS + WEATHER_BINARY_COLS
HOT_TMAX_C = 30
COLD_TMIN_C = 0


def weather_scan(feed: DataFrame, stations: DataFrame, station: str = "station") -> DataFrame:
    """Label each station-day with every (city, state) the station serves."""
    return feed.join(stations, station, "inner")


def feed_completeness(weather: DataFrame, expected: DataFrame, keys=("city", "state"),
                      raise_on_missing: bool = False) -> DataFrame:
    """Expected (city, state) pairs with zero weather rows."""
    missing = expected.select(*keys).distinct().join(
        weather.select(*keys).distinct(), list(keys), "left_anti")
    if raise_on_missing:
        bad = missing.limit(50).collect()
        if bad:
            raise RuntimeError(f"weather feed incomplete for: {[tuple(r) for r in bad]}")
    return missing


def date_span(df: DataFrame, date_col: str = "review_date") -> DataFrame:
    """Whole-year range covering the facts: (min year)-01-01 .. (max year)-12-31."""
    return df.agg(
        F.make_date(F.min(F.year(date_col)), F.lit(1), F.lit(1)).cast("string").alias("start_date"),
        F.make_date(F.max(F.year(date_col)), F.lit(12), F.lit(31)).cast("string").alias("end_date"))


def weather_features(raw: DataFrame, keys=("city", "state"), station: str = "station",
                     date_col: str = "DATE") -> DataFrame:
    """Parse text to numbers/date and derive the four weather flags.

    Unparsable numbers become NULL.  Flags treat NULL as 0: rainy = prcp > 0,
    snowy = snow + depth > 0, hot = tmax >= 30, cold = tmin <= 0.
    """
    cols = [F.col(k) for k in keys]
    if station in raw.columns:
        cols.append(F.col(station))
    cols.append(F.to_date(F.col(date_col).try_cast("string"), "yyyy-MM-dd").alias("review_date")
                if dict(raw.dtypes)[date_col] == "string"
                else F.to_date(date_col).alias("review_date"))
    present = {src: dst for src, dst in RENAME_MAP.items() if src in raw.columns}
    cols += [X.to_number(src).alias(dst) for src, dst in present.items()]
    out = raw.select(*cols)
    derived = {}
    if {"weather_tmax", "weather_tmin"} <= set(out.columns):
        derived["weather_temp_range"] = F.col("weather_tmax") - F.col("weather_tmin")
    if "weather_prcp" in out.columns:
        derived["is_rainy"] = (F.coalesce(F.col("weather_prcp"), F.lit(0.0)) > 0).cast("int")
    if "weather_snow" in out.columns or "weather_snow_depth" in out.columns:
        snow = F.coalesce(F.col("weather_snow"), F.lit(0.0)) if "weather_snow" in out.columns \
            else F.lit(0.0)
        depth = F.coalesce(F.col("weather_snow_depth"), F.lit(0.0)) \
            if "weather_snow_depth" in out.columns else F.lit(0.0)
        derived["is_snowy"] = (snow + depth > 0).cast("int")
    if "weather_tmax" in out.columns:
        derived["is_hot"] = F.coalesce(F.col("weather_tmax") >= HOT_TMAX_C, F.lit(False)).cast("int")
    if "weather_tmin" in out.columns:
        derived["is_cold"] = F.coalesce(F.col("weather_tmin") <= COLD_TMIN_C, F.lit(False)).cast("int")
    return out.withColumns(derived)


def normalize_keys(df: DataFrame, city: str = "city", state: str = "state",
                   date: str = "review_date") -> DataFrame:
    """City trimmed and whitespace-collapsed, state trimmed upper-case, date floored."""
    return df.withColumns({city: X.collapse_ws(city), state: F.upper(X.trim_ws(state)),
                           date: F.to_date(date)})


def dedupe_weather(weather: DataFrame, keys=("city", "state", "review_date"),
                   station: str = "station") -> DataFrame:
    """One row per key: mean of the measures, max of the flags, a station.

    The station kept is the smallest non-NULL name (deterministic, unlike
    "first").  Rows with a NULL key part are dropped, as a group-by on them
    would in pandas.
    """
    keys = list(keys)
    numeric = [c for c in WEATHER_NUMERIC_COLS if c in weather.columns]
    binary = [c for c in WEATHER_BINARY_COLS if c in weather.columns]
    aggs = [F.avg(c).alias(c) for c in numeric] + [F.max(c).alias(c) for c in binary]
    if station in weather.columns:
        aggs.append(F.min(station).alias(station))
    not_null = X.any_true([F.col(k).isNull() for k in keys])
    return weather.where(~not_null).groupBy(*keys).agg(*aggs)


def assert_unique(df: DataFrame, keys) -> None:
    """Many-to-one contract: raise if a key occurs twice."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"join keys {list(keys)} not unique on the right side, e.g. {dup[0]}")


def weather_join(fact: DataFrame, weather: DataFrame,
                 keys=("city", "state", "review_date"), right_keys=None,
                 check_unique: bool = True) -> DataFrame:
    """Left join the (unique per key) weather rows; add ``weather_available``.

    The weather table is one row per city-day, tiny next to the fact, so
    AQE's size check broadcasts it and the fact is never shuffled for it.
    """
    keys = list(keys)
    right_keys = list(right_keys or keys)
    w = weather.select(*right_keys, *[c for c in weather.columns if c not in right_keys])
    if right_keys != keys:
        w = w.withColumnsRenamed(dict(zip(right_keys, keys)))
    if check_unique:
        assert_unique(w, keys)
    feats = [c for c in WEATHER_FEATURE_COLS if c in w.columns]
    out = fact.join(w, keys, "left")
    avail = X.any_true([F.col(c).isNotNull() for c in feats]) if feats else F.lit(False)
    return out.withColumn("weather_available", avail.cast("int"))


def materialize_or_reuse(spark: SparkSession, path: str, build, refresh: bool = False) -> DataFrame:
    """Reuse the Parquet table at ``path`` unless ``refresh``; else build, write, re-read.

    ``path`` must be on shared storage (the cluster's checkpoint/warehouse
    area), never a machine-local folder.
    """
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
