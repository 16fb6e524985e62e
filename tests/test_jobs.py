"""Job-level tests: features, weather, enrichment invariants."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import enrich as E
from revlens.operators import features as FE
from revlens.sources import weather as W


def test_tip_photo_checkin_null_rules(spark):
    tip = spark.createDataFrame([(1, None, None), (1, "x", None), (None, "y", 3), (2, "z", 4)],
                                "business_id long, text string, compliment_count int")
    got = {r.business_id: (r.tip_count, r.tip_compliment_count)
           for r in FE.tip_features(tip).collect()}
    assert got == {1: (1, 0), 2: (1, 4)}
    photo = spark.createDataFrame([(1, 10, None), (1, 11, None), (2, 12, "food")],
                                  "business_id long, photo_id long, label string")
    got = {r.business_id: r.asDict() for r in FE.photo_features(photo).collect()}
    assert got[1]["photo_count"] == 2 and got[1]["photo_food"] == 0
    assert got[2]["photo_food"] == 1
    ck = spark.createDataFrame([(1, "a,b,c"), (2, ""), (3, None), (4, "a,")],
                               "business_id long, date string")
    assert {r.business_id: r.checkin_count for r in FE.checkin_features(ck).collect()} == \
        {1: 3, 2: 0, 3: 0, 4: 2}


def test_multi_hot_categories_counts_repeats_and_collisions(spark):
    b = spark.createDataFrame([(1, "Bars, Restaurants, Bars"), (2, "bars!, Pubs"), (3, None),
                               (4, "None")], "business_id long, categories string")
    out = FE.multi_hot_categories(b, n=3)
    cols = sorted(c for c in out.columns if c.startswith("category_"))
    assert cols == ["category_bars", "category_bars_2", "category_pubs"]
    row = {r.business_id: r for r in out.collect()}
    assert row[1].category_bars == 1 and row[2].category_bars_2 == 1 and row[3].category_pubs == 0


def test_weather_features_and_dedupe(spark):
    raw = spark.createDataFrame(
        [(" Reno\t", " nv ", "S1", "2024-01-01", None, None, None, "35", "-1"),
         ("Reno", "NV", "S0", "2024-01-01", "2", "T", None, "10", "5"),
         ("Reno", "NV", "S2", "2024-01-02", "0", "1", "0", None, "3")],
        "city string, state string, station string, DATE string, PRCP string, SNOW string, "
        "SNWD string, TMAX string, TMIN string")
    w = W.dedupe_weather(W.normalize_keys(W.weather_features(raw)))
    rows = {str(r.review_date): r for r in w.collect()}
    assert len(rows) == 2
    d1 = rows["2024-01-01"]
    assert d1.city == "Reno" and d1.state == "NV" and d1.station == "S0"
    assert d1.is_rainy == 1 and d1.is_hot == 1 and d1.is_cold == 1 and d1.weather_prcp == 2.0
    d2 = rows["2024-01-02"]
    assert d2.is_snowy == 1 and d2.is_hot == 0


def test_weather_join_rejects_duplicate_keys(spark):
    fact = spark.createDataFrame([("A", "X", "2024-01-01")], "city string, state string, d string") \
        .select("city", "state", F.to_date("d").alias("review_date"))
    dup = fact.unionByName(fact).withColumn("weather_prcp", F.lit(1.0))
    with pytest.raises(ValueError):
        W.weather_join(fact, dup)
    ok = W.weather_join(fact, dup.limit(1))
    assert ok.first().weather_available == 1


def test_enrich_fact_preserves_rows_and_matches_chained_joins(spark):
    reviews = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 12), (None, 10)],
                                    "business_id long, user_id long")
    business = spark.createDataFrame([(1, 4.0), (2, 3.0)], "business_id long, business_stars double")
    users = spark.createDataFrame([(10, 5), (11, 6)], "user_id long, user_fans int")
    tip = spark.createDataFrame([(1, 2, 1), (3, 1, 0)],
                                "business_id long, tip_count long, tip_compliment_count long")
    out = E.enrich_fact(reviews, business, users, tip_f=tip)
    assert out.count() == reviews.count()
    chained = (reviews.join(business, "business_id", "left").join(users, "user_id", "left")
               .join(tip, "business_id", "left"))
    cols = sorted(out.columns)
    assert sorted(map(tuple, out.select(cols).collect()), key=str) == \
        sorted(map(tuple, chained.select(cols).collect()), key=str)


def test_standardize_city_is_idempotent(spark):
    df = spark.createDataFrame([(" St.  Louis ",), ("Madison",), ("Reno",)], "city string")
    once = E.standardize_city(df)
    twice = E.standardize_city(once)
    assert sorted(r.city for r in once.collect()) == ["Nashville", "Reno", "Saint Louis"]
    assert sorted(r.city for r in twice.collect()) == sorted(r.city for r in once.collect())
