"""Review-shaped inputs derived from the driver's TPC-H-like tables.

The analytics jobs expect a review fact, a business and a user dimension, the
three business activity tables (check-ins, tips, photos) and a daily weather
feed.  The driver ships none of these, so each is *derived by Spark* from the
parquet tables (its size grows with them):

=================  ===============================================  ==============
review-shaped      derived from                                     grain
=================  ===============================================  ==============
review            lineitem JOIN orders                              one line item
business          part (categories = words of the part name)        one part
user              customer JOIN nation JOIN region                  one customer
tip / photo /      events (``user_id`` plays the business key)      one event
checkin
weather (raw)      orders (order status plays the station city)     one order
station map        supplier JOIN nation (a city per station)  one supplier
=================  ===============================================  ==============

Every builder has a twin in :data:`SQL_VIEWS`, the same derivation written for
DuckDB, so the oracle query of a job can start from identical inputs.
Dirty values (quoted levels, malformed hours, NULLs) are produced by fixed
arithmetic on keys, so both engines agree row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.sources.tables import Tables, spread_fact_scan

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _s(c: Column) -> Column:
    return c.cast("string")


def _review_id() -> Column:
    """A number from a digest of all columns: lines of an order may share their line number."""
    whole = [F.round("l_quantity"), *[F.round(F.col(c) * 100) for c in ("l_extendedprice", "l_discount", "l_tax")]]
    text = F.concat_ws("|", *[_s(F.col(c)) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
                       *[_s(c.cast("bigint")) for c in whole], "l_returnflag", "l_linestatus",
                       F.date_format("l_shipdate", "yyyy-MM-dd"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def review_raw(t: Tables) -> DataFrame:
    l, o = spread_fact_scan(t.lineitem), t.orders
    return (
        l.join(o, l.l_orderkey == o.o_orderkey, "inner")
        .select(
            _review_id().alias("review_id"),
            F.col("l_partkey").alias("business_id"),
            F.col("o_custkey").alias("user_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("stars"),
            F.col("l_shipdate").alias("date"),
            F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
            .otherwise(F.concat_ws(" ", "o_orderpriority", "l_returnflag")).alias("text"),
            (F.round("l_quantity").cast("int") - 10).alias("useful"),
            F.nullif(F.round(F.col("l_tax") * 100).cast("int"), F.lit(0)).alias("funny"),
            F.round(F.col("l_discount") * 100).cast("int").alias("cool"),
            F.col("l_extendedprice").alias("amount"),
            F.col("l_linestatus").alias("wx_city"),
            F.lit("X").alias("wx_state"),
        )
    )


def _hours(day: int) -> Column:
    k = F.col("p_size") + day
    open_part = F.concat(_s(k % 24), F.lit(":"), _s(((F.col("p_partkey") + day) % 4) * 15))
    close_part = F.concat(_s((F.col("p_size") * 3 + day * 5) % 24), F.lit(":0"))
    return (
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 1, F.lit("bad"))
        .otherwise(F.concat(open_part, F.lit("-"), close_part))
    )


def business_raw(t: Tables) -> DataFrame:
    p = t.part
    size = F.col("p_size")
    ptype = F.lower("p_type")
    price_level = (
        F.when(size % 4 == 0, F.concat(F.lit("u'"), ptype, F.lit("'")))
        .when(size % 4 == 1, F.concat(F.lit("'"), ptype, F.lit("'")))
        .when(size % 4 == 2, ptype)
        .when(size % 8 == 3, F.lit(None).cast("string"))
        .otherwise(F.lit("None"))
    )
    ambience = (
        F.when(size % 7 == 0, F.lit("None"))
        .when(size % 11 == 0, F.lit("{bad"))
        .otherwise(F.concat(
            F.lit("{'"), ptype, F.lit("': "),
            F.when(size % 3 == 0, F.lit("True")).otherwise(F.lit("False")),
            F.lit(", u'"), F.lower(F.regexp_replace("p_brand", "#", " ")),
            F.lit("': True, 'lot': None}"),
        ))
    )
    cols = [
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        ((size % 9) / 2.0 + 1.0).alias("stars"),
        (size * 7).alias("review_count"),
        (F.col("p_partkey") % 2).cast("int").alias("is_open"),
        F.regexp_replace("p_name", " ", ", ").alias("categories"),
        price_level.alias("attributes_RestaurantsPriceRange2"),
        ambience.alias("attributes_Ambience"),
    ]
    cols += [_hours(i).alias(f"hours_{d}") for i, d in enumerate(DAYS)]
    return p.select(*cols)


def user_raw(t: Tables) -> DataFrame:
    c, n, r = t.customer, t.nation, t.region
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(r, n.n_regionkey == r.r_regionkey, "inner")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.floor(F.col("c_acctbal") / 50).cast("int").alias("review_count"),
            ((F.col("c_custkey") % 41) / 10.0 + 1.0).alias("average_stars"),
            (F.col("c_nationkey") * 3).alias("useful"),
            (F.col("c_custkey") % 7).cast("int").alias("funny"),
            (F.col("c_custkey") % 5).cast("int").alias("cool"),
            (F.col("c_custkey") % 13).cast("int").alias("fans"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
    )


def tip_raw(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("user_id")).alias("business_id"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.col("event_type")).alias("text"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("int"))
        .otherwise(F.round("value").cast("int")).alias("compliment_count"),
    )


PHOTO_LABELS = ["drink", "food", "inside", "menu", "outside"]


def photo_raw(t: Tables) -> DataFrame:
    e = t.events
    label = (
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type") == "click", F.lit("food"))
        .when(F.col("event_type") == "view", F.lit("drink"))
        .when(F.col("event_type") == "purchase", F.lit("menu"))
        .when(F.col("event_type") == "signup", F.lit("inside"))
        .otherwise(F.lit("outside"))
    )
    return e.select(
        F.col("event_id").alias("photo_id"),
        F.col("user_id").alias("business_id"),
        label.alias("label"),
    )


def checkin_raw(t: Tables) -> DataFrame:
    e = t.events
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    k = F.col("event_id") % 4
    return e.select(
        F.col("user_id").alias("business_id"),
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.concat_ws(",", ts, ts))
        .otherwise(F.concat(ts, F.lit(","), ts, F.lit(","))).alias("date"),
    )


def weather_raw(t: Tables) -> DataFrame:
    o = t.orders
    whole = F.floor("o_totalprice").cast("long")
    thousands = F.floor(F.col("o_totalprice") / 1000).cast("long")
    key = F.col("o_orderkey")
    return o.select(
        F.when(key % 9 == 0, F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("\t")))
        .otherwise(F.col("o_orderstatus")).alias("city"),
        F.when(key % 4 == 0, F.lit(" x ")).otherwise(F.lit("X")).alias("state"),
        F.concat(F.lit("S"), _s(F.col("o_custkey") % 10)).alias("station"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATE"),
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 17 == 0, F.lit("T"))
        .otherwise(_s(whole % 50 - 10)).alias("PRCP"),
        F.when(key % 3 == 0, F.lit(None).cast("string"))
        .otherwise(_s(whole % 7 - 5)).alias("SNOW"),
        F.when(key % 6 == 1, F.lit(None).cast("string"))
        .otherwise(_s(whole % 11 - 8)).alias("SNWD"),
        F.when(key % 13 == 0, F.lit(None).cast("string"))
        .otherwise(_s(thousands % 45 - 5)).alias("TMAX"),
        _s(thousands % 45 - 15).alias("TMIN"),
    )


def station_map(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
        F.concat(F.lit("S"), _s(F.col("s_suppkey"))).alias("station"),
        F.col("s_name").alias("city"),
        F.col("n_name").alias("state"),
    )


# --------------------------------------------------------------------------
# The same derivations for DuckDB.  Each entry is a CTE body; ``sql_with``
# prepends only the ones a query names (and what those depend on).
# --------------------------------------------------------------------------

def _sql_hours(day: int, name: str) -> str:
    k = f"(p_size + {day})"
    return (
        f"CASE WHEN {k} % 10 = 0 THEN NULL WHEN {k} % 10 = 1 THEN 'bad' ELSE "
        f"CAST({k} % 24 AS VARCHAR) || ':' || CAST(((p_partkey + {day}) % 4) * 15 AS VARCHAR)"
        f" || '-' || CAST((p_size * 3 + {day * 5}) % 24 AS VARCHAR) || ':0' END AS hours_{name}"
    )


SQL_VIEWS: dict[str, str] = {
    "rv_review": """
        SELECT ('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   CAST(round(l_quantity) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
                   CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT), l_returnflag,
                   l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))), 1, 15))::BIGINT AS review_id,
               l_partkey AS business_id, o_custkey AS user_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS stars,
               l_shipdate AS date,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE o_orderpriority || ' ' || l_returnflag END AS text,
               CAST(round(l_quantity) AS INTEGER) - 10 AS useful,
               NULLIF(CAST(round(l_tax * 100) AS INTEGER), 0) AS funny,
               CAST(round(l_discount * 100) AS INTEGER) AS cool,
               l_extendedprice AS amount,
               l_linestatus AS wx_city, 'X' AS wx_state
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "rv_business": """
        SELECT p_partkey AS business_id, p_name AS name,
               CAST(p_size % 9 AS DOUBLE) / 2 + 1 AS stars,
               p_size * 7 AS review_count,
               CAST(p_partkey % 2 AS INTEGER) AS is_open,
               replace(p_name, ' ', ', ') AS categories,
               CASE WHEN p_size % 4 = 0 THEN 'u''' || lower(p_type) || ''''
                    WHEN p_size % 4 = 1 THEN '''' || lower(p_type) || ''''
                    WHEN p_size % 4 = 2 THEN lower(p_type)
                    WHEN p_size % 8 = 3 THEN NULL
                    ELSE 'None' END AS attributes_RestaurantsPriceRange2,
               CASE WHEN p_size % 7 = 0 THEN 'None'
                    WHEN p_size % 11 = 0 THEN '{bad'
                    ELSE '{''' || lower(p_type) || ''': '
                         || CASE WHEN p_size % 3 = 0 THEN 'True' ELSE 'False' END
                         || ', u''' || lower(replace(p_brand, '#', ' ')) || ''': True, ''lot'': None}'
               END AS attributes_Ambience,
               """ + ",\n               ".join(_sql_hours(i, d) for i, d in enumerate(DAYS)) + """
        FROM part""",
    "rv_user": """
        SELECT c_custkey AS user_id, c_name AS name,
               CAST(floor(c_acctbal / 50) AS INTEGER) AS review_count,
               CAST(c_custkey % 41 AS DOUBLE) / 10 + 1 AS average_stars,
               c_nationkey * 3 AS useful,
               CAST(c_custkey % 7 AS INTEGER) AS funny,
               CAST(c_custkey % 5 AS INTEGER) AS cool,
               CAST(c_custkey % 13 AS INTEGER) AS fans,
               n_name AS city, r_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "rv_tip": """
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS business_id,
               CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS text,
               CASE WHEN event_type = 'view' THEN NULL ELSE CAST(round(value) AS INTEGER) END AS compliment_count
        FROM events""",
    "rv_photo": """
        SELECT event_id AS photo_id, user_id AS business_id,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    WHEN event_type = 'click' THEN 'food'
                    WHEN event_type = 'view' THEN 'drink'
                    WHEN event_type = 'purchase' THEN 'menu'
                    WHEN event_type = 'signup' THEN 'inside'
                    ELSE 'outside' END AS label
        FROM events""",
    "rv_checkin": """
        SELECT user_id AS business_id,
               CASE WHEN event_id % 4 = 0 THEN NULL
                    WHEN event_id % 4 = 1 THEN ''
                    WHEN event_id % 4 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' END AS date
        FROM events""",
    "rv_weather_raw": """
        SELECT CASE WHEN o_orderkey % 9 = 0 THEN ' ' || o_orderstatus || chr(9) ELSE o_orderstatus END AS city,
               CASE WHEN o_orderkey % 4 = 0 THEN ' x ' ELSE 'X' END AS state,
               'S' || CAST(o_custkey % 10 AS VARCHAR) AS station,
               strftime(o_orderdate, '%Y-%m-%d') AS "DATE",
               CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'T'
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 50 - 10 AS VARCHAR) END AS PRCP,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 7 - 5 AS VARCHAR) END AS SNOW,
               CASE WHEN o_orderkey % 6 = 1 THEN NULL
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 11 - 8 AS VARCHAR) END AS SNWD,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) % 45 - 5 AS VARCHAR) END AS TMAX,
               CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) % 45 - 15 AS VARCHAR) AS TMIN
        FROM orders""",
    "rv_station_map": """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS station, s_name AS city, n_name AS state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}


def sql_with(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the named fixture CTEs (fixture views first)."""
    parts = [f"{v} AS ({SQL_VIEWS[v]})" for v in views]
    for name, text in (extra or {}).items():
        parts.append(f"{name} AS ({text})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
