"""One-column CSV exports of JSON objects, and the extraction filters that
produce them.

The export format is a CSV with a header and exactly one column whose cells
are JSON object texts (quotes doubled inside the CSV field).  Parsing is a
``from_json`` with an explicit schema: Spark never infers, and a corrupt record
either fails the job (strict) or is counted in a corrupt-record column.
Nested objects are flattened to ``parent_child`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def read_json_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the raw one-column CSV; raise when it has more than one column.

    JSON text escapes line breaks, so a record is one line and files stay
    splittable (no ``multiLine``)."""
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    if len(raw.columns) != 1:
        raise ValueError(f"{path}: expected exactly one column of JSON text, "
                         f"found {len(raw.columns)}: {raw.columns}")
    return raw.withColumnRenamed(raw.columns[0], "json")


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Expand struct columns of any depth into ``parent_child`` columns."""
    def leaves(column, name, kind):
        if not isinstance(kind, StructType):
            return [column.alias(name)]
        return [leaf for g in kind.fields
                for leaf in leaves(column.getField(g.name), f"{name}{sep}{g.name}", g.dataType)]

    return df.select(*[leaf for f in df.schema.fields
                       for leaf in leaves(F.col(f"`{f.name}`"), f.name, f.dataType)])


def parse_json_column(df: DataFrame, schema: StructType, json_col: str = "json",
                      strict: bool = True) -> DataFrame:
    """Parse JSON text with ``schema`` and flatten.

    ``strict`` fails the job on the first malformed record (FAILFAST).  The
    permissive variant keeps malformed texts in ``_corrupt_record`` so they can
    be counted with one aggregation and reported.  A NULL text gives a NULL
    row, not a corrupt record.
    """
    if strict:
        parsed = F.from_json(F.col(json_col), schema, {"mode": "FAILFAST"})
        return flatten(df.select(parsed.alias("__j")).select("__j.*"))
    with_corrupt = StructType(schema.fields + [
        StructType.fromJson({"type": "struct", "fields": [
            {"name": CORRUPT, "type": "string", "nullable": True, "metadata": {}}]}).fields[0]])
    parsed = F.from_json(F.col(json_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return flatten(df.select(parsed.alias("__j")).select("__j.*"))


def json_text_scan(spark: SparkSession, path: str, schema: StructType,
                   strict: bool = True) -> DataFrame:
    return parse_json_column(read_json_csv(spark, path), schema, "json", strict)


def count_corrupt(parsed: DataFrame) -> int:
    if CORRUPT not in parsed.columns:
        return 0
    return parsed.where(F.col(CORRUPT).isNotNull()).count()


def load_tables(spark: SparkSession, paths: dict[str, str],
                schemas: dict[str, StructType]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Scan every export and report rows x columns in a single job.

    The row count depends on a hash of every parsed column, so no column's
    parsing can be pruned away and a malformed record fails the job."""
    tables = {name: json_text_scan(spark, p, schemas[name]) for name, p in paths.items()}
    report = None
    for name, df in tables.items():
        parsed = F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        rows = F.when(parsed.isNull(), F.lit(0)).otherwise(F.count(F.lit(1)))
        part = df.agg(F.lit(name).alias("table"), rows.cast("long").alias("rows"),
                      F.lit(len(df.columns)).alias("columns"))
        report = part if report is None else report.unionByName(part)
    return tables, report


# --- extraction filters ---------------------------------------------------------------

def json_field(json_col: str, field: str):
    return F.get_json_object(F.col(json_col), f"$.{field}")


def extract_by_category(business: DataFrame, category: str = "Restaurants",
                        json_col: str = "json", field: str = "categories") -> DataFrame:
    """JSON rows whose category text contains ``category`` (case-insensitive).

    A missing / NULL field never matches.  ``%``/``_`` in the category are
    taken literally.
    """
    needle = category.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return business.where(json_field(json_col, field).ilike(f"%{needle}%"))


def extract_facts_of_dim(facts: DataFrame, business: DataFrame, category: str = "Restaurants",
                         key: str = "business_id", json_col: str = "json",
                         semi: bool = False) -> DataFrame:
    """Fact JSON rows whose business passes the category filter.

    The default is the plain inner join (a fact row repeats once per matching
    business row, no DISTINCT).  ``semi=True`` is the left-semi variant: the
    same rows when business keys are unique, never fanned out, and the
    business side is only a key set.
    """
    dim = extract_by_category(business, category, json_col).select(
        json_field(json_col, key).alias("__k"))
    f = facts.withColumn("__fk", json_field(json_col, key))
    if semi:
        return f.join(dim.distinct(), f["__fk"] == dim["__k"], "left_semi").select(json_col)
    return f.join(dim, f["__fk"] == dim["__k"], "inner").select(f[json_col])


def extract_distinct_users(users: DataFrame, reviews: DataFrame, business: DataFrame,
                           category: str = "Restaurants", json_col: str = "json") -> DataFrame:
    """DISTINCT user JSON texts over user JOIN review JOIN business(category).

    The joins are only existence tests, so they are written as semi joins on
    key sets (each shuffle carries keys, not JSON texts), then DISTINCT on
    the whole text.
    """
    biz = extract_by_category(business, category, json_col).select(
        json_field(json_col, "business_id").alias("__b")).distinct()
    # one parse per review text for both keys
    rev = reviews.select(F.json_tuple(F.col(json_col), "business_id", "user_id")
                         .alias("__b", "__u"))
    user_keys = rev.join(biz, "__b", "left_semi").select("__u").distinct()
    u = users.withColumn("__u", json_field(json_col, "user_id"))
    return u.join(user_keys, "__u", "left_semi").select(json_col).distinct()
