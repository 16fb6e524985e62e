"""Column expressions shared by the jobs.

All of these are plain Catalyst expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.  Each notes the null behaviour it
reproduces, because pandas NaN rules and Spark NULL rules differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values that results depend on (category orders and bucket edges).
# ---------------------------------------------------------------------------
MONTH_TO_SEASON = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Autumn", 10: "Autumn", 11: "Autumn",
}
SEASON_ORDER = ["Winter", "Spring", "Summer", "Autumn"]
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
USER_BUCKET_ORDER = ["1", "2-5", "6-20", "21-100", "100+", "Unknown"]
MISSING_LEVELS = ["None", "nan"]
UNKNOWN = "Unknown"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- whitespace / text ------------------------------------------------------

def trim_ws(c) -> Column:
    """Strip all leading/trailing whitespace (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def collapse_ws(c) -> Column:
    """Trim, then collapse inner whitespace runs to one space."""
    return F.regexp_replace(trim_ws(c), r"\s+", " ")


def strip_repr_quotes(c) -> Column:
    """``u'quiet'`` / ``'quiet'`` / ``"quiet"`` -> ``quiet``; other text is trimmed.

    NULL stays NULL.  Idempotent on already clean text.
    """
    return F.regexp_replace(trim_ws(c), r"""^[ub]?(['"])(.*)\1$""", "$2")


def unknown_level(c) -> Column:
    """NULL, 'None' and 'nan' become 'Unknown' (lower-case 'none' is kept)."""
    c = col(c).cast("string")
    return F.when(c.isNull() | c.isin(*MISSING_LEVELS), F.lit(UNKNOWN)).otherwise(c)


def sanitize_name(c) -> Column:
    """Lower-case, non-alphanumerics to '_', runs collapsed, edges stripped."""
    s = F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}]", "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_|_$", "")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


# --- numbers -----------------------------------------------------------------

def clip_lower(c, lower: float = 0) -> Column:
    """Values below ``lower`` become ``lower``; NULL stays NULL (unlike greatest)."""
    c = col(c)
    return F.when(c < lower, F.lit(lower)).otherwise(c)


def to_number(c) -> Column:
    """Coerce to double; unparsable text becomes NULL (plain cast raises under ANSI)."""
    return col(c).try_cast("double")


def zero_fill(c) -> Column:
    return F.coalesce(col(c).try_cast("double"), F.lit(0.0))


def log1p_clipped(c) -> Column:
    """log1p of the value clipped at 0; NULL stays NULL."""
    return F.log1p(clip_lower(c, 0))


def round_half_even(c, digits: int) -> Column:
    """numpy/pandas rounding: scale, round half to even, unscale.

    SQL twin: ``round_even(x * 10^d, 0) / 10^d``.
    """
    scale = float(10 ** digits)
    return F.bround(col(c) * scale, 0) / scale


def sql_round_half_even(expr: str, digits: int) -> str:
    scale = 10 ** digits
    return f"(round_even(({expr}) * {scale}.0, 0) / {scale}.0)"


# --- dates ------------------------------------------------------------------

def weekday0(c) -> Column:
    """Monday = 0 ... Sunday = 6 (Spark ``weekday``; ``dayofweek`` is Sun = 1)."""
    return F.weekday(col(c))


def season_of_month(c) -> Column:
    m = col(c)
    expr = None
    for season in SEASON_ORDER:
        months = [k for k, v in MONTH_TO_SEASON.items() if v == season]
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(season)) if expr is None else expr.when(cond, F.lit(season))
    return expr


def weekday_name(c) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), col(c).cast("int") + 1)


def user_bucket(c) -> Column:
    """Buckets [0,1], (1,5], (5,20], (20,100], (100,inf); NULL / negative -> Unknown."""
    v = col(c).try_cast("double")
    return (
        F.when(v.isNull() | (v < 0), F.lit(UNKNOWN))
        .when(v <= 1, F.lit("1"))
        .when(v <= 5, F.lit("2-5"))
        .when(v <= 20, F.lit("6-20"))
        .when(v <= 100, F.lit("21-100"))
        .otherwise(F.lit("100+"))
    )


def order_index(c, order: list[str]) -> Column:
    """Ordinal position of a categorical level (NULL when not in ``order``)."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), col(c))


# --- parsed strings ------------------------------------------------------------

def comma_items(c) -> Column:
    """Trimmed, non-empty, non-'None' items of a comma list; NULL -> []."""
    items = F.transform(F.split(F.coalesce(col(c), F.lit("")), ","), lambda x: trim_ws(x))
    return F.filter(items, lambda x: (x != "") & (x != "None"))


def comma_count(c) -> Column:
    """Number of comma-separated items; '' and NULL count 0, 'a,' counts 2."""
    s = F.coalesce(col(c), F.lit(""))
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, ",")))


_QKEY = r"""u?['"]([^'"]*)['"]"""
_QVAL = r"""(True|False|None|-?\d+(\.\d+)?|u?'[^']*'|u?"[^"]*")"""
# a whole dict literal of scalar values, as written by Python's repr
DICT_LITERAL = (
    r"^\{\s*(" + _QKEY + r"\s*:\s*" + _QVAL + r"\s*(,\s*" + _QKEY + r"\s*:\s*" + _QVAL
    + r"\s*)*,?)?\s*\}$"
)
KEY_PATTERN = r"""['"]([^'"]+)['"]\s*:"""
TRUE_KEY_PATTERN = r"""['"]([^'"]+)['"]\s*:\s*True\b"""


def dict_keys(c) -> Column:
    """Keys of a Python dict literal held as text; malformed / NULL -> []."""
    t = trim_ws(col(c))
    ok = F.coalesce(t.rlike(DICT_LITERAL), F.lit(False))
    return F.when(ok, F.regexp_extract_all(t, F.lit(KEY_PATTERN), 1)).otherwise(
        F.array().cast("array<string>"))


def dict_true_keys(c) -> Column:
    """Keys whose value is the literal ``True``."""
    t = trim_ws(col(c))
    ok = F.coalesce(t.rlike(DICT_LITERAL), F.lit(False))
    return F.when(ok, F.regexp_extract_all(t, F.lit(TRUE_KEY_PATTERN), 1)).otherwise(
        F.array().cast("array<string>"))


def hours_parts(c) -> tuple[Column, Column]:
    """Parse ``"H:M-H:M"`` into (open flag, duration hours).

    Equal open and close means 24 h; a close before the open wraps past
    midnight; NULL, empty, no '-' or non-integer parts give (0, 0.0).
    """
    t = trim_ws(col(c))
    halves = F.split(t, "-", 2)
    op = F.split(F.get(halves, 0), ":", 2)
    cl = F.split(F.get(halves, 1), ":", 2)
    oh, om = F.get(op, 0).try_cast("int"), F.get(op, 1).try_cast("int")
    ch, cm = F.get(cl, 0).try_cast("int"), F.get(cl, 1).try_cast("int")
    parsed = (
        t.isNotNull() & (t != "") & t.contains("-")
        & oh.isNotNull() & om.isNotNull() & ch.isNotNull() & cm.isNotNull()
    )
    start = oh * 60 + om
    end = ch * 60 + cm
    raw = end - start
    minutes = F.when(raw < 0, raw + 1440).otherwise(raw)
    duration = F.when(start == end, F.lit(24.0)).otherwise(minutes / 60.0)
    ok = F.coalesce(parsed, F.lit(False))
    return (F.when(ok, F.lit(1)).otherwise(F.lit(0)),
            F.when(ok, duration).otherwise(F.lit(0.0)))


# --- small combinators ----------------------------------------------------------

def any_true(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def sum_cols(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)
