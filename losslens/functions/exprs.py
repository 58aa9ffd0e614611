"""Column expressions shared by the operators (all JVM-side, codegen'd).

Each helper pins one pandas semantic the reference relies on (see the
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ---------------------------
# Base processing cost components per return (sum = 12.0).
DEFAULT_COST_COMPONENTS = {
    "customer_care": 4.0,
    "inspection": 2.5,
    "restocking": 3.0,
    "logistics": 2.5,
}
# Category tier multipliers (premium 1.3, moderate 1.15, standard 1.0);
# categories that are not listed use DEFAULT_CATEGORY_MULTIPLIER.
CATEGORY_TIER_MULTIPLIERS = {
    "Outerwear & Coats": 1.3, "Suits & Sport Coats": 1.3, "Blazers & Jackets": 1.3,
    "Jeans": 1.3, "Dresses": 1.3, "Suits": 1.3, "Sweaters": 1.3, "Pants": 1.3,
    "Skirts": 1.15, "Active": 1.15, "Swim": 1.15, "Maternity": 1.15,
    "Sleep & Lounge": 1.15, "Accessories": 1.15, "Pants & Capris": 1.15,
    "Fashion Hoodies & Sweatshirts": 1.15, "Shorts": 1.15,
    "Plus": 1.0, "Tops & Tees": 1.0, "Intimates": 1.0, "Underwear": 1.0,
    "Leggings": 1.0, "Socks & Hosiery": 1.0, "Socks": 1.0,
    "Jumpsuits & Rompers": 1.0, "Clothing Sets": 1.0,
}
DEFAULT_CATEGORY_MULTIPLIER = 1.0
# Month -> season (northern hemisphere).
SEASON_BY_MONTH = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring",
                   5: "spring", 6: "summer", 7: "summer", 8: "summer", 9: "fall",
                   10: "fall", 11: "fall"}
# Tokens read as True when coercing text flags.
TRUE_TOKENS = ["TRUE", "T", "1", "YES", "Y"]
# Default minimum group size for return-rate tables.
MIN_ROWS_THRESHOLD = 200
# ---------------------------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(d: dict) -> Column:
    """A constant map expression (no join needed for a fixed lookup)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def day_floor_diff(later, earlier) -> Column:
    """Whole days elapsed, floored (pandas ``Timedelta.days``), Q10."""
    a = F.unix_micros(col(later).cast("timestamp"))
    b = F.unix_micros(col(earlier).cast("timestamp"))
    return F.floor((a - b) / F.lit(MICROS_PER_DAY)).cast("long")


def safe_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` else null (guarded percent fields)."""
    return F.when(col(den) > 0, col(num) / col(den))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def finite_or(c, fill: float = 0.0) -> Column:
    """inf / -inf / NaN / null -> ``fill`` (pandas ``replace([inf,-inf], nan).fillna``)."""
    c = col(c).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, F.lit(fill)).otherwise(c)


def null_safe_true(pred: Column) -> Column:
    """Comparisons with a missing value are False (Q15)."""
    return F.coalesce(pred, F.lit(False))


def returned_flag(status_col) -> Column:
    """``lower(status) == 'returned'`` as 0/1, null status -> 0."""
    return F.coalesce((F.lower(col(status_col)) == F.lit("returned")).cast("int"), F.lit(0))


def coerce_bool(c) -> Column:
    """Text / number flag -> boolean; unknown tokens are False."""
    return F.coalesce(F.upper(F.trim(col(c).cast("string"))).isin(TRUE_TOKENS), F.lit(False))


def season(month_col) -> Column:
    return literal_map(SEASON_BY_MONTH)[col(month_col)]


def tier_multiplier(category_col, tiers: dict | None = None,
                    default: float = DEFAULT_CATEGORY_MULTIPLIER) -> Column:
    """Category -> multiplier via a constant map on lower-cased keys (Q12)."""
    tiers = CATEGORY_TIER_MULTIPLIERS if tiers is None else tiers
    lowered = {k.lower(): float(v) for k, v in tiers.items()}
    if not lowered:
        return F.lit(float(default))
    return F.coalesce(literal_map(lowered)[F.lower(F.trim(col(category_col)))],
                      F.lit(float(default)))


def weekday_mon0(ts_col) -> Column:
    """Day of week with Monday = 0 (Q11)."""
    return F.weekday(col(ts_col))


def rnd(c, digits: int) -> Column:
    """pandas / numpy ``round``: half-even on the binary value, i.e.
    ``rint(x * 10^d) / 10^d`` (Q13).  ``bround`` rounds the shortest
    decimal string instead and differs on values like 2.675."""
    scale = float(10 ** digits)
    return F.rint(col(c).cast("double") * F.lit(scale)) / F.lit(scale)
