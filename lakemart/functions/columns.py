"""Column-level helpers: cleaning rules, safe rates, segments and the
conditional aggregates every mart is built from. All are built-in Spark
expressions (JVM side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = 2   # digits kept for money amounts
# Money is aggregated as an exact decimal: sums and averages then round
# HALF_UP on the true value instead of on float summation noise. With
# precision <= 18 Spark keeps the values long-backed (fast path).
MONEY_TYPE = "decimal(18,6)"
# Totals are summed on: they may exceed one event's range.
TOTAL_TYPE = "decimal(38,6)"
RATE = 2    # digits kept for percentages

# User segment thresholds (total events) and lifetime-value
# tier bounds and labels, as the marts define them.
SEGMENT_POWER_MIN = 21
SEGMENT_ENGAGED_MIN = 6
LTV_TIERS = [
    (0, "0. Never Purchased"),
    (100, "1. Low Value ($0-$100)"),
    (500, "2. Medium Value ($100-$500)"),
    (1000, "3. High Value ($500-$1K)"),
]
LTV_TOP = "4. VIP ($1K+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(x) -> Column:
    return _c(x).cast(MONEY_TYPE)


def money_sum(x, digits: int = MONEY) -> Column:
    """round(SUM(x), digits) computed exactly in decimal, returned as DOUBLE."""
    return F.round(F.sum(money(x)), digits).cast("double")


def total_sum(x, digits: int = MONEY) -> Column:
    """``money_sum`` of amounts that are sums themselves."""
    return F.round(F.sum(_c(x).cast(TOTAL_TYPE)), digits).cast("double")


def total_avg(x, digits: int = MONEY) -> Column:
    """``money_avg`` of amounts that are sums themselves."""
    return F.round(F.avg(_c(x).cast(TOTAL_TYPE)), digits).cast("double")


def money_avg(x, digits: int = MONEY) -> Column:
    """round(AVG(x), digits) computed exactly in decimal, returned as DOUBLE."""
    return F.round(F.avg(money(x)), digits).cast("double")


def ratio_avg(total, n, digits: int = MONEY) -> Column:
    """``money_avg`` from an exact decimal sum and its row count (sums of
    partial sums); NULL without rows."""
    return F.round(_c(total).cast("decimal(28,6)") / F.nullif(_c(n), F.lit(0)).cast("decimal(18,0)"), digits).cast("double")


def round_half_up(x, digits: int = 2) -> Column:
    """Spark ``round`` (HALF_UP) applied after first rounding to 10 places,
    so float noise from summation order (395.98999999999995 / 14) cannot
    flip a value that is exactly half-way in decimal (28.285 -> 28.29).
    A single ``ROUND`` of the double differs from it only where the double
    lies within 5e-11 below a half-way point."""
    return F.round(F.round(_c(x), 10), digits)


def clean_brand(col) -> Column:
    """NULL or blank brand -> 'unknown', otherwise lower(trim(brand))."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit("unknown"))
            .when(F.trim(c) == "", F.lit("unknown"))
            .otherwise(F.lower(F.trim(c))))


def clean_price(col) -> Column:
    """NULL or negative price -> 0.0."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(0.0)).when(c < 0, F.lit(0.0)).otherwise(c)


def safe_rate(num, den, digits: int = RATE, scale: float = 100.0) -> Column:
    """round(num * scale / NULLIF(den, 0), digits) as DOUBLE; NULL when the
    denominator is 0 (ANSI division would raise)."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    return round_half_up(n * F.lit(scale) / F.nullif(d, F.lit(0.0)), digits)


def segment(events_col, power: int = SEGMENT_POWER_MIN, engaged: int = SEGMENT_ENGAGED_MIN) -> Column:
    """Behavioural segment from a total-event count."""
    c = _c(events_col)
    return (F.when(c >= power, F.lit("power_user"))
            .when(c >= engaged, F.lit("engaged"))
            .otherwise(F.lit("casual")))


def ltv_tier(revenue_col) -> Column:
    """Lifetime-value tier label (first bound is an equality: 0 revenue)."""
    c = _c(revenue_col)
    (zero, zero_label), *rest = LTV_TIERS
    out = F.when(c == zero, F.lit(zero_label))
    for bound, label in rest:
        out = out.when(c < bound, F.lit(label))
    return out.otherwise(F.lit(LTV_TOP))


def is_type(t: str, col: str = "event_type") -> Column:
    return F.col(col) == t


def count_of(t: str, col: str = "event_type") -> Column:
    """SUM(CASE WHEN type = t THEN 1 ELSE 0 END) as BIGINT."""
    return F.sum(F.when(is_type(t, col), F.lit(1)).otherwise(F.lit(0))).cast("long")


def distinct_of(t: str, value: str, col: str = "event_type") -> Column:
    """COUNT(DISTINCT CASE WHEN type = t THEN value END)."""
    return F.count_distinct(F.when(is_type(t, col), F.col(value)))


def users_of(t: str, user: str = "user_sk", col: str = "event_type") -> Column:
    return distinct_of(t, user, col)


def revenue_of(t: str = "purchase", col: str = "event_type", revenue: str = "revenue") -> Column:
    """round(SUM(CASE WHEN type = t THEN revenue ELSE 0 END), 2)."""
    return money_sum(F.when(is_type(t, col), F.col(revenue)).otherwise(F.lit(0.0)))


def purchase_revenue(col: str = "event_type", revenue: str = "revenue") -> Column:
    """round(AVG(CASE WHEN purchase THEN revenue END), 2)."""
    return money_avg(F.when(is_type("purchase", col), F.col(revenue)))


def quantity_of(t: str = "purchase", col: str = "event_type", qty: str = "quantity") -> Column:
    return F.sum(F.when(is_type(t, col), F.col(qty)).otherwise(F.lit(0))).cast("long")
