"""Business rules B1-B14 as column expressions.

Money is summed in DECIMAL and rounded once, at the output edge, then
cast to DOUBLE (T7, T8): doubles are never rounded mid-way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Exact money value of a column (double inputs become DECIMAL(18,4))."""
    return _c(x).cast(MONEY)


def net_line_revenue(price, discount_rate) -> Column:
    """Line revenue = price x (1 - discount rate), exact in DECIMAL."""
    return money(price) * (F.lit(1) - money(discount_rate))


def gross_line_revenue(quantity, unit_price, discount_amount=None) -> Column:
    """B3/B4: quantity x unit_price [- discount_amount]."""
    rev = _c(quantity) * _c(unit_price)
    if discount_amount is not None:
        rev = rev - _c(discount_amount)
    return rev


def valid_item(quantity="quantity", unit_price="unit_price") -> Column:
    """B2: quantity > 0 AND unit_price >= 0; price 0 passes, and NULL fails in a filter.

    A plain conjunction, so both bounds are pushed into the scan.  Where the rule
    is negated or kept as a value, wrap it in :func:`holds`.
    """
    return (_c(quantity) > 0) & (_c(unit_price) >= 0)


def holds(cond: Column) -> Column:
    """TRUE or FALSE, never NULL."""
    return F.coalesce(cond, F.lit(False))


def completed(status="status", value: str = "completed") -> Column:
    """B1: a completed sale."""
    return _c(status) == F.lit(value)


def round_money(x, digits: int = 2) -> Column:
    """Round an exact (DECIMAL) amount half-up once, then hand out a DOUBLE."""
    return F.round(_c(x), digits).cast("double")


# Exact operands for ratios: money sums (8 decimals) up to 1e22.
WIDE = DecimalType(30, 8)


def _dec_lit(v: int) -> Column:
    return F.lit(v).cast(DecimalType(max(1, len(str(abs(v)))), 0))


def ratio_half_up(num, den, digits: int, scale: int = 1) -> Column:
    """ROUND(scale x num / den, digits), half away from zero, computed exactly; DOUBLE.

    Spark's decimal division keeps only 6 decimals once its operands are
    wide, so rounding its quotient again can move a value that lies just
    below a half-way point (0.18499999.. -> 0.185 -> 0.19).  Here the
    rounding is done on integers: q = (2|n| 10^d + |m|) div 2|m|, with the
    exact integral ``div``; NULL when ``den`` is 0 or NULL (T5).
    """
    n = _c(num).cast(WIDE) * _dec_lit(scale) if scale != 1 else _c(num).cast(WIDE)
    m = _c(den).cast(WIDE)
    a = F.abs(n) * _dec_lit(2 * 10 ** digits) + F.abs(m)
    b = F.abs(m) * _dec_lit(2)
    q = F.call_function("div", a, b)
    signed = F.when((n < 0) != (m < 0), -q).otherwise(q)
    return F.when(m != 0, signed.cast("double") / float(10 ** digits))


def safe_ratio(num, den, digits: int | None = None, scale: int = 1) -> Column:
    """scale x num / NULLIF(den, 0), rounded exactly when ``digits`` is given (T5: x/0 is NULL)."""
    if digits is not None:
        return ratio_half_up(num, den, digits, scale)
    n = _c(num).cast(WIDE) * _dec_lit(scale)
    return (n / F.nullif(_c(den).cast(WIDE), F.lit(0))).cast("double")


def _scaled(x) -> Column:
    """A money sum as a whole number of its eighth decimal (sums up to 1e22)."""
    return (_c(x).cast(WIDE) * F.lit(10 ** 8).cast(DecimalType(9, 0))).cast(DecimalType(30, 0))


def times_count(x, count) -> Column:
    """``x * count`` as a whole number of eighth decimals, exact while x < 1e18 and the product < 1e30."""
    return (_scaled(x).cast(DecimalType(26, 0)) * _c(count).cast(DecimalType(12, 0))).cast(DecimalType(38, 0))


def above_mean(x, total, count) -> Column:
    """``x > total / count`` decided exactly as ``x * count > total`` (count > 0)."""
    return times_count(x, count) > _scaled(total)


def mean_half_up(total, count, digits: int = 2) -> Column:
    """ROUND(total / count, digits) exactly (an average from its sum and count)."""
    return ratio_half_up(total, count, digits)


def diff_from_mean_half_up(x, total, count, digits: int = 2) -> Column:
    """ROUND(x - total / count, digits) exactly, as (x * count - total) / count, on whole numbers."""
    n = (times_count(x, count) - _scaled(total)).cast(DecimalType(38, 0))
    m = (_c(count).cast(DecimalType(12, 0)) * F.lit(10 ** 8).cast(DecimalType(9, 0))).cast(DecimalType(21, 0))
    a = (F.abs(n) * _dec_lit(2 * 10 ** digits)).cast(DecimalType(38, 0)) + m
    q = F.call_function("div", a, m * _dec_lit(2))
    return F.when(m != 0, F.when(n < 0, -q).otherwise(q).cast("double") / float(10 ** digits))


def month_label(ts) -> Column:
    """DATE_FORMAT(ts, '%Y-%m')."""
    return F.date_format(_c(ts), "yyyy-MM")


def weekday_name(ts) -> Column:
    """DAYNAME / %W: the full English day name (T3: not Spark's 'Mon')."""
    return F.date_format(_c(ts), "EEEE")


def capitalise(x) -> Column:
    """UPPER(LEFT(TRIM(x),1)) || LOWER(SUBSTRING(TRIM(x),2))."""
    t = F.trim(_c(x))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


# The accepted loyalty tiers (B11).
LOYALTY_TIERS = ("gold", "silver", "bronze")


def normalize_tier(x, unknown: str | None = None, accepted=LOYALTY_TIERS) -> Column:
    """B11: trim + capitalise when in the allow-list, else NULL (or ``unknown``)."""
    t = _c(x)
    out = F.when(F.lower(F.trim(t)).isin(list(accepted)), capitalise(t))
    return out.otherwise(F.lit(unknown)) if unknown is not None else out
