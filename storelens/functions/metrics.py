"""Column builders for the business metrics (P-01..P-03, P-05, P-06, A-02, J-02).

All return ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (metric definitions).
DAY_HOURS = 12.0
CRITICAL_MAX_HOURS = 6.0
MONITOR_MAX_HOURS = 12.0
BAND_CRITICAL = "CRITICAL_BURN_SPIKE"
BAND_MONITOR = "MONITOR_VELOCITY"
BAND_NORMAL = "NORMAL"
PROMO_ABUSE = "cashier_promo_abuse"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, places: int) -> Column:
    """Round a double half-up on its binary value: floor(x*10^p + 0.5)/10^p.

    Written out so that Spark and the SQL oracle evaluate the same IEEE
    operations (``round`` differs between engines on values such as 2.675).
    """
    s = float(10 ** places)
    return F.floor(_c(c) * F.lit(s) + F.lit(0.5)).cast("double") / F.lit(s)


def exact_ratio(num, den, places: int, scale: int = 1) -> Column:
    """round_half_up(scale * num / den, places) for non-negative integer
    ``num``/``den`` in exact integer arithmetic; null when ``den`` is 0.
    Used for rates and means so the result does not depend on the order
    in which partial aggregates were combined.
    """
    m = scale * 10 ** places
    n, d = _c(num).cast("long"), _c(den).cast("long")
    a = F.lit(2 * m) * n + d
    # floor(m*n/d + 1/2) == (2*m*n + d) div (2*d), on longs throughout
    q = F.when(d != 0, F.call_function("div", a, F.lit(2) * d))
    return q.cast("double") / F.lit(float(10 ** places))


def total_on_hand(shelf="shelf_qty", backroom="backroom_qty") -> Column:
    """P-01: shelf + backroom."""
    return _c(shelf) + _c(backroom)


def cover_hours(on_hand=None, units="total_units_sold_intraday", day_hours: float = DAY_HOURS) -> Column:
    """P-02: on-hand / (units sold / 12.0); null when nothing was sold."""
    oh = total_on_hand() if on_hand is None else _c(on_hand)
    return F.try_divide(oh.cast("double"), _c(units).cast("double") / F.lit(float(day_hours)))


def risk_band(cover) -> Column:
    """P-03: <= 6 critical, <= 12 monitor, else normal; null stays null."""
    c = _c(cover)
    return (F.when(c <= CRITICAL_MAX_HOURS, F.lit(BAND_CRITICAL))
             .when(c <= MONITOR_MAX_HOURS, F.lit(BAND_MONITOR))
             .when(c.isNotNull(), F.lit(BAND_NORMAL)))


def net_revenue(subtotal="subtotal_amount", discount="discount", tax="tax_amount") -> Column:
    """P-05: subtotal - discount + tax (decimal arithmetic)."""
    return (_c(subtotal) - _c(discount) + _c(tax)).cast("decimal(18,2)")


def valid_transaction(total="total") -> Column:
    """P-05 filter: only transactions with total > 0."""
    return _c(total) > 0


def shelf_ratio(shelf="shelf_qty", on_hand=None) -> Column:
    """P-06: shelf / on-hand * 100, null on zero on-hand."""
    oh = total_on_hand() if on_hand is None else _c(on_hand)
    return F.try_divide(_c(shelf).cast("double"), oh.cast("double")) * F.lit(100.0)


def month_diff(start, end) -> Column:
    """Calendar-boundary month difference (DATE_DIFF(end, start, MONTH))."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def in_warranty(purchase_date, months, as_of) -> Column:
    """J-02: elapsed calendar months since purchase <= policy duration."""
    return month_diff(purchase_date, as_of) <= _c(months)
