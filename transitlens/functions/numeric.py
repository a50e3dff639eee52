"""Numeric helpers.

Rounding: ``F.round`` rounds the exact binary value half-up, other engines
round differently on binary ties. All rounding here goes through
``round_half_away`` (``floor(|x| * 10^d + 0.5)`` with the sign restored), and
averages of two-decimal speeds are taken over integer cents, so results are
reproducible in any SQL engine. The value differs from ``F.round`` only on
exact binary ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens.config import GPS_SCALE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# |x| * 10^d at or above 2^52: a double that large has no fractional digits
WHOLE_DOUBLE = 4503599627370496.0


def round_half_away(c, digits: int = 0) -> Column:
    """Round half away from zero to ``digits`` decimals; returns double.

    Values already whole at that scale are returned unchanged (this also keeps
    the integer intermediate far from overflow).
    """
    x = _c(c).cast("double")
    s = float(10 ** digits)
    mag = F.floor(F.abs(x) * F.lit(s) + F.lit(0.5))  # bigint, never -0
    signed = F.when(x < 0, -mag).otherwise(mag)
    rounded = signed.cast("double") / F.lit(s) if digits else signed.cast("double")
    return F.when(F.abs(x) * F.lit(s) >= F.lit(WHOLE_DOUBLE), x).otherwise(rounded)


def to_cents(c) -> Column:
    """Non-negative value -> integer hundredths, rounded half up."""
    return F.floor(_c(c) * F.lit(100.0) + F.lit(0.5))


def cents_to_units(c) -> Column:
    return _c(c).cast("double") / F.lit(100.0)


def number(c) -> Column:
    """Column as double with NaN as missing, as every profile operator counts it."""
    x = _c(c).cast("double")
    return F.when(~F.isnan(x), x)


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (never raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def avg_cents_rounded(sum_cents, count_cents) -> Column:
    """Mean of cent values rounded to two decimals, from an exact integer sum."""
    return cents_to_units(F.floor(safe_ratio(sum_cents, count_cents) + F.lit(0.5)))


def scale_coordinates(c, scale: float = GPS_SCALE) -> Column:
    """Fixed-point coordinate string -> degrees. Null or malformed -> null."""
    return _c(c).try_cast("double") / F.lit(float(scale))


def cast_delay(c) -> Column:
    """Delay string -> int; malformed values become null instead of failing."""
    return _c(c).try_cast("int")


def round_sig(c, n: int = 9) -> Column:
    """Round to ``n`` significant digits (half away from zero); 0 and null kept.

    Used for floating summaries (means, deviations, correlations) whose last
    bits depend on summation order.
    """
    x = _c(c).cast("double")
    d = F.lit(n - 1) - F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), d)
    mag = F.floor(F.abs(x) * scale + F.lit(0.5)) / scale
    return F.when(x == 0, F.lit(0.0)).when(x < 0, -mag).otherwise(mag)
