"""Trip-level scalar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens.functions.numeric import cents_to_units, safe_ratio, to_cents


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ping_velocity_cents(dist, secs) -> Column:
    """Speed in hundredths of m/s, rounded half up; null unless secs > 0."""
    s = _c(secs)
    return F.when(s > 0, to_cents(_c(dist) / s.cast("double")))


def ping_velocity(dist, secs) -> Column:
    """round(dist / secs, 2); null unless secs > 0."""
    return cents_to_units(ping_velocity_cents(dist, secs))


def trip_efficiency(velocity, duration) -> Column:
    """velocity / duration; null when the duration is 0 or null."""
    return safe_ratio(velocity, duration)


def delay_category(c) -> Column:
    """Right-closed bins (-inf,-100], (-100,0], (0,100], (100,inf)."""
    x = _c(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x <= -100, F.lit("High Negative"))
            .when(x <= 0, F.lit("Negative"))
            .when(x <= 100, F.lit("Positive"))
            .otherwise(F.lit("High Positive")))
