"""Great-circle distance as a native expression (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens.config import EARTH_METERS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_distance(lat1, lon1, lat2, lon2, radius: float = EARTH_METERS) -> Column:
    """Metres between (lat1, lon1) and (lat2, lon2); null if any input is null.

    The asin argument is clamped to 1 so rounding never yields NaN.
    """
    la1, lo1, la2, lo2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    dlat = F.radians(la2 - la1)
    dlon = F.radians(lo2 - lo1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(dlon / 2), 2))
    d = F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
    return F.when(la1.isNotNull() & lo1.isNotNull() & la2.isNotNull() & lo2.isNotNull(), d)
