"""Time helpers. All results are TIMESTAMP_NTZ / DATE wall-clock values, so
they do not depend on ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens.config import LOCAL_TZ


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_local_time(c, tz: str = LOCAL_TZ) -> Column:
    """Epoch seconds (fraction cut, as a cast to long does) -> local wall clock.

    UTC instant -> wall clock in ``tz``; returned as TIMESTAMP_NTZ.
    """
    secs = F.floor(_c(c).try_cast("double"))
    utc_wall = F.timestamp_add("SECOND", secs, _epoch_ntz())
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def local_date(c) -> Column:
    return F.to_date(_c(c))


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (sub-second part cut), as unix_timestamp."""
    return F.unix_timestamp(_c(c))


def trip_duration_minutes(start, end) -> Column:
    """round((end - start) / 60) in whole minutes, as double."""
    secs = epoch_seconds(end) - epoch_seconds(start)
    return F.floor(secs / F.lit(60.0) + F.lit(0.5)).cast("double")


# The published time-of-day and rush-hour bounds, in whole hours, both ends included.
TIMES_OF_DAY = {"morning": (4, 11), "afternoon": (12, 17), "evening": (18, 23)}
OTHER_TIME = "night"
RUSH_HOURS = ((6, 9), (16, 19))


def time_of_day_bucket(ts) -> Column:
    """Name of the time of day of a start; ``OTHER_TIME`` for all other hours and for null."""
    hour = F.hour(_c(ts))
    names = [F.when(hour.between(*bounds), F.lit(name)) for name, bounds in TIMES_OF_DAY.items()]
    return F.coalesce(*names, F.lit(OTHER_TIME))


def rush_hour_flag(ts) -> Column:
    """Whether a start falls in a rush hour. A null hour gives false."""
    hour = F.hour(_c(ts))
    inside = [F.coalesce(hour.between(*bounds), F.lit(False)) for bounds in RUSH_HOURS]
    return inside[0] | inside[1]
