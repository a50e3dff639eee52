"""Gold: speed per route segment (stop n -> stop n + 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.functions.numeric import avg_cents_rounded, round_half_away

SEGMENT_KEYS = ("RUTA", "ORIENTATION", "segment_start", "segment_end", "date")


def next_stop_number(core: DataFrame) -> DataFrame:
    """Kept pings as segments: from their own stop to that of the trip's next kept ping.

    The core already knows the next kept stop across its time slices, so naming
    the two ends is all that is left; no window or shuffle is needed.
    """
    rows = core.filter("_keep") if "_keep" in core.columns else core
    ends = {"segment_start": "row_number", "segment_end": "next_kept_row"}
    return rows.select("*", *[F.col(source).alias(name) for name, source in ends.items()])


def adjacent_segment_filter(df: DataFrame, require_adjacent: bool = True) -> DataFrame:
    """Segments with two known ends, by default only those to the very next stop."""
    step = F.col("segment_end") - F.col("segment_start")  # null if either end is unknown
    return df.filter(step == 1 if require_adjacent else step.isNotNull())


def segment_speed(segments: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Speed figures of each line's segments, by direction and date.

    Speeds are averaged as whole cents where the input carries them. Every
    aggregate merges partially, so a hot segment costs one partial row per map
    task in the shuffle. The median is approximate but always an observed value.
    """
    if "VELOCITY_CENTS" in segments.columns:
        mean = avg_cents_rounded(F.sum("VELOCITY_CENTS"), F.count("VELOCITY_CENTS"))
    else:
        mean = round_half_away(F.avg("VELOCITY"), 2)
    median = F.percentile_approx("VELOCITY", 0.5, accuracy)
    figures = {"OBS": F.count("*"), "AVG_SPEED_M_S": mean,
               "AVG_DIST_M": round_half_away(F.avg("haversine_dist"), 1),
               "MEDIAN_SPEED_M_S": round_half_away(median, 2)}
    keys = [F.col("RUTA").alias("LINE"), *SEGMENT_KEYS[1:]]
    return segments.groupBy(*keys).agg(*[c.alias(n) for n, c in figures.items()])


def route_segment_speed(core: DataFrame) -> DataFrame:
    """gold_route_segment_speed from the (pre-drop) enrichment core."""
    return segment_speed(adjacent_segment_filter(next_stop_number(core)))
