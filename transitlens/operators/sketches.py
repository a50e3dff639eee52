"""Summaries by date that merge over any range of dates, without reading the rows again.

Distinct values: a theta sketch for each column and date. A union of sketches
estimates the distinct values of all its dates; it is exact up to
``2 ** DISTINCT_LG`` values, and beyond that has a relative standard error of
``2 ** (-DISTINCT_LG / 2)`` (0.8 %).

Segment speeds: counts and sums in whole numbers (cents, micrometres), exact over
any range, and a KLL sketch of the speeds for each segment and date. A merged
sketch's median is an observed value; it is the exact median up to ``SPEED_K``
observations, and beyond that its rank is off by at most about
``SPEED_RANK_ERROR`` of them (99 % confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.functions.numeric import avg_cents_rounded, round_half_away, safe_ratio

DISTINCT_LG = 14
SPEED_K = 1024
SPEED_RANK_ERROR = 0.003
MICRO = 1_000_000
SEGMENT = ("LINE", "ORIENTATION", "segment_start", "segment_end")


def _item(df: DataFrame, c: str) -> Column:
    """A value as the sketches take it: equal values give equal items (-0.0 is 0.0), nulls none."""
    dtype, col = df.schema[c].dataType, F.col(f"`{c}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.cast("double") + F.lit(0.0)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("long")
    return col.cast("string")


def distinct_sketches(df: DataFrame, cols: list[str], by: str, lg: int = DISTINCT_LG) -> DataFrame:
    """``by``, ``column_name``, ``n_rows`` and ``sketch`` of each column's values on each date.

    One aggregation for all columns; sketches merge before the shuffle.
    """
    wide = df.groupBy(F.col(f"`{by}`").alias("_by")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.theta_sketch_agg(_item(df, c), lg).alias(f"_s{i}") for i, c in enumerate(cols)])
    items = ", ".join(f"'{c}', _s{i}" for i, c in enumerate(cols))
    return wide.selectExpr("_by", "_n", f"stack({len(cols)}, {items}) AS (column_name, sketch)").select(
        F.col("_by").alias(by), "column_name", F.col("_n").alias("n_rows"), "sketch")


def distinct_in_range(sketches: DataFrame, by: str, first, last, lg: int = DISTINCT_LG) -> DataFrame:
    """``column_name``, ``n_rows`` and ``n_distinct`` over the dates from ``first`` to ``last``."""
    within = sketches.filter(F.col(by).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return within.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.theta_sketch_estimate(F.theta_union_agg("sketch", lg)).alias("n_distinct"))


def segment_summaries(segments: DataFrame, k: int = SPEED_K) -> DataFrame:
    """Counts, whole-number sums and a speed sketch of each segment and date (from ``adjacent_segment_filter``)."""
    micro = F.round(F.col("haversine_dist") * MICRO).cast("long")
    return segments.groupBy(F.col("RUTA").alias("LINE"), *SEGMENT[1:], "date").agg(
        F.count(F.lit(1)).alias("OBS"), F.sum("VELOCITY_CENTS").alias("SPEED_SUM"), F.count("VELOCITY_CENTS").alias("SPEED_N"),
        F.sum(micro).alias("DIST_SUM"), F.count(micro).alias("DIST_N"),
        F.kll_sketch_agg_double("VELOCITY", k).alias("SPEEDS"))


def segment_speed_range(summaries: DataFrame, first, last, k: int = SPEED_K) -> DataFrame:
    """Speed figures of each segment over the dates from ``first`` to ``last``, as ``segment_speed`` gives them for a date."""
    within = summaries.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    merged = within.groupBy(*SEGMENT).agg(*[F.sum(c).alias(c) for c in ("OBS", "SPEED_SUM", "SPEED_N", "DIST_SUM", "DIST_N")],
                                          F.kll_merge_agg_double("SPEEDS", k).alias("SPEEDS"))
    median = F.when(F.col("SPEED_N") > 0, F.kll_sketch_get_quantile_double("SPEEDS", F.lit(0.5)))
    metres = safe_ratio(F.col("DIST_SUM").cast("double"), F.col("DIST_N")) / F.lit(float(MICRO))
    return merged.select(*SEGMENT, "OBS", avg_cents_rounded(F.col("SPEED_SUM"), F.col("SPEED_N")).alias("AVG_SPEED_M_S"),
                         round_half_away(metres, 1).alias("AVG_DIST_M"), round_half_away(median, 2).alias("MEDIAN_SPEED_M_S"))
