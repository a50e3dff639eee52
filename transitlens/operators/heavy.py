"""The most frequent values, exactly, without shuffling every distinct value.

A count-min table bounds every value's count from above: rows are counted by
``DEPTH`` hashes of the value into ``WIDTH`` buckets each, and a value's count is
at most the least of its buckets. Only values whose bound reaches a threshold
are counted themselves. If ``k`` of them have counts of at least the threshold,
the first ``k`` of them are the answer: a value left out has a smaller bound,
hence a smaller count. If not, the ``k``-th best count found is a threshold that
``k`` values reach, and a second try with it always ends the search. Where fewer
than ``k`` values were found at all, the threshold is lowered; at 1 every value
is counted, which is the plain grouped count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.operators.dimension import materialize

WIDTH = 1 << 16
DEPTH = 2
#: buckets that a first threshold lets through, for each wanted value
SPARE = 4
#: by how much a threshold that finds too few values is lowered
LOWER = 8


def _value(df: DataFrame, col: str) -> Column:
    floating = isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))
    c = F.col(f"`{col}`")
    return c + F.lit(0.0).cast(df.schema[col].dataType) if floating else c  # -0.0 is 0.0


def _bucket(value: Column, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(row)), F.lit(width)).cast("int")


def bucket_counts(values: DataFrame, width: int, depth: int) -> DataFrame:
    """``row, bucket, n``: at most ``width * depth`` rows; counts merge before the shuffle."""
    places = F.array(*[F.struct(F.lit(r).alias("row"), _bucket(F.col("value"), r, width).alias("bucket")) for r in range(depth)])
    return values.select(F.inline(places)).groupBy("row", "bucket").agg(F.count(F.lit(1)).alias("n"))


def candidates(values: DataFrame, buckets: DataFrame, threshold: int, width: int, depth: int) -> DataFrame:
    """Rows whose value may have a count of ``threshold`` or more: all its buckets do."""
    for r in range(depth):
        # at most ``width`` small numbers
        full = buckets.filter((F.col("row") == r) & (F.col("n") >= threshold)).select(F.col("bucket").alias("_b"))
        values = values.join(F.broadcast(full), _bucket(F.col("value"), r, width) == F.col("_b"), "left_semi")
    return values


def heavy_hitters(df: DataFrame, col: str, k: int = 10, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``value, count`` of the ``k`` most frequent non-null values (ties by value), as ``value_counts_topk``."""
    values = df.select(_value(df, col).alias("value")).filter(F.col("value").isNotNull())
    buckets = materialize(bucket_counts(values, width, depth))
    top = buckets.filter("row = 0").orderBy(F.desc("n")).limit(SPARE * k).agg(F.min("n")).first()[0]
    threshold, found, sure = max(1, top or 1), None, False
    while True:
        rows = candidates(values, buckets, threshold, width, depth) if threshold > 1 else values
        counted = rows.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
        found = counted.orderBy(F.desc("count"), F.asc("value")).limit(k).collect()  # ``k`` rows
        least = found[-1]["count"] if len(found) == k else 0
        if sure or threshold == 1 or least >= threshold:
            return df.sparkSession.createDataFrame(found, counted.schema)
        sure = least > 0
        threshold = least if sure else max(1, threshold // LOWER)
