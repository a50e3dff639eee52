"""Heavy hitters equal the plain grouped count, and shuffle few values where the data allow it."""

import pytest
from pyspark.sql import functions as F

from transitlens.operators import heavy as H
from transitlens.operators import profile


def _rows(df):
    return [tuple("nan" if v != v else v for v in r) for r in df.collect()]  # NaN equals NaN


def _same(df, k, **kw):
    got = _rows(H.heavy_hitters(df, "x", k, **kw).orderBy(F.desc("count"), F.asc("value")))
    assert got == _rows(profile.value_counts_topk(df, "x", k))
    return got


@pytest.fixture
def counted(monkeypatch):
    """Thresholds tried, and distinct values that were counted."""
    seen, real = [], H.candidates

    def spy(values, buckets, threshold, width, depth):
        out = real(values, buckets, threshold, width, depth)
        seen.append((threshold, out.select("value").distinct().count()))
        return out

    monkeypatch.setattr(H, "candidates", spy)
    return seen


def test_few_values_are_counted_where_counts_are_skewed(spark, counted):
    light = spark.range(100_000).select((F.col("id") % 50_000).alias("x"))
    hot = spark.range(30_000).select((F.lit(10 ** 6) + F.floor(F.sqrt(F.col("id") % 900))).alias("x"))
    df = light.unionByName(hot)
    assert len(_same(df, 20)) == 20
    assert all(n < 0.02 * 50_030 for _, n in counted) and len(counted) <= 2


def test_equal_counts_and_fewer_values_than_asked_for(spark, counted):
    _same(spark.range(6000).select((F.col("id") % 2000).alias("x")), 10)
    _same(spark.range(6000).select((F.col("id") % 2000).alias("x")), 10, width=16)  # every bucket is crowded
    _same(spark.range(50).select((F.col("id") % 7).alias("x")), 10)
    assert _same(spark.range(0).select(F.col("id").alias("x")), 10) == []


def test_nulls_texts_and_signed_zeros(spark):
    _same(spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [(None,)] * 9 + [("",)], "x string"), 2)
    got = _same(spark.createDataFrame([(0.0,), (-0.0,), (1.5,), (float("nan"),), (float("nan"),), (float("nan"),)], "x double"), 2)
    assert got[1] == (0.0, 2)


@pytest.mark.parametrize("width, depth", [(1, 1), (8, 1), (64, 3)])
def test_any_table_size_gives_the_same(spark, width, depth):
    df = spark.range(5000).select(F.floor(F.sqrt(F.col("id") * 3)).alias("x"))
    _same(df, 15, width=width, depth=depth)


def test_only_candidates_are_shuffled_by_value(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("value"))
    buckets = H.bucket_counts(df, 64, 2)
    plan = H.candidates(df, buckets, 5, 64, 2).groupBy("value").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
