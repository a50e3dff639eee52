"""Profiling properties and the distributed exact quantile."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlens.operators import profile, quantiles
from transitlens.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([rnd.gauss(0, 10), 3.0, 3.0, None]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])
    arr = np.array([v for v in vals if v is not None])
    for q, v in got.items():
        assert v == pytest.approx(float(np.quantile(arr, q)), rel=1e-12, abs=1e-12), q


def test_exact_quantiles_hot_value(spark):
    df = spark.createDataFrame([(5.0,)] * 2000 + [(1.0,), (9.0,)], "x double")
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert got == {0.25: 5.0, 0.5: 5.0, 0.75: 5.0}


def test_histogram_counts_sum_to_non_null(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    df = df.union(spark.createDataFrame([(None,)], "x double"))
    h = profile.histogram_30(df, "x").collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == 1000
    assert h[-1]["count"] > 0  # max lands in the closed last bin


def test_histogram_constant_column(spark):
    h = profile.histogram_30(spark.createDataFrame([(2.0,)] * 5, "x double"), "x").collect()
    assert sum(r["count"] for r in h) == 5 and h[0]["lower"] == 1.5 and h[-1]["upper"] == 2.5


def test_crosstab_sums_to_rows(spark):
    rows = [("L1", "morning", 10, -150), ("L1", "night", 20, 0), ("L2", "morning", 30, 50), ("L2", "evening", 40, 200),
            ("L3", "morning", 50, None)]
    trips = spark.createDataFrame(rows, "LINE string, TIMEOFDAY string, TRIPDURATION int, AVGDELAY int") \
        .withColumn("AVGVELOCITY", F.lit(1.0))
    ct = profile.delay_crosstab(trips).collect()
    assert sum(sum(r[c] for c in profile.DELAY_CATEGORIES) for r in ct) == 4
    m = {r.TIMEOFDAY: r for r in ct}
    assert m["morning"]["High Negative"] == 1 and m["morning"]["Positive"] == 1 and m["morning"]["Negative"] == 0


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    mv = {r.column_name: r for r in profile.missing_values(df).collect()}
    assert mv["b"].missing_count == 2 and mv["*"].missing_count == 2
    assert abs(mv["b"].missing_percent - 66.6666667) < 1e-6
    assert profile.duplicate_rows(df).first()[0] == 1


def test_best_worst_ties_take_smallest_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "g string, v double")
    r = profile.best_worst_group(df, "g", "v").first()
    assert (r.best, r.worst) == ("a", "c")


def test_single_row_groups_have_null_std(spark):
    trips = spark.createDataFrame([("L1", "morning", True, 30, 5, 2.5)],
                                  "LINE string, TIMEOFDAY string, RUSHHOUR boolean, TRIPDURATION int, "
                                  "AVGDELAY int, AVGVELOCITY double")
    s = {r.column_name: r for r in profile.numeric_summary(trips, ["TRIPDURATION", "AVGVELOCITY"]).collect()}
    assert s["TRIPDURATION"]["count"] == 1 and s["TRIPDURATION"].std is None
    assert s["TRIPDURATION"].q25 == s["TRIPDURATION"].q75 == 30.0
    lp = profile.line_performance(trips).first()
    assert lp.TRIPDURATION_count == 1 and lp.TRIPDURATION_std is None and lp.AVGVELOCITY_mean == 2.5
    eff = profile.efficiency_by_group(trips, "RUSHHOUR").first()
    assert eff["count"] == 1 and eff["std"] is None and eff["mean"] == round(2.5 / 30, 4)


SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, -1.0, 0.1, -0.1, 1.7976931348623157e308,
           -1.7976931348623157e308, float("inf"), float("-inf"), 2.0 ** 52, 2.0 ** 53 + 2, 1 / 3, 3.0, -7.5]


def _around_powers_of_two():
    p = [2.0 ** e for e in (-1074, -1022, -1021, -500, -29, -1, 0, 1, 2, 10, 29, 31, 52, 53, 500, 1023)]
    return [float(x) for v in p for x in (np.nextafter(v, 0), v, np.nextafter(v, np.inf))]


def test_codes_keep_the_order_and_lose_nothing(spark):
    rnd = np.random.default_rng(11)
    bits = rnd.integers(-2 ** 63, 2 ** 63, 3000, dtype=np.int64).view(np.float64)
    vals = SPECIAL + _around_powers_of_two() + [-v for v in _around_powers_of_two()] + [float(v) for v in bits if not np.isnan(v)]
    df = spark.createDataFrame([(v,) for v in vals + [None, float("nan")]], "x double")
    codes = [r.c0 for r in quantiles.with_codes(df, [F.col("x")]).collect()]
    assert codes[-2:] == [None, None] and codes[:-2] == [quantiles.encoded(v) for v in vals]
    pairs = sorted(zip(vals, codes, strict=False), key=lambda p: p[0])
    assert all((a[0] < b[0]) == (a[1] < b[1]) and (a[0] == b[0]) == (a[1] == b[1]) for a, b in zip(pairs, pairs[1:], strict=False))
    assert all(quantiles.decoded(c) == x for x, c in pairs)


@pytest.mark.parametrize("values", [[0.0, 1.0], [0.0, 1.0, 2.0], [float(k) for k in range(40)], [-0.0, 0.0, -3.5, 3.5],
                                    [float("-inf"), -1.0, 2.0, float("inf")], SPECIAL])
def test_quantiles_take_at_most_four_counting_passes(spark, values, monkeypatch):
    passes, real = [], quantiles.prefix_counts

    def counted(codes, inside):
        out = real(codes, inside)
        plan = out._jdf.queryExecution().toString()
        assert "Generate" not in plan and "Window" not in plan
        passes.append(inside)
        return out

    monkeypatch.setattr(quantiles, "prefix_counts", counted)
    n = 4000
    arr = np.array([values[k * len(values) // n] for k in range(n)])
    df = spark.createDataFrame([(float(v), float(i), float(i) ** 3 / 7) for i, v in enumerate(arr)], "x double, y double, z double")
    ranks = [0, 1, n // 4, n // 2, n - 2, n - 1]
    got = quantiles.kth_smallest_multi(df, [(c, r) for c in "xyz" for r in ranks])
    for c, a in (("x", arr), ("y", np.arange(n, dtype=float)), ("z", np.arange(n, dtype=float) ** 3 / 7)):
        assert [got[c, r] for r in ranks] == [float(v) for v in np.sort(a)[ranks]], c
    assert 1 <= len(passes) <= 4


def test_quantiles_of_empty_and_short_columns(spark):
    df = spark.createDataFrame([(1.5, None), (None, None), (float("nan"), None)], "x double, y double")
    assert exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == {0.0: 1.5, 0.5: 1.5, 1.0: 1.5}
    assert quantiles.exact_quantiles_multi(df, ["x", "y"], [0.5])["y"] == {0.5: None}
    assert quantiles.kth_smallest(df, "x", [0, 1]) == {0: 1.5, 1: None}


def test_observed_values_are_returned_whole_and_nan_is_missing(spark):
    vals = [1693526400.0, 1693526411.0, 1693526477.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = profile.numeric_summary(df, ["x"]).first()
    assert (s["count"], s["min"], s["q50"], s["max"]) == (3, 1693526400.0, 1693526411.0, 1693526477.0)
    h = profile.histogram_30(df, "x").collect()
    assert sum(r["count"] for r in h) == 3 and (h[0]["lower"], h[-1]["upper"]) == (1693526400.0, 1693526477.0)
    assert profile.iqr_outliers(df, ["x"]).first()["outliers"] == 0
    b = profile.boxplot_stats(df, ["x"]).first()
    assert (b["whisker_low"], b["median"], b["whisker_high"]) == (1693526400.0, 1693526411.0, 1693526477.0)
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (float("nan"), 9.0), (3.0, 6.0)], "a double, b double")
    assert all(abs(r["corr"] - 1) < 1e-12 for r in profile.correlation_matrix(two, ["a", "b"]).collect())
    assert profile.mean_by_group(two.selectExpr("'g' AS g", "a"), "g", "a").first()["mean_a"] == 2.0
