"""Profiling over any table (the data behind the exploration report).

Every summary is one aggregate pass (partial aggregation before the shuffle)
or a grouped count; exact quartiles come from :mod:`quantiles`. Outputs are
long-form rows so wide tables do not need wide results. Values are returned
as they are: observed values exactly, means and deviations to the last bit of
their summation order. NaN counts as missing in every numeric operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.functions.numeric import number, round_half_away, safe_ratio
from transitlens.functions.trip import delay_category, trip_efficiency
from transitlens.operators.dimension import materialize
from transitlens.operators.quantiles import exact_quantiles_multi

DELAY_CATEGORIES = ("High Negative", "Negative", "Positive", "High Positive")


def _stack(wide: DataFrame, names: list[str], fields: list[str], key: str = "column_name") -> DataFrame:
    """Wide one-row result with ``{name}__{field}`` columns -> one row per name."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts += [f"`{n}__{f}`" for f in fields]
    return wide.selectExpr(f"stack({len(names)}, {', '.join(parts)}) AS ({key}, {', '.join(fields)})")


def missing_values(df: DataFrame) -> DataFrame:
    """column_name, missing_count, missing_percent; a final row ``*`` holds the grand total."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__missing_count") for c in cols]
    wide = df.agg(*aggs)
    wide = wide.withColumn("*__missing_count", sum((F.col(f"`{c}__missing_count`") for c in cols), F.lit(0)))
    names = cols + ["*"]
    for n in names:
        wide = wide.withColumn(f"{n}__missing_percent", safe_ratio(
            F.col(f"`{n}__missing_count`") * 100.0, F.col("_rows")))
    return _stack(wide, names, ["missing_count", "missing_percent"])


def numeric_summary(df: DataFrame, cols) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per column (NaN counts as missing)."""
    aggs = []
    for c in cols:
        x = number(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    # count / min / max here are those of the non-null values the quantiles rank
    stats = {c: (row[f"{c}__count"], row[f"{c}__min"], row[f"{c}__max"]) for c in cols}
    qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75], stats=stats)
    out = []
    for c in cols:
        q = qs[c]
        out.append((c, row[f"{c}__count"], row[f"{c}__mean"], row[f"{c}__std"], row[f"{c}__min"],
                    q[0.25], q[0.5], q[0.75], row[f"{c}__max"]))
    schema = ("column_name string, count long, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")
    return df.sparkSession.createDataFrame(out, schema)


def _as_text(df: DataFrame, c: str) -> Column:
    """A value as text, as distinct as the value itself (-0.0 is 0.0)."""
    col = F.col(f"`{c}`")
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return (col + F.lit(0.0).cast(df.schema[c].dataType) if floating else col).cast("string")


def distinct_counts(df: DataFrame, cols) -> DataFrame:
    """column_name, n_distinct (nulls not counted).

    Values are grouped as narrow (column number, value) pairs, once each after
    the first merge in their task; a wide row is never sent once per column.
    """
    cols = list(cols)
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), _as_text(df, c).alias("_v")) for i, c in enumerate(cols)])))
    distinct = pairs.filter(F.col("_v").isNotNull()).distinct()
    wide = distinct.agg(*[F.count_if(F.col("_i") == i).alias(f"{c}__n_distinct") for i, c in enumerate(cols)])
    return _stack(wide, cols, ["n_distinct"])


def value_counts_topk(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """value, count for the k most frequent non-null values (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count()
            .orderBy(F.desc("count"), F.asc("value")).limit(k))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """value, count, percent of the non-null rows.

    The input is read once: its grouped counts are written and summed there.
    """
    counts = materialize(df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count())
    total = counts.agg(F.sum("count")).first()[0]
    return counts.withColumn("percent", safe_ratio(F.col("count") * 100.0, F.lit(total).cast("double")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each identical group (nulls equal)."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def _quartiles(df: DataFrame, cols) -> dict:
    qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75])
    return {c: (q[0.25], q[0.5], q[0.75]) for c, q in qs.items()}


def iqr_outliers(df: DataFrame, cols) -> DataFrame:
    """column_name, q1, q3, lower, upper, outliers, outlier_percent (of all rows)."""
    bounds = {}
    quart = _quartiles(df, cols)
    for c in cols:
        q1, _, q3 = quart[c]
        iqr = None if q1 is None else q3 - q1
        bounds[c] = (q1, q3, None if iqr is None else q1 - 1.5 * iqr, None if iqr is None else q3 + 1.5 * iqr)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        _, _, lo, hi = bounds[c]
        x = number(c)
        out = (x < F.lit(lo)) | (x > F.lit(hi)) if lo is not None else F.lit(False)
        aggs.append(F.count_if(out).alias(f"{c}__outliers"))
    wide = df.agg(*aggs)
    for c in cols:
        q1, q3, lo, hi = bounds[c]
        wide = (wide.withColumn(f"{c}__q1", F.lit(q1).cast("double"))
                .withColumn(f"{c}__q3", F.lit(q3).cast("double"))
                .withColumn(f"{c}__lower", F.lit(lo).cast("double"))
                .withColumn(f"{c}__upper", F.lit(hi).cast("double"))
                .withColumn(f"{c}__outlier_percent",
                            safe_ratio(F.col(f"{c}__outliers") * 100.0, F.col("_rows"))))
    res = _stack(wide, list(cols), ["q1", "q3", "lower", "upper", "outliers", "outlier_percent"])
    return res.select("column_name", "outliers", "q1", "q3", "lower", "upper", "outlier_percent")


def total_outliers(df: DataFrame, cols) -> DataFrame:
    """One row: outliers summed over the columns."""
    return iqr_outliers(df, cols).agg(F.sum("outliers").alias("total_outliers"))


def histogram_30(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """bin, lower, upper, count over equal-width bins from min to max (last bin closed).

    Every bin is listed, empty ones with count 0. A constant column uses the
    range [v - 0.5, v + 0.5] as numpy does.
    """
    x = number(col)
    r = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    spark = df.sparkSession
    if r["mn"] is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count long")
    lo, hi = (r["mn"], r["mx"]) if r["mn"] < r["mx"] else (r["mn"] - 0.5, r["mx"] + 0.5)
    idx = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).count()
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return (grid.join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    F.when(F.col("bin") == bins - 1, F.lit(hi))
                    .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def boxplot_stats(df: DataFrame, cols) -> DataFrame:
    """column_name, q1, median, q3, whisker_low, whisker_high (furthest values within 1.5 IQR)."""
    qs = _quartiles(df, cols)
    aggs = []
    for c in cols:
        q1, _, q3 = qs[c]
        x = number(c)
        if q1 is None:
            aggs += [F.lit(None).cast("double").alias(f"{c}__whisker_low"),
                     F.lit(None).cast("double").alias(f"{c}__whisker_high")]
            continue
        iqr = q3 - q1
        aggs += [F.min(F.when(x >= F.lit(q1 - 1.5 * iqr), x)).alias(f"{c}__whisker_low"),
                 F.max(F.when(x <= F.lit(q3 + 1.5 * iqr), x)).alias(f"{c}__whisker_high")]
    wide = df.agg(*aggs)
    for c in cols:
        q1, q2, q3 = qs[c]
        wide = (wide.withColumn(f"{c}__q1", F.lit(q1).cast("double"))
                .withColumn(f"{c}__median", F.lit(q2).cast("double"))
                .withColumn(f"{c}__q3", F.lit(q3).cast("double")))
    return _stack(wide, list(cols), ["q1", "median", "q3", "whisker_low", "whisker_high"])


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """row_name, col_name, corr (Pearson, rows with a null in the pair skipped).

    The matrix is symmetric, so each unordered pair is aggregated once.
    """
    cols = list(cols)
    half = {(a, b): F.corr(number(a), number(b)) for i, a in enumerate(cols) for b in cols[i:]}
    wide = df.agg(*[c.alias(f"{a}|{b}__corr") for (a, b), c in half.items()])
    wide = wide.select("*", *[F.col(f"`{b}|{a}__corr`").alias(f"{a}|{b}__corr")
                              for a in cols for b in cols if (a, b) not in half])
    names = [f"{a}|{b}" for a in cols for b in cols]
    res = _stack(wide, names, ["corr"], key="pair")
    return res.select(F.split("pair", r"\|").getItem(0).alias("row_name"),
                      F.split("pair", r"\|").getItem(1).alias("col_name"),
                      "corr")


def mean_by_group(df: DataFrame, by: str, col: str) -> DataFrame:
    """by, mean_{col}; null group keys dropped; sorted by the mean, descending."""
    m = f"mean_{col}"
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.avg(number(col)).alias(m))
            .orderBy(F.desc(m), F.asc(by)))


def best_worst_group(df: DataFrame, by: str, col: str) -> DataFrame:
    """One row: the group with the highest and with the lowest mean (ties: smallest key)."""
    g = (df.filter(F.col(by).isNotNull()).groupBy(by)
         .agg(F.avg(number(col)).alias("m")).filter(F.col("m").isNotNull()))
    return g.agg(F.min(F.struct((-F.col("m")).alias("k"), F.col(by).alias("g"))).getField("g").alias("best"),
                 F.min(F.struct(F.col("m").alias("k"), F.col(by).alias("g"))).getField("g").alias("worst"))


# --- trip-table analyses ------------------------------------------------------

def with_trip_features(trips: DataFrame) -> DataFrame:
    """EFFICIENCY = AVGVELOCITY / TRIPDURATION and the delay category."""
    return (trips.withColumn("EFFICIENCY", trip_efficiency("AVGVELOCITY", "TRIPDURATION"))
            .withColumn("DELAY_CATEGORY", delay_category("AVGDELAY")))


def line_performance(trips: DataFrame, top: int = 15) -> DataFrame:
    """Per LINE: mean / std / count of duration, mean / std of delay and speed (2 dp);
    the ``top`` lines by mean duration."""
    aggs = []
    for c, fs in (("TRIPDURATION", ("mean", "std", "count")), ("AVGDELAY", ("mean", "std")),
                  ("AVGVELOCITY", ("mean", "std"))):
        x = number(c)
        for f in fs:
            e = {"mean": F.avg(x), "std": F.stddev_samp(x), "count": F.count(x)}[f]
            aggs.append((e if f == "count" else round_half_away(e, 2)).alias(f"{c}_{f}"))
    return (trips.filter(F.col("LINE").isNotNull()).groupBy("LINE").agg(*aggs)
            .orderBy(F.desc("TRIPDURATION_mean"), F.asc("LINE")).limit(top))


def efficiency_by_group(trips: DataFrame, by: str) -> DataFrame:
    """mean, std, count of EFFICIENCY per group, 4 dp."""
    t = with_trip_features(trips)
    return (t.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(round_half_away(F.avg("EFFICIENCY"), 4).alias("mean"),
                 round_half_away(F.stddev_samp("EFFICIENCY"), 4).alias("std"),
                 F.count("EFFICIENCY").alias("count")))


def delay_crosstab(trips: DataFrame) -> DataFrame:
    """TIMEOFDAY x DELAY_CATEGORY counts, absent cells 0 (fixed category list, no extra pass)."""
    t = with_trip_features(trips).filter(F.col("TIMEOFDAY").isNotNull() & F.col("DELAY_CATEGORY").isNotNull())
    p = t.groupBy("TIMEOFDAY").pivot("DELAY_CATEGORY", list(DELAY_CATEGORIES)).count()
    return p.select("TIMEOFDAY", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(c)
                                   for c in DELAY_CATEGORIES])


def dataset_overview(trips: DataFrame) -> DataFrame:
    """rows, first and last DATE, distinct lines, mean duration, delay and speed."""
    return trips.agg(
        F.count(F.lit(1)).alias("rows"), F.min("DATE").alias("first_date"), F.max("DATE").alias("last_date"),
        F.count_distinct("LINE").alias("lines"),
        F.avg(number("TRIPDURATION")).alias("mean_tripduration"),
        F.avg(number("AVGDELAY")).alias("mean_avgdelay"),
        F.avg(number("AVGVELOCITY")).alias("mean_avgvelocity"))


def rush_vs_nonrush(trips: DataFrame) -> DataFrame:
    """Mean efficiency in and out of rush hour and their absolute difference."""
    t = with_trip_features(trips)
    a = F.avg(F.when(F.col("RUSHHOUR") == F.lit(True), F.col("EFFICIENCY")))
    b = F.avg(F.when(F.col("RUSHHOUR") == F.lit(False), F.col("EFFICIENCY")))
    return t.agg(a.alias("rush_efficiency"),
                 b.alias("nonrush_efficiency"),
                 F.abs(a - b).alias("efficiency_difference"))


def categorical_summary(df: DataFrame, cols, k: int = 10) -> DataFrame:
    """Per column: distinct non-null values and the k most frequent values.

    column_name, n_distinct, rank, value (as text), count. Each column is a
    grouped count with its own top-k (TakeOrderedAndProject), so no task ever
    ranks all distinct values of a column.
    """
    nd = distinct_counts(df, cols)
    parts = []
    for c in cols:
        top = value_counts_topk(df, c, k).select(F.lit(c).alias("column_name"),
                                                 F.col("value").cast("string").alias("value"), "count")
        parts.append(top)
    tops = parts[0]
    for p in parts[1:]:
        tops = tops.unionByName(p)
    # rank inside each column's (at most k) top values
    from pyspark.sql import Window
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    tops = tops.withColumn("rank", F.row_number().over(w))
    return tops.join(F.broadcast(nd), "column_name").select("column_name", "n_distinct", "rank", "value", "count")
