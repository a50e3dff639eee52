"""Silver enrichment: stop matching, neighbour pings, distance and speed.

Window layout
-------------
The source pipeline orders pings inside one window partition per trip key
(BUSNUMBER, RUTA, TRIPID, date, ORIENTATION). A single hot trip key would put
all of its pings into one task, so the ordered work is split in two levels:

1. every ping gets a time slice ``floor(epoch / slice_seconds)``; the ordered
   window (lag / lead / running sums) runs per (trip key, slice), so one key
   spreads over many tasks;
2. a per-(trip key, slice) summary (first and last ping, first kept ping, delay
   sums) is built with partial aggregation, ordered per trip key (at most
   ``86400 / slice_seconds`` rows per key, as ``date`` is a key) and joined
   back on the same (key, slice) columns, which repairs lag / lead and the
   running averages at slice edges exactly.

Null keys (unmatched stops give a null ORIENTATION) form their own partition
like in a window; they are carried as (coalesced value, null mask) so every
exchange and join uses plain equality on the same columns and the big side is
shuffled once.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.config import DEFAULT_SLICE_SECONDS, TRIP_KEYS
from transitlens.functions.geo import haversine_distance
from transitlens.functions.numeric import avg_cents_rounded, round_half_away, safe_ratio
from transitlens.functions.trip import ping_velocity_cents
from transitlens.functions.numeric import cents_to_units

GPSY_POSITIVE = "GPSY IS NOT NULL AND GPSY > 1"
DEFAULT_TIEBREAK = ("row_number", "ping_seq", "TASKID")
_NULL_SLICE = -(2 ** 62)
SLICE_COLUMNS = ["_slice", "_sub"]
# a (trip key, time slice) above this many pings is split by exact timestamp
DEFAULT_HOT_SLICE_ROWS = 5_000_000
DIST_DIGITS = 6

_SENTINEL = {T.StringType: "", T.IntegerType: 0, T.LongType: 0, T.ShortType: 0, T.ByteType: 0,
             T.DateType: "1970-01-01", T.DoubleType: 0.0, T.BooleanType: False,
             T.TimestampNTZType: "1970-01-01 00:00:00", T.TimestampType: "1970-01-01 00:00:00"}


def match_pings_to_stops(pings: DataFrame, stops: DataFrame) -> DataFrame:
    """Left equi-join on (STOPID, RUTA = LINE).

    A stop serving both directions fans the ping out; no match leaves LINE,
    ORIENTATION and row_number null. Columns of ``pings`` that the stop side
    defines are replaced (avoids ambiguous names). Pass ``stops`` through
    :func:`bounded_broadcast` to get a broadcast join.
    """
    right = stops.select(F.col("STOPID").alias("STOPID_stop"), "LINE", "ORIENTATION", "row_number")
    left = pings.drop(*[c for c in ("LINE", "ORIENTATION", "row_number", "STOPID_stop") if c in pings.columns])
    j = left.join(right, (left["STOPID"] == right["STOPID_stop"]) & (left["RUTA"] == right["LINE"]), "left")
    return j.drop("STOPID_stop")


def _key_columns(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """Add non-null stand-ins for the keys plus a null mask; return their names."""
    names, mask = [], F.lit(0)
    for i, k in enumerate(keys):
        dt = type(df.schema[k].dataType)
        # a type without a stand-in is keyed by its text, which is as distinct as the value
        if dt not in _SENTINEL:
            df = df.withColumn(f"_k{i}", F.coalesce(F.col(k).cast("string"), F.lit("")))
            mask = mask + F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
            names.append(f"_k{i}")
            continue
        sentinel = F.lit(_SENTINEL[dt])
        kc = f"_k{i}"
        df = df.withColumn(kc, F.coalesce(F.col(k), sentinel.cast(df.schema[k].dataType)))
        mask = mask + F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        names.append(kc)
    df = df.withColumn("_kn", mask)
    return df, names + ["_kn"]


def _over(expr: str, part: list[str], order: list[str]) -> Column:
    p = ", ".join(f"`{c}`" for c in part)
    o = ", ".join(f"`{c}`" for c in order)
    return F.expr(f"{expr} OVER (PARTITION BY {p} ORDER BY {o})")


def _split_hot_slices(base: DataFrame, kcols: list[str], ts: str, hot_rows: int | None,
                      max_hot: int = 100_000, tiebreak: tuple[str, ...] = DEFAULT_TIEBREAK) -> DataFrame:
    """Add ``_sub``: the exact timestamp inside slices holding more than ``hot_rows`` pings.

    A slice is one (trip key, time slice); ordering by (``_slice``, ``_sub``)
    is still the ping order, so every later step treats (slice, sub) as the
    slice. The hot-slice list has at most rows / ``hot_rows`` entries; up to
    ``max_hot`` of them are broadcast, more fall back to a shuffle join, and
    none (the usual case) skips the join. Inside one trip, pings sharing a
    timestamp come from one capture, so the refined groups stay small. Pings
    without a time, all in one slice, are split by the leading tie-breaks, stop
    and payload position, which is their order.
    """
    # slices are wholly split or wholly not, and order by _slice first, so the
    # stand-in value for unsplit slices is arbitrary
    floor_ts = F.lit("1970-01-01 00:00:00").cast(base.schema[ts].dataType)
    if not hot_rows:
        return base.withColumn("_sub", floor_ts)
    hot = (base.groupBy(*kcols, "_slice").count().filter(F.col("count") > F.lit(hot_rows))
           .select(*kcols, "_slice", F.lit(True).alias("_hot")))
    # one partial-aggregate pass; at most max_hot + 1 keys reach the driver
    found = hot.limit(max_hot + 1).collect()
    if not found:  # the usual case: nothing to split, no join
        return base.withColumn("_sub", floor_ts)
    if len(found) <= max_hot:
        hot_b = F.broadcast(base.sparkSession.createDataFrame(found, hot.schema))
    else:  # very many hot slices: shuffle join (AQE splits skewed partitions)
        hot_b = hot
    marked = base.join(hot_b, kcols + ["_slice"], "left")
    sub = F.coalesce(F.when(F.col("_hot"), F.col(ts)), floor_ts)
    if tiebreak[:2] == ("row_number", "ping_seq") and {"row_number", "ping_seq"} <= set(base.columns):
        place = ((F.coalesce("row_number", F.lit(-1)) + 1).cast("bigint") * (1 << 32)
                 + F.greatest(F.lit(0), F.least(F.coalesce("ping_seq", F.lit(-1)).cast("bigint") + 1, F.lit((1 << 32) - 1))))
        untimed = F.timestamp_add("MICROSECOND", place, floor_ts)
        sub = F.when(F.col("_hot") & F.col(ts).isNull(), untimed).otherwise(sub)
    return marked.withColumn("_sub", sub).drop("_hot")


def enrich_core(joined: DataFrame, keys=TRIP_KEYS, ts: str = "timestamp",
                tiebreak=DEFAULT_TIEBREAK, keep: str | Column = GPSY_POSITIVE,
                slice_seconds: int = DEFAULT_SLICE_SECONDS, two_sided: bool = True,
                hot_rows: int | None = DEFAULT_HOT_SLICE_ROWS) -> DataFrame:
    """Per-ping neighbour columns over ordered trip partitions.

    Adds prev_rownum, prev_time, next_time, AVGDELAY, LASTLATITUDE,
    LASTLONGITUDE, haversine_dist, time_s, VELOCITY (and integer VELOCITY_CENTS),
    plus ``_keep`` (the drop-expectation verdict, evaluated on the ping) and
    ``next_kept_row`` (row_number of the next ping that passes ``keep``).
    Internal columns ``_k*``, ``_kn``, ``_slice``, ``_sub`` stay for later passes.
    Speed is the leg arriving at the ping divided by ``time_s``: by default
    next minus previous ping time (the source's definition, about half the
    leg speed); ``two_sided=False`` uses ping time minus previous ping time.
    Ordering is (ts, *tiebreak); the running delay average uses ts only, so
    pings with equal timestamps share one value (RANGE frame). The tie-break
    columns must make the order total within a trip (stop position, payload
    position, then the feed's TASKID); without that, lag / lead between exact
    ties are arbitrary, as in any window.
    """
    tb = [c for c in tiebreak if c in joined.columns]
    keep_col = F.expr(keep) if isinstance(keep, str) else keep
    base = joined.withColumn("_keep", F.coalesce(keep_col, F.lit(False)))
    # null timestamps get the lowest slice (they sort first, as in the window)
    base = base.withColumn("_slice", F.coalesce(
        F.floor(F.unix_timestamp(F.col(ts)) / F.lit(float(slice_seconds))), F.lit(_NULL_SLICE)))
    base, kcols = _key_columns(base, keys)
    base = _split_hot_slices(base, kcols, ts, hot_rows, tiebreak=tuple(tb))
    slice_cols = ["_slice", "_sub"]
    part = kcols + slice_cols

    ordk = [F.col(ts).alias("t")] + [F.col(c).alias(f"b{i}") for i, c in enumerate(tb)]
    row_s = F.struct(*ordk, F.col("row_number").alias("rn"), F.col("GPSY").alias("y"),
                     F.col("GPSX").alias("x"))
    kept_s = F.when(F.col("_keep"), F.struct(*ordk, F.col("row_number").alias("rn")))

    # --- level 2: per-slice summary, ordered per trip key (small) ----------
    summ = base.groupBy(*part).agg(
        F.min(row_s).alias("_first"), F.max(row_s).alias("_last"),
        F.min(kept_s).alias("_first_kept"),
        F.sum("DELAY").alias("_dsum"), F.count("DELAY").alias("_dcnt"))
    wk = Window.partitionBy(*kcols).orderBy(*slice_cols)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    ws = Window.partitionBy(*kcols, "_slice")
    summ = summ.select(
        *part,
        F.lag("_last").over(wk).alias("_prev_last"),
        F.lead("_first").over(wk).alias("_next_first"),
        _over("lead(`_first_kept`) IGNORE NULLS", kcols, slice_cols).alias("_next_kept"),
        F.coalesce(F.sum("_dsum").over(before), F.lit(0)).alias("_dsum_before"),
        F.coalesce(F.sum("_dcnt").over(before), F.lit(0)).alias("_dcnt_before"),
        # pings without a time are ties of each other, across all parts of their slice
        F.sum("_dsum").over(ws).alias("_dsum_slice"), F.sum("_dcnt").over(ws).alias("_dcnt_slice"))

    # --- level 1: ordered window per (trip key, slice) ----------------------
    wl = Window.partitionBy(*part).orderBy(F.col(ts), *[F.col(c) for c in tb])
    wr = Window.partitionBy(*part).orderBy(F.col(ts))  # RANGE frame: ties share
    loc = base.select(
        *base.columns,
        F.row_number().over(wl).alias("_idx"),
        F.lead(F.lit(1)).over(wl).isNull().alias("_is_last"),
        F.lag("row_number").over(wl).alias("_lag_rn"),
        F.lag(ts).over(wl).alias("_lag_t"),
        F.lag("GPSY").over(wl).alias("_lag_y"),
        F.lag("GPSX").over(wl).alias("_lag_x"),
        F.lead(ts).over(wl).alias("_lead_t"),
        _over("lead(CASE WHEN `_keep` THEN named_struct('rn', `row_number`) END) IGNORE NULLS",
              part, [ts] + tb).alias("_lead_kept"),
        F.sum("DELAY").over(wr).alias("_dsum_loc"),
        F.count("DELAY").over(wr).alias("_dcnt_loc"),
    )
    s = summ.select(*[F.col(c).alias("_s" + c) for c in part],
                    *[c for c in summ.columns if c not in part])
    cond = reduce(lambda a, b: a & b, [loc[c] == s["_s" + c] for c in part])
    j = loc.join(s, cond, "inner").drop(*["_s" + c for c in part])

    first = F.col("_idx") == 1
    last = F.col("_is_last")
    j = j.select(
        *[c for c in loc.columns if not c.startswith("_") or c in ("_keep", "_slice", "_sub") or c in kcols],
        F.when(first, F.col("_prev_last.rn")).otherwise(F.col("_lag_rn")).alias("prev_rownum"),
        F.when(first, F.col("_prev_last.t")).otherwise(F.col("_lag_t")).alias("prev_time"),
        F.when(last, F.col("_next_first.t")).otherwise(F.col("_lead_t")).alias("next_time"),
        round_half_away(F.when(F.col(ts).isNull(), safe_ratio(F.col("_dsum_slice"), F.col("_dcnt_slice")))
                        .otherwise(safe_ratio(F.col("_dsum_before") + F.coalesce(F.col("_dsum_loc"), F.lit(0)),
                                              F.col("_dcnt_before") + F.col("_dcnt_loc")))).alias("AVGDELAY"),
        F.when(first, F.col("_prev_last.y")).otherwise(F.col("_lag_y")).alias("LASTLATITUDE"),
        F.when(first, F.col("_prev_last.x")).otherwise(F.col("_lag_x")).alias("LASTLONGITUDE"),
        F.coalesce(F.col("_lead_kept.rn"), F.when(F.col("_lead_kept").isNull(), F.col("_next_kept.rn")))
        .alias("next_kept_row"),
    )
    # metres to the micrometre: identical results whatever math library runs the trigonometry
    j = j.withColumn("haversine_dist", round_half_away(
        haversine_distance("LASTLATITUDE", "LASTLONGITUDE", "GPSY", "GPSX"), DIST_DIGITS))
    later = "next_time" if two_sided else ts
    j = j.withColumn("time_s", F.unix_timestamp(later) - F.unix_timestamp("prev_time"))
    j = j.withColumn("VELOCITY_CENTS", ping_velocity_cents(F.col("haversine_dist"), F.col("time_s")))
    j = j.withColumn("VELOCITY", cents_to_units(F.col("VELOCITY_CENTS")))
    return j


def running_avg_velocity(core: DataFrame, ts: str = "timestamp") -> DataFrame:
    """AVGVELOCITY = running mean of VELOCITY up to the ping (ties share), 2 dp.

    Same two-level layout: slice sums of integer cents, prefix over slices of
    one trip key, local RANGE-frame sums inside the slice.
    """
    kcols = [c for c in core.columns if re.fullmatch(r"_k(\d+|n)", c)]
    part = kcols + SLICE_COLUMNS
    summ = core.groupBy(*part).agg(F.sum("VELOCITY_CENTS").alias("_vsum"),
                                   F.count("VELOCITY_CENTS").alias("_vcnt"))
    before = Window.partitionBy(*kcols).orderBy(*SLICE_COLUMNS).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*[F.col(c).alias("_s" + c) for c in part],
                       F.coalesce(F.sum("_vsum").over(before), F.lit(0)).alias("_vsum_before"),
                       F.coalesce(F.sum("_vcnt").over(before), F.lit(0)).alias("_vcnt_before"))
    cond = reduce(lambda a, b: a & b, [core[c] == summ["_s" + c] for c in part])
    j = core.join(summ, cond, "inner").drop(*["_s" + c for c in part])
    wr = Window.partitionBy(*part).orderBy(F.col(ts))
    vs = F.col("_vsum_before") + F.coalesce(F.sum("VELOCITY_CENTS").over(wr), F.lit(0))
    vc = F.col("_vcnt_before") + F.count("VELOCITY_CENTS").over(wr)
    return j.withColumn("AVGVELOCITY", avg_cents_rounded(vs, vc)).drop("_vsum_before", "_vcnt_before")


ENRICHED_COLUMNS = (
    "BUSNUMBER", "DELAY", "PARADA", "RUTA", "RUTERO", "STOPID", "TASKID", "TELEGRAMDATE",
    "TRIPID", "timestamp", "GPSX", "GPSY", "date", "ping_seq", "LINE", "ORIENTATION", "row_number",
    "prev_rownum", "prev_time", "next_time", "AVGDELAY", "LASTLATITUDE", "LASTLONGITUDE",
    "haversine_dist", "time_s", "VELOCITY", "AVGVELOCITY",
)


def public_columns(df: DataFrame) -> DataFrame:
    """Drop internal helper columns (leading underscore, cents, next_kept_row)."""
    return df.select(*[c for c in df.columns
                       if not c.startswith("_") and c not in ("VELOCITY_CENTS", "next_kept_row")])


def ping_neighbors(joined: DataFrame, keys=TRIP_KEYS, ts: str = "timestamp", tiebreak=DEFAULT_TIEBREAK,
                   **kw) -> DataFrame:
    """Input columns plus prev_rownum, prev_time, next_time, LASTLATITUDE, LASTLONGITUDE."""
    core = enrich_core(joined, keys=keys, ts=ts, tiebreak=tiebreak, **kw)
    return core.select(*joined.columns, "prev_rownum", "prev_time", "next_time", "LASTLATITUDE", "LASTLONGITUDE")


def running_avg_delay(joined: DataFrame, keys=TRIP_KEYS, ts: str = "timestamp", **kw) -> DataFrame:
    """Input columns plus AVGDELAY (running mean up to the ping, ties share, rounded)."""
    return enrich_core(joined, keys=keys, ts=ts, **kw).select(*joined.columns, "AVGDELAY")


def enrich_pings(pings: DataFrame, stops: DataFrame, **kw) -> DataFrame:
    """Stop match + neighbours + distance + speed + running means, before the drop rule."""
    return public_columns(running_avg_velocity(enrich_core(match_pings_to_stops(pings, stops), **kw)))
