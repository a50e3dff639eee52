"""Gold: trip detection, sanity rules and the published 8-column trips table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.config import TRIP_KEYS
from transitlens.functions.numeric import avg_cents_rounded, round_half_away, safe_ratio
from transitlens.functions.timefn import rush_hour_flag, time_of_day_bucket, trip_duration_minutes

# The columns of the candidates table and the bounds of a plausible trip (minutes, metres a second, stops).
CANDIDATE_COLUMNS = ("BUSNUMBER", "LINE", "STARTTIME", "ENDTIME", "date", "TRIPDURATION",
                     "AVGDELAY", "AVGVELOCITY", "ORIENTATION", "STARTSTOP", "ENDSTOP")
DURATION_BOUNDS, SPEED_BOUNDS, TERMINAL_SLACK = (10, 180), (0.2, 100), 2


def trip_boundary_filter(enriched: DataFrame, end: bool = False) -> DataFrame:
    """First pings of trips (prev_time null) or, with ``end``, last pings (next_time null)."""
    return enriched.filter(F.col("next_time" if end else "prev_time").isNull())


def trip_boundaries(enriched: DataFrame) -> DataFrame:
    """First and last pings labelled ``boundary`` start / end, in one pass; a single ping is both."""
    labels = F.filter(F.array(F.when(F.col("prev_time").isNull(), "start"), F.when(F.col("next_time").isNull(), "end")),
                      lambda x: x.isNotNull())
    ends = enriched.filter(F.col("prev_time").isNull() | F.col("next_time").isNull())
    return ends.withColumn("boundary", F.explode(labels))


def drop_single_ping_trips(pairs: DataFrame) -> DataFrame:
    """Keep pairs whose end has a predecessor and whose start has a successor."""
    return pairs.filter(F.col("END_prev_time").isNotNull() & F.col("START_next_time").isNotNull())


def pair_trip_endpoints(core: DataFrame, keys=TRIP_KEYS, ts: str = "timestamp",
                        tiebreak=("row_number", "ping_seq", "TASKID")) -> DataFrame:
    """Pair each trip's first ping with its last ping, in one grouped pass.

    Equivalent to joining the first-ping rows with the last-ping rows on the
    trip keys after the ``gpsy_positive`` drop: a pair exists when no key is
    null and both end pings pass the rule. The whole-trip delay and speed
    means are the running averages at the last ping. Partial aggregation
    keeps the shuffle at one row per trip key and map task, however hot a key.

    Output: BUSNUMBER, LINE, TRIPID, date, ORIENTATION, STARTTIME, ENDTIME,
    STARTSTOP, ENDSTOP, START_next_time, END_prev_time, AVGDELAY, AVGVELOCITY
    (the last two as doubles, rounded as in the enriched table).
    """
    tb = [c for c in tiebreak if c in core.columns]
    ordk = [F.col(ts).alias("t")] + [F.col(c).alias(f"b{i}") for i, c in enumerate(tb)]
    row_s = F.struct(*ordk, F.col("row_number").alias("rn"), F.col("_keep").alias("ok"),
                     F.col("prev_time").alias("pt"), F.col("next_time").alias("nt"))
    kcols = [f"_k{i}" for i in range(len(keys))]
    if all(c in core.columns for c in kcols + ["_kn"]) and list(keys) == list(TRIP_KEYS):
        # the enrichment core is clustered and sorted on its non-null key
        # stand-ins: grouping on them needs no extra sort before the partial
        # aggregation; a zero null mask selects keys without nulls
        src = core.filter(F.col("_kn") == 0)
        group = kcols
        names = dict(zip(kcols, keys))
    else:
        src = core.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        group = list(keys)
        names = {k: k for k in keys}
    g = (src.groupBy(*group)
         .agg(F.min(row_s).alias("_s"), F.max(row_s).alias("_e"),
              F.sum("DELAY").alias("_dsum"), F.count("DELAY").alias("_dcnt"),
              F.sum("VELOCITY_CENTS").alias("_vsum"), F.count("VELOCITY_CENTS").alias("_vcnt")))
    g = g.filter(F.col("_s.ok") & F.col("_e.ok"))
    g = g.select(*[F.col(c).alias(names[c]) for c in group], *[c for c in g.columns if c not in group])
    return g.select(
        "BUSNUMBER", F.col("RUTA").alias("LINE"), "TRIPID", "date", "ORIENTATION",
        F.col("_s.t").alias("STARTTIME"), F.col("_e.t").alias("ENDTIME"),
        F.col("_s.rn").alias("STARTSTOP"), F.col("_e.rn").alias("ENDSTOP"),
        F.col("_s.nt").alias("START_next_time"), F.col("_e.pt").alias("END_prev_time"),
        round_half_away(safe_ratio("_dsum", "_dcnt")).alias("AVGDELAY"),
        avg_cents_rounded(F.col("_vsum"), F.col("_vcnt")).alias("AVGVELOCITY"),
    )


def trip_sanity_filter(df: DataFrame, dur=DURATION_BOUNDS, vel=SPEED_BOUNDS) -> DataFrame:
    """Strict bounds on rounded minutes and on the trip's mean speed."""
    return df.filter((F.col("TRIPDURATION") > dur[0]) & (F.col("TRIPDURATION") < dur[1])
                     & (F.col("AVGVELOCITY") > vel[0]) & (F.col("AVGVELOCITY") < vel[1]))


def trip_candidates(core: DataFrame, keys=TRIP_KEYS, dur=DURATION_BOUNDS, vel=SPEED_BOUNDS) -> DataFrame:
    """gold_trips_candidates: paired, multi-ping, sane trips (11 columns)."""
    pairs = drop_single_ping_trips(pair_trip_endpoints(core, keys))
    pairs = pairs.withColumn("TRIPDURATION", trip_duration_minutes("STARTTIME", "ENDTIME"))
    return trip_sanity_filter(pairs, dur, vel).select(*CANDIDATE_COLUMNS)


def attach_route_meta(candidates: DataFrame, meta: DataFrame) -> DataFrame:
    """Join FIRSTPARADA / LASTPARADA on (LINE, ORIENTATION).

    The terminal-stop rule rejects rows without route metadata, so the join is
    inner. ``meta`` is one row per route direction; hint it with
    :func:`bounded_broadcast`.
    """
    m = meta.select("LINE", "ORIENTATION", "FIRSTPARADA", "LASTPARADA")
    return candidates.join(m, ["LINE", "ORIENTATION"], "inner")


def terminal_stop_filter(df: DataFrame, slack: int = TERMINAL_SLACK) -> DataFrame:
    """Start within ``slack`` stops of the first stop, end within ``slack`` of the last."""
    first, last = F.col("FIRSTPARADA"), F.col("LASTPARADA")
    return df.filter(F.col("STARTSTOP").isin(*[first + i for i in range(slack + 1)])
                     & F.col("ENDSTOP").isin(*[last - i for i in range(slack + 1)]))


def project_trips(df: DataFrame) -> DataFrame:
    """Final features and the 8 published columns."""
    return df.select(
        "LINE", F.col("date").alias("DATE"),
        time_of_day_bucket("STARTTIME").alias("TIMEOFDAY"),
        rush_hour_flag("STARTTIME").alias("RUSHHOUR"),
        F.col("ORIENTATION").cast("int").alias("ORIENTATION"),
        F.col("TRIPDURATION").cast("int").alias("TRIPDURATION"),
        F.col("AVGDELAY").cast("int").alias("AVGDELAY"),
        F.col("AVGVELOCITY").alias("AVGVELOCITY"))


def trips_final(candidates: DataFrame, meta: DataFrame, slack: int = TERMINAL_SLACK) -> DataFrame:
    """gold_trips_final (``valid_trip_duration`` is implied by the sanity rule)."""
    t = terminal_stop_filter(attach_route_meta(candidates, meta), slack)
    t = t.filter(F.col("TRIPDURATION").isNotNull() & (F.col("TRIPDURATION") > 0))
    return project_trips(t)
