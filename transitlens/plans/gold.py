"""The medallion pipeline composed from the operators (one plan per output)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from transitlens.config import DEFAULT_BROADCAST_ROWS, DEFAULT_SLICE_SECONDS, TRIP_KEYS
from transitlens.operators.dimension import bounded_broadcast, materialize
from transitlens.operators.enrich import (DEFAULT_HOT_SLICE_ROWS, GPSY_POSITIVE, enrich_core,
                                          match_pings_to_stops, public_columns, running_avg_velocity)
from transitlens.operators.quality import expect_or_drop
from transitlens.operators.segments import route_segment_speed
from transitlens.operators.stops import route_first_last_stop
from transitlens.operators.trips import trip_candidates, trips_final
from transitlens.plans import fixtures
from transitlens.sources.bucketed import stored_core


@dataclass
class Silver:
    stops: DataFrame      # silver_stops_routes (materialised, size-checked)
    meta: DataFrame       # silver_routes_meta (hinted for broadcast when small)
    core: DataFrame       # enrichment before the drop rule, with helper columns


def build_silver(pings: DataFrame, stops: DataFrame, keys=TRIP_KEYS,
                 slice_seconds: int = DEFAULT_SLICE_SECONDS,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS, two_sided: bool = True,
                 hot_rows: int | None = DEFAULT_HOT_SLICE_ROWS) -> Silver:
    stops_b, n = bounded_broadcast(stops, broadcast_rows)
    meta = route_first_last_stop(stops_b)
    # meta has at most as many rows as stops: the same bound applies
    meta_b = meta.hint("broadcast") if n <= broadcast_rows else meta
    joined = match_pings_to_stops(pings, stops_b)
    core = enrich_core(joined, keys=keys, slice_seconds=slice_seconds, two_sided=two_sided, hot_rows=hot_rows)
    return Silver(stops_b, meta_b, core)


def silver_from_sf(spark: SparkSession, sf_dir: str, n_buses: int = 10, **kw) -> Silver:
    pings = fixtures.events_to_pings(fixtures.table(spark, sf_dir, "events"), n_buses)
    return build_silver(pings, fixtures.fixture_stops(pings), **kw)


def gold_trips_candidates(s: Silver) -> DataFrame:
    return trip_candidates(s.core)


def gold_trips_final(s: Silver) -> DataFrame:
    return trips_final(trip_candidates(s.core), s.meta)


def gold_route_segment_speed(s: Silver) -> DataFrame:
    return route_segment_speed(s.core)


def silver_gps_enriched(s: Silver, running_velocity: bool = True) -> DataFrame:
    """The enriched table after the drop rule.

    The running AVGVELOCITY column needs per-slice sums of a value that is
    itself windowed. The core is written once, bucketed on its window keys, so
    the pings cross the network once and only per-slice sums move after that.
    Trips and segments do not need the column: ``running_velocity=False``
    writes nothing.
    """
    df = running_avg_velocity(stored_core(s.core)) if running_velocity else s.core
    return public_columns(expect_or_drop(df, "gpsy_positive", GPSY_POSITIVE))


def expectation_report(bronze: DataFrame, s: Silver, flat: DataFrame) -> DataFrame:
    """Pass / fail counts of every expectation, each on the table it guards."""
    from transitlens.operators.quality import (BRONZE_RULES, FLAT_INPUT_RULES, FLAT_RULES, TRIPS_DROP,
                                               TRIPS_RULES, expect_warn)
    from transitlens.operators.trips import attach_route_meta, project_trips, terminal_stop_filter
    core = stored_core(s.core)  # evaluated once for all rules
    pre_final = materialize(terminal_stop_filter(attach_route_meta(trip_candidates(core), s.meta)))
    final = project_trips(expect_or_drop(pre_final, *TRIPS_DROP))
    parts = [expect_warn(bronze, {**BRONZE_RULES, **FLAT_INPUT_RULES}),
             expect_warn(flat, FLAT_RULES),
             expect_warn(core, {"gpsy_positive": GPSY_POSITIVE}),
             expect_warn(pre_final, {TRIPS_DROP[0]: TRIPS_DROP[1]}),
             expect_warn(final, TRIPS_RULES)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
