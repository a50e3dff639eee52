"""Daily refresh: landed captures + a stops file -> every published table.

Each layer is written as Parquet and the next layer reads it back by name, so
the enrichment core is computed once and no later failure recomputes the chain
from the raw captures. The core is stored in the session's scratch folder,
bucketed on its window keys, so the layers that read it join per-slice summaries
to it without another shuffle of the pings; the published core is by date.
Expectation metrics are gathered with ``DataFrame.observe`` on the
writes themselves (no extra pass).

A run writes its layers into folders of its own and publishes them together as
the next version (``sources.publish``). Layers with dates are partitioned by
date: a run for some ``capture_dates`` replaces these dates in every layer and
takes over all others; a run without dates replaces the layers whole. Running a
date again changes nothing but that date. Whenever a run dies, the versions
published before it stay readable; a run that fails deletes its files.
Published layers are read with ``read_layer``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transitlens.config import DEFAULT_BROADCAST_ROWS, DEFAULT_SLICE_SECONDS, scratch_path
from transitlens.operators.dimension import bounded_broadcast
from transitlens.operators.enrich import (GPSY_POSITIVE, enrich_core, match_pings_to_stops,
                                          public_columns, running_avg_velocity)
from transitlens.operators.payload import flatten_pings, stamp_ingest_time
from transitlens.operators.quality import (BRONZE_RULES, FLAT_INPUT_RULES, FLAT_RULES, TRIPS_DROP, TRIPS_RULES,
                                           expect_or_drop, observe_warn)
from transitlens.operators.quarantine import parse_with_quarantine, quarantine_table
from transitlens.operators.segments import adjacent_segment_filter, next_stop_number, route_segment_speed
from transitlens.operators.sketches import distinct_sketches, segment_summaries
from transitlens.operators.stops import explode_stops, route_first_last_stop, stop_row_number
from transitlens.operators.trips import (attach_route_meta, project_trips, terminal_stop_filter,
                                         trip_candidates)
from transitlens.sources.bucketed import write_bucketed
from transitlens.sources.publish import Run, delete, publishing
from transitlens.sources.snapshots import PARTITION_COL, read_gps_snapshots
from transitlens.sources.stops_json import read_stops_json

LAYERS = ("bronze_gps_raw", "silver_gps_flat", "silver_paradas_exploded", "silver_stops_routes",
          "silver_routes_meta", "silver_gps_enriched_core", "silver_gps_enriched", "gold_trips_candidates",
          "gold_trips_final", "gold_route_segment_speed", "summary_segment_speed", "summary_distinct",
          "quarantine")
#: columns of the pings whose distinct values are summarised by date
DISTINCT_COLUMNS = ("BUSNUMBER", "RUTA", "STOPID", "TRIPID")


# The date column that partitions a layer; layers not named here are published whole.
DATED = {"bronze_gps_raw": PARTITION_COL, "silver_gps_flat": "date", "silver_gps_enriched_core": "date",
         "silver_gps_enriched": "date", "gold_trips_candidates": "date", "gold_trips_final": "DATE",
         "gold_route_segment_speed": "date", "summary_segment_speed": "date", "summary_distinct": "date",
         "quarantine": PARTITION_COL}


def refresh(spark: SparkSession, captures_path: str, stops_path: str, out_root: str,
            capture_dates: list | None = None, stops_multiline: bool = True,
            applied: dict[str, int] | None = None, slice_seconds: int = DEFAULT_SLICE_SECONDS,
            broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> dict:
    """Run every layer; return ``{"root", "version", "tables": names, "expectations": {rule: counts}}``.

    ``None`` among ``capture_dates`` stands for the captures without a time,
    whose pings have no date. ``applied`` is recorded with the version (how far
    incremental sources have been worked in).
    """
    obs: dict[str, Observation] = {}
    core_table, core_path = f"transitlens_core_{uuid.uuid4().hex[:12]}", scratch_path(spark, "core")

    def work(run: Run):
        def write(name: str, df: DataFrame, last: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
            return run.write(name, df, DATED.get(name), last)

        raw = read_gps_snapshots(spark, captures_path)
        if capture_dates is not None:
            raw = raw.filter(F.col(PARTITION_COL).isin([F.lit(d).cast("date") for d in capture_dates if d is not None])
                             | (F.col(PARTITION_COL).isNull() & F.lit(None in capture_dates)))
        obs["bronze"] = Observation("bronze")
        bronze = write("bronze_gps_raw", stamp_ingest_time(parse_with_quarantine(raw)),
                       lambda df: observe_warn(df, {**BRONZE_RULES, **FLAT_INPUT_RULES}, obs["bronze"], "bronze"))
        write("quarantine", quarantine_table(bronze, "ruta", "timestamp", "gps_data", PARTITION_COL))
        obs["flat"] = Observation("flat")
        flat = write("silver_gps_flat", flatten_pings(bronze), lambda df: observe_warn(df, FLAT_RULES, obs["flat"], "flat"))

        stops_raw = write("silver_paradas_exploded", explode_stops(read_stops_json(spark, stops_path, stops_multiline)))
        stops = write("silver_stops_routes", stop_row_number(stops_raw))
        if stops.limit(1).count() == 0:
            raise ValueError(f"no stops in {stops_path}: no ping could be matched")
        meta = write("silver_routes_meta", route_first_last_stop(stops))

        stops_b, n_stops = bounded_broadcast(stops, broadcast_rows, already_materialized=True)
        core = write_bucketed(spark, core_path, core_table,
                              lambda: enrich_core(match_pings_to_stops(flat, stops_b), slice_seconds=slice_seconds))
        write("silver_gps_enriched_core", core)

        obs["enriched"] = Observation("enriched")
        write("silver_gps_enriched", public_columns(running_avg_velocity(core)),
              lambda df: expect_or_drop(df, "gpsy_positive", GPSY_POSITIVE, obs["enriched"]))

        cands = write("gold_trips_candidates", trip_candidates(core))
        meta_b = meta.hint("broadcast") if n_stops <= broadcast_rows else meta  # at most one row per stop
        obs["trips_drop"], obs["trips"] = Observation("trips_drop"), Observation("trips")

        def published_trips(df: DataFrame) -> DataFrame:
            final = expect_or_drop(df, TRIPS_DROP[0], TRIPS_DROP[1], obs["trips_drop"])
            return observe_warn(project_trips(final), TRIPS_RULES, obs["trips"], "trips")

        write("gold_trips_final", terminal_stop_filter(attach_route_meta(cands, meta_b)), published_trips)
        write("gold_route_segment_speed", route_segment_speed(core))
        # merged over any range of dates without reading pings again
        write("summary_segment_speed", segment_summaries(adjacent_segment_filter(next_stop_number(core))))
        write("summary_distinct", distinct_sketches(flat, list(DISTINCT_COLUMNS), "date"))
        metrics: dict = {}
        for o in obs.values():
            metrics.update(o.get)
        return {"dates": capture_dates, "applied": applied, "metrics": metrics}

    try:
        published = publishing(spark, out_root, work)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {core_table}")  # external: its files are deleted apart
        delete(spark, core_path)
    return {"root": out_root, "version": published.version, "tables": list(LAYERS), "expectations": published.metrics}
