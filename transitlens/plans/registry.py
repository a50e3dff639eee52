"""Registered queries: one Spark plan per operator, each with reference SQL.

Every query reads the shared test tables (or data Spark derives from them),
so its work grows with the tables. ``SPARK[name](spark, sf_dir)`` returns a
DataFrame; ``SQL[name]`` is the same result in DuckDB SQL over the tables
registered as views (omitted only where the result is not deterministic).

Adding a query: decorate a ``(spark, sf_dir) -> DataFrame`` function with
``@register(name, sql)``. Alias every computed column identically in both,
keep column types aligned (``tools/check_types.py``), and check with
``EXACT=1 python tools/check_queries.py name`` at sf0.01 and sf0.1.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.config import scratch_path
from transitlens.functions.numeric import cast_delay, round_sig, scale_coordinates
from transitlens.functions.timefn import (epoch_to_local_time, local_date, rush_hour_flag,
                                          time_of_day_bucket)
from transitlens.operators import crawl, heavy, ordering, profile, quality, quarantine, sketches
from transitlens.operators.dimension import bounded_broadcast, materialize
from transitlens.operators.enrich import (ENRICHED_COLUMNS, GPSY_POSITIVE, enrich_core, match_pings_to_stops,
                                          public_columns, running_avg_velocity)
from transitlens.operators.payload import flatten_pings, parse_gps_payload, stamp_ingest_time
from transitlens.operators.segments import adjacent_segment_filter, next_stop_number, route_segment_speed
from transitlens.operators.stops import explode_stops, route_first_last_stop, stop_row_number
from transitlens.operators.trips import (CANDIDATE_COLUMNS, attach_route_meta, drop_single_ping_trips,
                                         pair_trip_endpoints, terminal_stop_filter, trip_boundaries,
                                         trip_candidates, trip_sanity_filter, trips_final)
from transitlens.functions.timefn import trip_duration_minutes
from transitlens.plans import fixtures, gold
from transitlens.plans import oracle_sql as O
from transitlens.plans.refresh import refresh
from transitlens.sources.bucketed import stored_core
from transitlens.sources.layers import materialize_layers
from transitlens.sources.publish import history, read_layer
from transitlens.sources.snapshots import PARTITION_COL, read_gps_snapshots, with_capture_date, write_snapshots
from transitlens.sources.stops_json import read_stops_json, write_stops_json
from transitlens.sources.trips_csv import export_trips_csv, read_trips_csv
from transitlens.streaming.incremental import incremental_flatten, incremental_refresh
from transitlens.streaming.trips import read_trip_pairs, stream_trip_pairs

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

N_BUSES = 10
KEYS = ["BUSNUMBER", "RUTA", "TRIPID", "date", "ORIENTATION"]
PING_ID = KEYS + ["timestamp", "ping_seq"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = O.bigint_counts(sql)
        return fn
    return deco


def _stable(df: DataFrame, *cols: str) -> DataFrame:
    """Means, deviations and ratios to nine digits: their last bits follow the order of summation.

    Only for the comparison with the reference SQL, and never for observed values.
    """
    return df.select(*[round_sig(c).alias(c) if c in cols else c for c in df.columns])


def _t(spark, sf, name):
    return fixtures.table(spark, sf, name)


def _silver(spark, sf) -> gold.Silver:
    return gold.silver_from_sf(spark, sf, N_BUSES)


def _trips(spark, sf) -> DataFrame:
    return gold.gold_trips_final(_silver(spark, sf))


def _trips_table(spark, sf) -> DataFrame:
    """The published trips table, checkpointed: profiling reads it in several passes."""
    from transitlens.operators.dimension import materialize
    return materialize(_trips(spark, sf))


def _pings(spark, sf) -> DataFrame:
    return fixtures.events_to_pings(_t(spark, sf, "events"), N_BUSES)


def _joined(spark, sf) -> DataFrame:
    """Pings matched to the (size-checked, broadcast) fixture stops."""
    pings = _pings(spark, sf)
    return match_pings_to_stops(pings, bounded_broadcast(fixtures.fixture_stops(pings))[0])


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _p(body: str, segments: bool = False) -> str:
    return O.medallion(body, N_BUSES, segments)


_ID = ", ".join(PING_ID)

# ---------------------------------------------------------------------------
# 2.5 / 2.6 / 2.7 : the pipeline (flagship first)
# ---------------------------------------------------------------------------


@register("gold_trips_final", _p("SELECT * FROM trips"))
def q_trips(spark, sf):
    return _trips(spark, sf)


@register("gold_trips_candidates", _p("SELECT * FROM candidates"))
def q_candidates(spark, sf):
    return gold.gold_trips_candidates(_silver(spark, sf))


@register("segment_speed", _p("SELECT * FROM segments", segments=True))
def q_segments(spark, sf):
    return gold.gold_route_segment_speed(_silver(spark, sf))


@register("silver_gps_enriched", _p(f"SELECT {', '.join(ENRICHED_COLUMNS)} FROM enriched"))
def q_enriched(spark, sf):
    return gold.silver_gps_enriched(_silver(spark, sf)).select(*ENRICHED_COLUMNS)


@register("match_pings_to_stops", _p("SELECT * FROM joined"))
def q_match(spark, sf):
    from transitlens.operators.enrich import match_pings_to_stops
    from transitlens.operators.dimension import bounded_broadcast
    pings = _pings(spark, sf)
    stops, _ = bounded_broadcast(fixtures.fixture_stops(pings))
    return match_pings_to_stops(pings, stops)


@register("stop_row_number", _p("SELECT STOPID, LINE, ORIENTATION, ROWNUM, row_number FROM stops"))
def q_stop_rn(spark, sf):
    return fixtures.fixture_stops(_pings(spark, sf))


@register("route_first_last_stop",
          _p("SELECT LINE, ORIENTATION, count(*) AS n_stops, min(row_number) AS FIRSTPARADA, "
             "max(row_number) AS LASTPARADA FROM stops GROUP BY LINE, ORIENTATION"))
def q_route_meta(spark, sf):
    m = route_first_last_stop(fixtures.fixture_stops(_pings(spark, sf)))
    return m.select("LINE", "ORIENTATION", F.size("paradas").cast("long").alias("n_stops"),
                    "FIRSTPARADA", "LASTPARADA")


@register("ping_neighbors", _p(f"SELECT {_ID}, prev_rownum, prev_time, next_time, LASTLATITUDE, "
                               "LASTLONGITUDE FROM w1"))
def q_neighbors(spark, sf):
    from transitlens.operators.enrich import ping_neighbors
    return ping_neighbors(_joined(spark, sf)).select(*PING_ID, "prev_rownum", "prev_time", "next_time",
                                                     "LASTLATITUDE", "LASTLONGITUDE")


@register("running_avg_delay", _p(f"SELECT {_ID}, AVGDELAY FROM w1"))
def q_run_delay(spark, sf):
    from transitlens.operators.enrich import running_avg_delay
    return running_avg_delay(_joined(spark, sf)).select(*PING_ID, "AVGDELAY")


@register("running_avg_velocity", _p(f"SELECT {_ID}, VELOCITY, AVGVELOCITY FROM w4"))
def q_run_velocity(spark, sf):
    return running_avg_velocity(stored_core(_silver(spark, sf).core)).select(*PING_ID, "VELOCITY", "AVGVELOCITY")


@register("haversine_distance", _p(f"SELECT {_ID}, haversine_dist FROM w2"))
def q_haversine(spark, sf):
    return _silver(spark, sf).core.select(*PING_ID, "haversine_dist")


@register("ping_velocity", _p(f"SELECT {_ID}, time_s, VELOCITY FROM w4"))
def q_velocity(spark, sf):
    return _silver(spark, sf).core.select(*PING_ID, "time_s", "VELOCITY")


@register("trip_boundary_filter",
          _p(f"SELECT {_ID}, row_number, 'start' AS boundary FROM enriched WHERE prev_time IS NULL "
             f"UNION ALL SELECT {_ID}, row_number, 'end' FROM enriched WHERE next_time IS NULL"))
def q_boundary(spark, sf):
    e = gold.silver_gps_enriched(_silver(spark, sf), running_velocity=False)
    return trip_boundaries(e).select(*PING_ID, "row_number", "boundary")


_PAIR_COLS = ("BUSNUMBER, LINE, TRIPID, date, ORIENTATION, STARTTIME, ENDTIME, STARTSTOP, ENDSTOP, "
              "AVGDELAY, AVGVELOCITY")
_PAIRS_ALL = f"SELECT {_PAIR_COLS}, START_next_time, END_prev_time FROM paired"


@register("pair_trip_endpoints", _p(_PAIRS_ALL))
def q_pairs(spark, sf):
    return pair_trip_endpoints(_silver(spark, sf).core)


@register("streaming_trip_pairs", O.medallion(f"""SELECT p.BUSNUMBER, p.LINE, p.TRIPID, p.date, p.ORIENTATION, p.STARTTIME,
    p.ENDTIME, p.STARTSTOP, p.ENDSTOP, c.N_PINGS, p.AVGDELAY FROM ({_PAIRS_ALL}) p
    JOIN (SELECT BUSNUMBER, RUTA, TRIPID, date, ORIENTATION, count(*) AS N_PINGS FROM joined GROUP BY ALL) c
      ON p.BUSNUMBER = c.BUSNUMBER AND p.LINE = c.RUTA AND p.TRIPID = c.TRIPID AND p.date = c.date
     AND p.ORIENTATION = c.ORIENTATION""", N_BUSES, from_captures=True))
def q_stream_pairs(spark, sf):
    """Captures land in three deliveries, each worked in by a run of its own, and a last poll without buses ends the last day."""
    snaps = with_capture_date(_snapshots(spark, sf))
    pings = flatten_pings(parse_gps_payload(_snapshots(spark, sf)))
    stops, _ = bounded_broadcast(fixtures.fixture_stops(pings))
    caps, sink, ckpt = (scratch_path(spark, n) for n in ("pair-captures", "pair-sink", "pair-ckpt"))
    ends = snaps.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    third = (ends.b - ends.a) / 3
    place = F.least(F.floor((F.col("timestamp") - ends.a) / F.lit(max(third, 1.0))), F.lit(2))
    empty = snaps.agg(F.lit("-").alias("ruta"), F.lit("[]").alias("gps_data"), (F.max("timestamp") + 3 * 86400).alias("timestamp"),
                      F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))
    for delivery in [snaps.filter(place == k) for k in range(3)] + [empty]:
        write_snapshots(delivery, caps)
        stream_trip_pairs(spark, caps, stops, sink, ckpt).awaitTermination()
    return read_trip_pairs(spark, sink)


@register("drop_single_ping_trips",
          _p(f"SELECT {_PAIR_COLS} FROM ({_PAIRS_ALL}) WHERE END_prev_time IS NOT NULL "
             "AND START_next_time IS NOT NULL"))
def q_drop_single(spark, sf):
    p = drop_single_ping_trips(pair_trip_endpoints(_silver(spark, sf).core))
    return p.select(*[c.strip() for c in _PAIR_COLS.split(",")])


@register("trip_duration_minutes", _p("SELECT BUSNUMBER, LINE, TRIPID, date, ORIENTATION, TRIPDURATION FROM pairs"))
def q_duration(spark, sf):
    p = drop_single_ping_trips(pair_trip_endpoints(_silver(spark, sf).core))
    return p.select("BUSNUMBER", "LINE", "TRIPID", "date", "ORIENTATION",
                    trip_duration_minutes("STARTTIME", "ENDTIME").alias("TRIPDURATION"))


@register("trip_sanity_filter", _p("SELECT * FROM candidates"))
def q_sanity(spark, sf):
    p = drop_single_ping_trips(pair_trip_endpoints(_silver(spark, sf).core))
    p = p.withColumn("TRIPDURATION", trip_duration_minutes("STARTTIME", "ENDTIME"))
    return trip_sanity_filter(p).select(*CANDIDATE_COLUMNS)


@register("attach_route_meta",
          _p("SELECT c.*, m.FIRSTPARADA, m.LASTPARADA FROM candidates c JOIN meta m "
             "ON c.LINE = m.LINE AND c.ORIENTATION = m.ORIENTATION"))
def q_attach(spark, sf):
    s = _silver(spark, sf)
    return attach_route_meta(trip_candidates(s.core), s.meta)


@register("terminal_stop_filter", _p("SELECT * FROM final_raw"))
def q_terminal(spark, sf):
    s = _silver(spark, sf)
    t = terminal_stop_filter(attach_route_meta(trip_candidates(s.core), s.meta))
    return t.filter(F.col("TRIPDURATION").isNotNull() & (F.col("TRIPDURATION") > 0))


@register("project_trips", _p("SELECT * FROM trips"))
def q_project(spark, sf):
    return _trips(spark, sf)


@register("next_stop_number",
          _p(f"SELECT {_ID}, row_number AS segment_start, next_row AS segment_end FROM seg_rows", segments=True))
def q_next_stop(spark, sf):
    return next_stop_number(_silver(spark, sf).core).select(*PING_ID, "segment_start", "segment_end")


@register("adjacent_segment_filter",
          _p(f"SELECT {_ID}, segment_start, segment_end, VELOCITY, haversine_dist FROM seg", segments=True))
def q_adjacent(spark, sf):
    s = adjacent_segment_filter(next_stop_number(_silver(spark, sf).core))
    return s.select(*PING_ID, "segment_start", "segment_end", "VELOCITY", "haversine_dist")


# ---------------------------------------------------------------------------
# 2.4 expectations
# ---------------------------------------------------------------------------


@register("expect_or_drop", O.with_ctes(O.pings_cte(N_BUSES),
                                        body="SELECT * FROM pings WHERE GPSY IS NOT NULL AND GPSY > 1"))
def q_expect_drop(spark, sf):
    return quality.expect_or_drop(_pings(spark, sf), "gpsy_positive", GPSY_POSITIVE)


@register("expect_warn", O.with_ctes(O.pings_cte(N_BUSES), body=(
    "SELECT 'gps_has_timestamp' AS expectation, count_if(timestamp IS NOT NULL) AS passed, "
    "count_if(timestamp IS NULL) AS failed FROM pings UNION ALL "
    "SELECT 'gpsy_positive', count_if(coalesce(GPSY IS NOT NULL AND GPSY > 1, false)), "
    "count_if(NOT coalesce(GPSY IS NOT NULL AND GPSY > 1, false)) FROM pings")))
def q_expect_warn(spark, sf):
    rules = dict(quality.FLAT_RULES)
    rules["gpsy_positive"] = GPSY_POSITIVE
    return quality.expect_warn(_pings(spark, sf), rules)


# ---------------------------------------------------------------------------
# 2.1 / 2.3 ingest: captures built from events, parsed and flattened back
# ---------------------------------------------------------------------------

_FLAT_SQL = O.with_ctes(O.pings_cte(N_BUSES), body="""SELECT BUSNUMBER, DELAY, PARADA, RUTA, RUTERO, STOPID,
  CAST(ping_seq AS VARCHAR) AS TASKID, TELEGRAMDATE, TRIPID,
  CAST(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(timestamp) / 60000000.0) AS BIGINT) * 60)
       - INTERVAL 5 HOUR AS TIMESTAMP) AS timestamp,
  CAST(CAST(floor(GPSX * 1e7 + 0.5) AS BIGINT) AS DOUBLE) / 1e7 AS GPSX,
  CAST(CAST(floor(GPSY * 1e7 + 0.5) AS BIGINT) AS DOUBLE) / 1e7 AS GPSY,
  row_number() OVER (PARTITION BY RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096)
                     ORDER BY ping_seq) - 1 AS ping_seq,
  CAST(CAST(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(timestamp) / 60000000.0) AS BIGINT) * 60)
       - INTERVAL 5 HOUR AS TIMESTAMP) AS DATE) AS date
FROM pings""")


def _snapshots(spark, sf) -> DataFrame:
    return fixtures.events_to_snapshots(_t(spark, sf, "events"), N_BUSES)


def _capture_silver(spark, sf) -> gold.Silver:
    pings = flatten_pings(parse_gps_payload(_snapshots(spark, sf)))
    return gold.build_silver(pings, fixtures.fixture_stops(pings))


@register("gold_trips_from_captures", O.medallion("SELECT * FROM trips", N_BUSES, from_captures=True))
def q_capture_trips(spark, sf):
    """The whole medallion from raw captures: parse, flatten, enrich, pair, publish."""
    return gold.gold_trips_final(_capture_silver(spark, sf))


@register("segment_speed_from_captures", O.medallion("SELECT * FROM segments", N_BUSES, segments=True,
                                                    from_captures=True))
def q_capture_segments(spark, sf):
    return gold.gold_route_segment_speed(_capture_silver(spark, sf))


@register("silver_enriched_from_captures", O.medallion(f"SELECT {', '.join(ENRICHED_COLUMNS)} FROM enriched",
                                                      N_BUSES, from_captures=True))
def q_capture_enriched(spark, sf):
    return gold.silver_gps_enriched(_capture_silver(spark, sf)).select(*ENRICHED_COLUMNS)


_EXPECT_SQL = O.medallion("""SELECT 'bronze_has_gps_data_parsed' AS expectation,
    (SELECT count(DISTINCT (RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096))) FROM raw_pings)
      AS passed, 0 AS failed
  UNION ALL SELECT 'valid_gps_array',
    (SELECT count(DISTINCT (RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096))) FROM raw_pings), 0
  UNION ALL SELECT 'gps_has_timestamp', count_if(timestamp IS NOT NULL), count_if(timestamp IS NULL) FROM pings
  UNION ALL SELECT 'gpsy_positive', count_if(coalesce(GPSY IS NOT NULL AND GPSY > 1, false)),
    count_if(NOT coalesce(GPSY IS NOT NULL AND GPSY > 1, false)) FROM joined
  UNION ALL SELECT 'valid_trip_duration', count(*), 0 FROM final_raw
  UNION ALL SELECT 'avgvelocity_reasonable',
    count_if(coalesce(AVGVELOCITY IS NULL OR (AVGVELOCITY > 0.01 AND AVGVELOCITY < 100), false)),
    count_if(NOT coalesce(AVGVELOCITY IS NULL OR (AVGVELOCITY > 0.01 AND AVGVELOCITY < 100), false)) FROM trips""",
                         N_BUSES, from_captures=True)


@register("expectation_report", _EXPECT_SQL)
def q_expectations(spark, sf):
    bronze = parse_gps_payload(_snapshots(spark, sf))
    flat = flatten_pings(bronze)
    s = gold.build_silver(flat, fixtures.fixture_stops(flat))
    return gold.expectation_report(bronze, s, flat)


@register("flatten_pings", _FLAT_SQL)
def q_flatten(spark, sf):
    return flatten_pings(parse_gps_payload(_snapshots(spark, sf)))


@register("parse_gps_payload", O.with_ctes(O.pings_cte(N_BUSES), body=(
    "SELECT RUTA AS ruta, floor(epoch_us(timestamp) / 60000000.0) * 60 AS capture_time, count(*) AS n_pings "
    "FROM pings GROUP BY RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096)")))
def q_parse(spark, sf):
    p = parse_gps_payload(_snapshots(spark, sf))
    return p.select("ruta", F.col("timestamp").alias("capture_time"),
                    F.size("gps_data_parsed").cast("long").alias("n_pings"))


@register("stamp_ingest_time", O.with_ctes(O.pings_cte(N_BUSES), body=(
    "SELECT RUTA AS ruta, CAST(floor(epoch_us(timestamp) / 60000000.0) * 60 AS DOUBLE) AS timestamp, true AS stamped "
    "FROM pings GROUP BY 1, 2, floor(ping_seq / 4096)")))
def q_ingest(spark, sf):
    """The time itself is that of the run; that every capture has one is compared."""
    stamped = stamp_ingest_time(parse_gps_payload(_snapshots(spark, sf)))
    return stamped.select("ruta", "timestamp", F.col("ingest_time").isNotNull().alias("stamped"))


_SHAPES = {1: "no_payload", 2: "empty_text", 3: "null_text", 4: "malformed_json", 8: "not_pings"}


@register("quarantine_captures", O.with_ctes(O.pings_cte(N_BUSES), "captures AS (SELECT "
          "CAST(floor(epoch_us(timestamp) / 60000000.0) AS BIGINT) % 9 AS shape, count(*) AS n FROM pings "
          "GROUP BY RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096))", body=(
    "SELECT * FROM (SELECT 'capture' AS unit, CASE shape "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _SHAPES.items()) + " END AS reason, count(*) AS n FROM captures GROUP BY 1, 2 "
    "UNION ALL SELECT 'element', NULL, CAST(sum(CASE shape WHEN 6 THEN 1 ELSE n END) AS BIGINT) FROM captures "
    f"WHERE shape NOT IN ({', '.join(map(str, _SHAPES))}) "
    "UNION ALL SELECT 'element', 'empty_element', 2 * count(*) FROM captures WHERE shape = 7) WHERE n > 0")))
def q_quarantine(spark, sf):
    """Rows in by what became of them: captures and elements parsed (no reason) or set aside with a reason."""
    return quarantine.quarantine_report(quarantine.parse_with_quarantine(fixtures.with_broken_payloads(_snapshots(spark, sf))))


def q_landing(spark, sf):
    path = scratch_path(spark, "landing")
    for _ in range(2):  # the repeated batch is skipped
        write_snapshots(_snapshots(spark, sf), path, batch_id="delivery-1")
    return flatten_pings(parse_gps_payload(read_gps_snapshots(spark, path).drop("capture_date")))


@register("incremental_flatten", _FLAT_SQL)
def q_incremental(spark, sf):
    src = scratch_path(spark, "capture-src")
    write_snapshots(_snapshots(spark, sf), src)
    sink, ckpt = scratch_path(spark, "flat-sink"), scratch_path(spark, "flat-ckpt")
    q = incremental_flatten(spark, src, sink, ckpt)
    q.awaitTermination()
    return spark.read.parquet(sink).select(
        "BUSNUMBER", "DELAY", "PARADA", "RUTA", "RUTERO", "STOPID", "TASKID", "TELEGRAMDATE", "TRIPID",
        "timestamp", "GPSX", "GPSY", "ping_seq", "date")


@register("epoch_to_local_time", "SELECT event_id, CAST(TIMESTAMP '1970-01-01 00:00:00' + "
          "to_seconds(CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT)) - INTERVAL 5 HOUR AS TIMESTAMP) AS local_time, "
          "CAST(CAST(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT)) "
          "- INTERVAL 5 HOUR AS TIMESTAMP) AS DATE) AS local_date FROM events")
def q_epoch(spark, sf):
    e = _t(spark, sf, "events")
    lt = epoch_to_local_time(F.unix_timestamp("ts"))
    return e.select("event_id", lt.alias("local_time")).withColumn("local_date", local_date("local_time"))


@register("scale_coordinates", "SELECT event_id, CAST(CAST(floor(value * 1e7 + 0.5) AS BIGINT) AS DOUBLE) / 1e7 "
          "AS GPSY FROM events")
def q_scale(spark, sf):
    e = _t(spark, sf, "events")
    raw = F.floor(F.col("value") * F.lit(1e7) + F.lit(0.5)).cast("long").cast("string")
    return e.select("event_id", scale_coordinates(raw).alias("GPSY"))


@register("cast_delay", "SELECT event_id, TRY_CAST(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || "
          "CASE WHEN event_type = 'error' THEN 'x' ELSE '' END AS INTEGER) AS DELAY FROM events")
def q_cast_delay(spark, sf):
    e = _t(spark, sf, "events")
    raw = F.concat(F.floor("value").cast("string"), F.when(F.col("event_type") == "error", "x").otherwise(""))
    return e.select("event_id", cast_delay(raw).alias("DELAY"))


@register("time_of_day_bucket", "SELECT event_id, CASE WHEN hour(ts) BETWEEN 4 AND 11 THEN 'morning' "
          "WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon' WHEN hour(ts) BETWEEN 18 AND 23 THEN 'evening' "
          "ELSE 'night' END AS TIMEOFDAY FROM events")
def q_tod(spark, sf):
    return _t(spark, sf, "events").select("event_id", time_of_day_bucket("ts").alias("TIMEOFDAY"))


@register("rush_hour_flag", "SELECT event_id, coalesce(hour(ts) BETWEEN 6 AND 9 OR hour(ts) BETWEEN 16 AND 19, "
          "false) AS RUSHHOUR FROM events")
def q_rush(spark, sf):
    return _t(spark, sf, "events").select("event_id", rush_hour_flag("ts").alias("RUSHHOUR"))


# stops feed: derived stop lists written as JSON, read back and exploded
@register("read_stops_json",
          _p("SELECT STOPID, LINE, ORIENTATION, ROWNUM, row_number FROM stops"))
def q_stops_json(spark, sf):
    raw = fixtures.stops_from_pings(_pings(spark, sf))
    path = scratch_path(spark, "stops-json")
    write_stops_json(fixtures.route_stop_lists(raw), path)
    return stop_row_number(explode_stops(read_stops_json(spark, path, multiline=False)))


@register("explode_stops", _p("SELECT LINE AS ruta, LINE, STOPID, CAST(ORIENTATION AS VARCHAR) AS ORIENTATION, "
                              "CAST(ROWNUM AS VARCHAR) AS ROWNUM FROM stops_raw"))
def q_explode_stops(spark, sf):
    routes = fixtures.route_stop_lists(fixtures.stops_from_pings(_pings(spark, sf)))
    return explode_stops(routes).select("ruta", "LINE", "STOPID", "ORIENTATION", "ROWNUM")


# published trips: CSV round trip and layered materialisation
def q_trips_csv(spark, sf):
    root = scratch_path(spark, "trips-csv")
    out = export_trips_csv(_trips(spark, sf), "2024-01", root)
    return read_trips_csv(spark, out)


_LAYER_COUNTS = {
    "bronze_gps_raw": f"(SELECT 1 FROM raw_pings GROUP BY {O.CAPTURE_KEY})", "silver_gps_flat": "pings",
    "silver_paradas_exploded": "stops_raw", "silver_stops_routes": "stops", "silver_routes_meta": "meta",
    "silver_gps_enriched_core": "w4", "silver_gps_enriched": "enriched", "gold_trips_candidates": "candidates",
    "gold_trips_final": "trips", "gold_route_segment_speed": "segments"}


@register("materialize_layers", O.medallion(
    _union([f"SELECT '{name}' AS layer, count(*) AS n FROM {table}" for name, table in _LAYER_COUNTS.items()]),
    N_BUSES, segments=True, from_captures=True))
def q_layers(spark, sf):
    """All ten tables, each reading its upstream by name; rows published per table."""
    events = _t(spark, sf, "events")
    routes = fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events, N_BUSES)))
    layers = [
        ("bronze_gps_raw", lambda read: stamp_ingest_time(parse_gps_payload(fixtures.events_to_snapshots(events, N_BUSES)))),
        ("silver_gps_flat", lambda read: flatten_pings(read("bronze_gps_raw"))),
        ("silver_paradas_exploded", lambda read: explode_stops(routes)),
        ("silver_stops_routes", lambda read: stop_row_number(read("silver_paradas_exploded"))),
        ("silver_routes_meta", lambda read: route_first_last_stop(read("silver_stops_routes"))),
        ("silver_gps_enriched_core", lambda read: enrich_core(match_pings_to_stops(
            read("silver_gps_flat"), bounded_broadcast(read("silver_stops_routes"), already_materialized=True)[0]))),
        ("silver_gps_enriched", lambda read: public_columns(quality.expect_or_drop(
            running_avg_velocity(read("silver_gps_enriched_core")), "gpsy_positive", GPSY_POSITIVE))),
        ("gold_trips_candidates", lambda read: trip_candidates(read("silver_gps_enriched_core"))),
        ("gold_trips_final", lambda read: trips_final(
            read("gold_trips_candidates"), bounded_broadcast(read("silver_routes_meta"), already_materialized=True)[0])),
        ("gold_route_segment_speed", lambda read: route_segment_speed(read("silver_gps_enriched_core"))),
    ]
    tables = materialize_layers(spark, layers, scratch_path(spark, "layers"))
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------------------
# 2.2 crawl output over `pages`
# ---------------------------------------------------------------------------

_NAV_SQL = r"""nav_rows AS (
  SELECT page_id, url,
         regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '(?s)<li[^>]*>(.*?)</li>', 1) AS r
  FROM pages),
nav_items AS (
  SELECT page_id, url, unnest(r) AS row_html, unnest(generate_series(1, len(r))) AS pos FROM nav_rows),
routes AS (
  SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
    replace(regexp_replace(
      replace(replace(replace(replace(replace(replace(
        regexp_replace(regexp_extract(row_html, '(?s)<a[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g'),
        '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
      '^[ \t\n\x0B\f\r\x{00a0}]+|[ \t\n\x0B\f\r\x{00a0}]+$', '', 'g'),
      chr(10) || repeat(chr(9), 6), '') AS route
  FROM nav_items)"""


def _routes(spark, sf) -> DataFrame:
    return crawl.extract_route_names(_t(spark, sf, "pages"), crawl.NAV_LIST)


@register("extract_route_names", O.with_ctes(_NAV_SQL, body="SELECT page_id, pos, route FROM routes WHERE length(route) > 0"))
def q_routes(spark, sf):
    return _routes(spark, sf)


_PAGE_STATS_SQL = _NAV_SQL + r""",
page_stats AS (
  SELECT p.page_id, regexp_extract(p.url, '^https?://[^/]+/([a-z]{2})/', 1) AS route_type,
         count(r.route) AS n_routes
  FROM pages p LEFT JOIN routes r ON p.page_id = r.page_id AND length(r.route) > 0
  GROUP BY p.page_id, p.url)"""


def _page_stats(spark, sf) -> DataFrame:
    pages = _t(spark, sf, "pages")
    n = _routes(spark, sf).groupBy("page_id").agg(F.count("route").alias("n_routes"))
    return (pages.select("page_id", F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("route_type"))
            .join(n, "page_id", "left").withColumn("n_routes", F.coalesce("n_routes", F.lit(0)).cast("long")))


@register("pages_before_first_empty", O.with_ctes(_PAGE_STATS_SQL, body=(
    "SELECT s.page_id, s.route_type, s.n_routes FROM page_stats s LEFT JOIN "
    "(SELECT route_type, min(page_id) AS fe FROM page_stats WHERE n_routes = 0 GROUP BY route_type) f "
    "ON s.route_type = f.route_type WHERE f.fe IS NULL OR s.page_id < f.fe")))
def q_pages_before(spark, sf):
    return crawl.pages_before_first_empty(_page_stats(spark, sf), "route_type", "page_id", "n_routes") \
        .select("page_id", "route_type", "n_routes")


@register("dedupe_keep_first", O.with_ctes(_NAV_SQL, body=(
    "SELECT route, arg_min(page_id, page_id * 1000 + pos) AS page_id, arg_min(pos, page_id * 1000 + pos) AS pos "
    "FROM routes WHERE length(route) > 0 GROUP BY route")))
def q_dedupe(spark, sf):
    return crawl.dedupe_keep_first(_routes(spark, sf), "route", ["page_id", "pos"])


_FETCH_CTES = O.with_ctes(O.pings_cte(N_BUSES), """polls AS (
  SELECT RUTA AS ruta, floor(epoch_us(p.timestamp) / 60000000.0) * 60 AS timestamp,
         count_if(e.event_type = 'error') AS n_err
  FROM pings p JOIN events e ON p.ping_seq = e.event_id GROUP BY 1, 2),
caps AS (
  SELECT RUTA AS ruta, floor(epoch_us(timestamp) / 60000000.0) * 60 AS timestamp, count(*) AS n
  FROM pings GROUP BY RUTA, floor(epoch_us(timestamp) / 60000000.0), floor(ping_seq / 4096)),
recs AS (
  SELECT c.ruta, c.timestamp, true AS success, CAST(NULL AS VARCHAR) AS error, c.n AS n_pings
  FROM caps c JOIN polls p ON c.ruta = p.ruta AND c.timestamp = p.timestamp WHERE p.n_err = 0
  UNION ALL
  SELECT ruta, timestamp, false, 'fetch failed: ' || CAST(n_err AS VARCHAR) || ' error event(s)', 0
  FROM polls WHERE n_err > 0)""", body="{body}")


@register("unify_fetch_results", _FETCH_CTES.replace("{body}", "SELECT ruta, timestamp, success, error, n_pings FROM recs"))
def q_unify(spark, sf):
    ok, err = fixtures.events_to_fetch_results(_t(spark, sf, "events"), N_BUSES)
    u = crawl.unify_fetch_results(ok, err)
    return u.select("ruta", "timestamp", "success", "error",
                    F.coalesce(F.json_array_length("gps_data"), F.lit(0)).cast("long").alias("n_pings"))


@register("fetch_outcome_counts", _FETCH_CTES.replace("{body}", (
    "SELECT count_if(success AND n_pings > 0) AS routes_with_gps, count_if(NOT success) AS routes_failed, "
    "count(*) AS routes_total FROM recs")))
def q_fetch_counts(spark, sf):
    ok, err = fixtures.events_to_fetch_results(_t(spark, sf, "events"), N_BUSES)
    return crawl.fetch_outcome_counts(crawl.unify_fetch_results(ok, err))


_STOP_FETCHES = O.with_ctes(O.pings_cte(N_BUSES), """fetches AS (SELECT RUTA AS ruta, date, day(date) % 5 = 0 AS failed,
  count(DISTINCT STOPID) AS n, CAST((date - DATE '1970-01-01') * 86400 AS DOUBLE) AS timestamp FROM pings GROUP BY RUTA, date)""",
                            body="{body}")


@register("stop_fetch_records", _STOP_FETCHES.replace("{body}", (
    "SELECT ruta, timestamp, CASE WHEN failed THEN 'timeout' END AS error, CASE WHEN failed THEN 0 ELSE n END AS n_stops FROM fetches")))
def q_stop_fetches(spark, sf):
    records = crawl.stop_fetch_records(*fixtures.events_to_stop_fetches(_t(spark, sf, "events"), N_BUSES))
    return records.select("ruta", "timestamp", "error", F.size("paradas").cast("long").alias("n_stops"))


@register("latest_stop_lists", _STOP_FETCHES.replace("{body}", (
    "SELECT ruta, max(timestamp) AS timestamp, arg_max(n, timestamp) AS n_stops FROM fetches WHERE NOT failed GROUP BY ruta")))
def q_latest_stops(spark, sf):
    """The stop list of each route that a refresh would use: the last one fetched without an error."""
    records = crawl.stop_fetch_records(*fixtures.events_to_stop_fetches(_t(spark, sf, "events"), N_BUSES))
    return crawl.latest_stop_lists(records).select("ruta", "timestamp", F.size("paradas").cast("long").alias("n_stops"))


# ---------------------------------------------------------------------------
# 2.6 / 2.8 profiling: at scale over lineitem / orders, and over the trips table
# ---------------------------------------------------------------------------

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRIP_NUM = ["TRIPDURATION", "AVGDELAY", "AVGVELOCITY"]


def _li(spark, sf):
    return _t(spark, sf, "lineitem")


@register("missing_values", "SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS missing_count, "
     f"{O.rsig(f'count_if({c} IS NULL) * 100.0e0 / count(*)')} AS missing_percent FROM orders"
     for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]]
    + ["SELECT '*', " + " + ".join(f"count_if({c} IS NULL)" for c in ["o_orderkey", "o_custkey", "o_orderstatus",
                                                                       "o_totalprice", "o_orderdate", "o_orderpriority"])
       + ", " + O.rsig("(" + " + ".join(f"count_if({c} IS NULL)" for c in ["o_orderkey", "o_custkey", "o_orderstatus",
                                                                             "o_totalprice", "o_orderdate",
                                                                             "o_orderpriority"]) + ") * 100.0e0 / count(*)")
       + " FROM orders"]) + ")")
def q_missing(spark, sf):
    return _stable(profile.missing_values(_t(spark, sf, "orders")), "missing_percent")


def _num_summary_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, {O.rsig(f'avg({x})')} AS mean, "
            f"{O.rsig(f'stddev_samp({x})')} AS std, min({x}) AS min, "
            f"quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, "
            f"quantile_cont({x}, 0.75) AS q75, max({x}) AS max FROM {table}")
    return _union(parts)


@register("numeric_summary", _num_summary_sql("lineitem", LI_NUM))
def q_numeric(spark, sf):
    return _stable(profile.numeric_summary(_li(spark, sf), LI_NUM), "mean", "std")


@register("numeric_summary_trips", _p(_num_summary_sql("trips", ["ORIENTATION"] + TRIP_NUM)))
def q_numeric_trips(spark, sf):
    return _stable(profile.numeric_summary(_trips_table(spark, sf), ["ORIENTATION"] + TRIP_NUM), "mean", "std")


_DC = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


@register("distinct_counts", _union([f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM orders"
                                     for c in _DC]))
def q_distinct(spark, sf):
    return profile.distinct_counts(_t(spark, sf, "orders"), _DC)


_DC_RANGE = ("1995-01-01", "1996-06-30")


@register("distinct_by_date_range", _union([
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct FROM orders "
    f"WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{_DC_RANGE[0]}' AND DATE '{_DC_RANGE[1]}'" for c in _DC]))
def q_distinct_range(spark, sf):
    """Sketches of each order date, written once, united over a range of dates (exact up to 16,384 values)."""
    orders = _t(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    stored = materialize(sketches.distinct_sketches(orders, _DC, "o_orderdate"))
    return sketches.distinct_in_range(stored, "o_orderdate", *_DC_RANGE)


@register("segment_speed_range", O.medallion(f"""SELECT RUTA AS LINE, ORIENTATION, segment_start, segment_end, count(*) AS OBS,
         {O.avg_cents("sum(VELOCITY_CENTS)", "count(VELOCITY_CENTS)")} AS AVG_SPEED_M_S,
         {O.rnd("avg(haversine_dist)", 1)} AS AVG_DIST_M, {O.rnd("quantile_disc(VELOCITY, 0.5)", 2)} AS MEDIAN_SPEED_M_S
  FROM seg WHERE date BETWEEN (SELECT min(date) FROM pings) + 1 AND (SELECT max(date) FROM pings) - 1
  GROUP BY RUTA, ORIENTATION, segment_start, segment_end""", N_BUSES, segments=True))
def q_segment_range(spark, sf):
    """Summaries of each segment and date, written once, merged over all dates but the first and the last."""
    core = _silver(spark, sf).core
    stored = materialize(sketches.segment_summaries(adjacent_segment_filter(next_stop_number(core))))
    ends = _pings(spark, sf).agg(F.date_add(F.min("date"), 1), F.date_sub(F.max("date"), 1)).first()
    return sketches.segment_speed_range(stored, *ends)


@register("value_counts_topk", "SELECT o_custkey AS value, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL "
          "GROUP BY o_custkey ORDER BY count DESC, value ASC LIMIT 10")
def q_topk_values(spark, sf):
    return profile.value_counts_topk(_t(spark, sf, "orders"), "o_custkey", 10)


@register("category_share", "SELECT o_orderpriority AS value, count(*) AS count, "
          f"{O.rsig('count(*) * 100.0e0 / sum(count(*)) OVER ()')} AS percent FROM orders "
          "WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority")
def q_share(spark, sf):
    return _stable(profile.category_share(_t(spark, sf, "orders"), "o_orderpriority"), "percent")


@register("duplicate_rows", "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM "
          "(SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
          "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)")
def q_dups(spark, sf):
    return profile.duplicate_rows(_li(spark, sf))


def _iqr_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, "
            f"(SELECT count_if({x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) FROM {table}) AS outliers, "
            f"q1 AS q1, q3 AS q3, q1 - 1.5 * (q3 - q1) AS lower, "
            f"q3 + 1.5 * (q3 - q1) AS upper, "
            f"{O.rsig(f'(SELECT count_if({x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1)) FROM {table}) * 100.0e0 / (SELECT count(*) FROM {table})')}"
            f" AS outlier_percent "
            f"FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {table})")
    return _union(parts)


@register("iqr_outliers", _iqr_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def q_iqr(spark, sf):
    return _stable(profile.iqr_outliers(_li(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"]), "outlier_percent")


@register("iqr_outliers_trips", _p(_iqr_sql("trips", TRIP_NUM)))
def q_iqr_trips(spark, sf):
    return _stable(profile.iqr_outliers(_trips_table(spark, sf), TRIP_NUM), "outlier_percent")


def _hist_sql(table: str, col: str, bins: int = 30) -> str:
    x = f"CAST({col} AS DOUBLE)"
    lo = f"(SELECT CASE WHEN min({x}) < max({x}) THEN min({x}) ELSE min({x}) - 0.5 END FROM {table})"
    hi = f"(SELECT CASE WHEN min({x}) < max({x}) THEN max({x}) ELSE max({x}) + 0.5 END FROM {table})"
    return (f"SELECT CAST(g.b AS INTEGER) AS bin, {lo} + g.b * (({hi} - {lo}) / {bins}.0e0) AS lower, "
            f"CASE WHEN g.b = {bins - 1} THEN {hi} ELSE {lo} + (g.b + 1) * (({hi} - {lo}) / {bins}.0e0) END AS upper, "
            f"CAST(coalesce(c.n, 0) AS BIGINT) AS count "
            f"FROM range({bins}) g(b) LEFT JOIN ("
            f"SELECT CAST(least(floor(({x} - {lo}) * {bins}.0e0 / ({hi} - {lo})), {bins - 1}) AS INTEGER) AS b, "
            f"count(*) AS n FROM {table} WHERE {x} IS NOT NULL GROUP BY 1) c ON c.b = g.b")


@register("histogram_30", _hist_sql("lineitem", "l_extendedprice"))
def q_hist(spark, sf):
    return profile.histogram_30(_li(spark, sf), "l_extendedprice", 30)


@register("histogram_30_trips", _p(_hist_sql("trips", "TRIPDURATION")))
def q_hist_trips(spark, sf):
    return profile.histogram_30(_trips_table(spark, sf), "TRIPDURATION", 30)


def _box_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, q1 AS q1, q2 AS median, q3 AS q3, "
            f"(SELECT min({x}) FROM {table} WHERE {x} >= q1 - 1.5 * (q3 - q1)) AS whisker_low, "
            f"(SELECT max({x}) FROM {table} WHERE {x} <= q3 + 1.5 * (q3 - q1)) AS whisker_high "
            f"FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS q2, "
            f"quantile_cont({x}, 0.75) AS q3 FROM {table})")
    return _union(parts)


@register("boxplot_stats", _box_sql("lineitem", ["l_quantity", "l_extendedprice", "l_tax"]))
def q_box(spark, sf):
    return profile.boxplot_stats(_li(spark, sf), ["l_quantity", "l_extendedprice", "l_tax"])


@register("boxplot_stats_trips", _p(_box_sql("trips", TRIP_NUM)))
def q_box_trips(spark, sf):
    return profile.boxplot_stats(_trips_table(spark, sf), TRIP_NUM)


def _corr_sql(table: str, cols: list[str]) -> str:
    return _union([f"SELECT '{a}' AS row_name, '{b}' AS col_name, "
                   f"{O.rsig(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM {table}"
                   for a in cols for b in cols])


@register("correlation_matrix", _corr_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def q_corr(spark, sf):
    return _stable(profile.correlation_matrix(_li(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"]), "corr")


@register("correlation_matrix_trips", _p(_corr_sql("trips", TRIP_NUM)))
def q_corr_trips(spark, sf):
    return _stable(profile.correlation_matrix(_trips(spark, sf), TRIP_NUM), "corr")


@register("mean_by_group", "SELECT l_returnflag, "
          f"{O.rsig('avg(CAST(l_extendedprice AS DOUBLE))')} AS mean_l_extendedprice FROM lineitem "
          "WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag")
def q_mean_group(spark, sf):
    return _stable(profile.mean_by_group(_li(spark, sf), "l_returnflag", "l_extendedprice"), "mean_l_extendedprice")


@register("mean_by_group_trips", _p(
    f"SELECT TIMEOFDAY, {O.rsig('avg(CAST(TRIPDURATION AS DOUBLE))')} AS mean_TRIPDURATION FROM trips "
    "WHERE TIMEOFDAY IS NOT NULL GROUP BY TIMEOFDAY"))
def q_mean_group_trips(spark, sf):
    return _stable(profile.mean_by_group(_trips(spark, sf), "TIMEOFDAY", "TRIPDURATION"), "mean_TRIPDURATION")


@register("mean_delay_by_timeofday", _p(
    f"SELECT TIMEOFDAY, {O.rsig('avg(CAST(AVGDELAY AS DOUBLE))')} AS mean_AVGDELAY FROM trips "
    "WHERE TIMEOFDAY IS NOT NULL GROUP BY TIMEOFDAY"))
def q_mean_delay(spark, sf):
    return _stable(profile.mean_by_group(_trips(spark, sf), "TIMEOFDAY", "AVGDELAY"), "mean_AVGDELAY")


@register("mean_speed_by_rushhour", _p(
    f"SELECT RUSHHOUR, {O.rsig('avg(AVGVELOCITY)')} AS mean_AVGVELOCITY FROM trips "
    "WHERE RUSHHOUR IS NOT NULL GROUP BY RUSHHOUR"))
def q_mean_speed(spark, sf):
    return _stable(profile.mean_by_group(_trips(spark, sf), "RUSHHOUR", "AVGVELOCITY"), "mean_AVGVELOCITY")


@register("histogram_delay", _p(_hist_sql("trips", "AVGDELAY")))
def q_hist_delay(spark, sf):
    return profile.histogram_30(_trips_table(spark, sf), "AVGDELAY", 30)


@register("histogram_speed", _p(_hist_sql("trips", "AVGVELOCITY")))
def q_hist_speed(spark, sf):
    return profile.histogram_30(_trips_table(spark, sf), "AVGVELOCITY", 30)


@register("total_outliers", _p(f"SELECT CAST(sum(outliers) AS BIGINT) AS total_outliers FROM ({_iqr_sql('trips', TRIP_NUM)})"))
def q_total_outliers(spark, sf):
    return profile.total_outliers(_trips_table(spark, sf), TRIP_NUM)


_EFF = "(CAST(AVGVELOCITY AS DOUBLE) / NULLIF(CAST(TRIPDURATION AS DOUBLE), 0))"
_CAT = ("CASE WHEN AVGDELAY IS NULL THEN NULL WHEN AVGDELAY <= -100 THEN 'High Negative' "
        "WHEN AVGDELAY <= 0 THEN 'Negative' WHEN AVGDELAY <= 100 THEN 'Positive' ELSE 'High Positive' END")


@register("trip_efficiency", _p(f"SELECT LINE, DATE, TIMEOFDAY, ORIENTATION, TRIPDURATION, AVGVELOCITY, "
                                f"{_EFF} AS EFFICIENCY FROM trips"))
def q_eff(spark, sf):
    return profile.with_trip_features(_trips(spark, sf)).select(
        "LINE", "DATE", "TIMEOFDAY", "ORIENTATION", "TRIPDURATION", "AVGVELOCITY", "EFFICIENCY")


@register("delay_category", _p(f"SELECT LINE, DATE, TIMEOFDAY, ORIENTATION, AVGDELAY, {_CAT} AS DELAY_CATEGORY "
                               "FROM trips"))
def q_delay_cat(spark, sf):
    return profile.with_trip_features(_trips(spark, sf)).select(
        "LINE", "DATE", "TIMEOFDAY", "ORIENTATION", "AVGDELAY", "DELAY_CATEGORY")


def _lp_sql() -> str:
    def r2(e):
        return O.rnd(e, 2)
    return _p("SELECT LINE, " + ", ".join([
        f"{r2('avg(CAST(TRIPDURATION AS DOUBLE))')} AS TRIPDURATION_mean",
        f"{r2('stddev_samp(CAST(TRIPDURATION AS DOUBLE))')} AS TRIPDURATION_std",
        "count(TRIPDURATION) AS TRIPDURATION_count",
        f"{r2('avg(CAST(AVGDELAY AS DOUBLE))')} AS AVGDELAY_mean",
        f"{r2('stddev_samp(CAST(AVGDELAY AS DOUBLE))')} AS AVGDELAY_std",
        f"{r2('avg(AVGVELOCITY)')} AS AVGVELOCITY_mean",
        f"{r2('stddev_samp(AVGVELOCITY)')} AS AVGVELOCITY_std"])
        + " FROM trips WHERE LINE IS NOT NULL GROUP BY LINE ORDER BY TRIPDURATION_mean DESC, LINE LIMIT 15")


@register("line_performance", _lp_sql())
def q_line_perf(spark, sf):
    return profile.line_performance(_trips(spark, sf), 15)


def _eff_group_sql(by: str) -> str:
    return _p(f"SELECT {by}, {O.rnd(f'avg({_EFF})', 4)} AS mean, {O.rnd(f'stddev_samp({_EFF})', 4)} AS std, "
              f"count({_EFF}) AS count FROM trips WHERE {by} IS NOT NULL GROUP BY {by}")


@register("efficiency_by_rushhour", _eff_group_sql("RUSHHOUR"))
def q_eff_rush(spark, sf):
    return profile.efficiency_by_group(_trips(spark, sf), "RUSHHOUR")


@register("delay_crosstab", _p(
    "SELECT TIMEOFDAY, " + ", ".join(f"count_if(cat = '{c}') AS \"{c}\"" for c in profile.DELAY_CATEGORIES)
    + f" FROM (SELECT TIMEOFDAY, {_CAT} AS cat FROM trips) WHERE TIMEOFDAY IS NOT NULL AND cat IS NOT NULL "
    "GROUP BY TIMEOFDAY"))
def q_crosstab(spark, sf):
    return profile.delay_crosstab(_trips(spark, sf))


@register("best_worst_group", _p(
    f"SELECT (SELECT TIMEOFDAY FROM g ORDER BY m DESC, TIMEOFDAY LIMIT 1) AS best, "
    f"(SELECT TIMEOFDAY FROM g ORDER BY m ASC, TIMEOFDAY LIMIT 1) AS worst "
    f"FROM (SELECT 1) dummy").replace(
    "\nSELECT (SELECT", f", g AS (SELECT TIMEOFDAY, avg({_EFF}) AS m FROM trips WHERE TIMEOFDAY IS NOT NULL "
    "GROUP BY TIMEOFDAY HAVING avg(" + _EFF + ") IS NOT NULL)\nSELECT (SELECT"))
def q_best_worst(spark, sf):
    return profile.best_worst_group(profile.with_trip_features(_trips(spark, sf)), "TIMEOFDAY", "EFFICIENCY")


@register("dataset_overview", _p(
    "SELECT count(*) AS rows, min(DATE) AS first_date, max(DATE) AS last_date, count(DISTINCT LINE) AS lines, "
    f"{O.rsig('avg(CAST(TRIPDURATION AS DOUBLE))')} AS mean_tripduration, "
    f"{O.rsig('avg(CAST(AVGDELAY AS DOUBLE))')} AS mean_avgdelay, "
    f"{O.rsig('avg(AVGVELOCITY)')} AS mean_avgvelocity FROM trips"))
def q_overview(spark, sf):
    return _stable(profile.dataset_overview(_trips(spark, sf)), "mean_tripduration", "mean_avgdelay", "mean_avgvelocity")


@register("rush_vs_nonrush", _p(
    f"SELECT {O.rsig(f'avg(CASE WHEN RUSHHOUR THEN {_EFF} END)')} AS rush_efficiency, "
    f"{O.rsig(f'avg(CASE WHEN NOT RUSHHOUR THEN {_EFF} END)')} AS nonrush_efficiency, "
    f"{O.rsig(f'abs(avg(CASE WHEN RUSHHOUR THEN {_EFF} END) - avg(CASE WHEN NOT RUSHHOUR THEN {_EFF} END))')} "
    "AS efficiency_difference FROM trips"))
def q_rush_vs(spark, sf):
    return _stable(profile.rush_vs_nonrush(_trips(spark, sf)), "rush_efficiency", "nonrush_efficiency", "efficiency_difference")


@register("sort_groups_desc", _p(
    f"SELECT LINE, {O.rsig('avg(AVGVELOCITY)')} AS mean_AVGVELOCITY FROM trips WHERE LINE IS NOT NULL GROUP BY LINE"))
def q_sort_groups(spark, sf):
    m = _stable(profile.mean_by_group(_trips(spark, sf), "LINE", "AVGVELOCITY"), "mean_AVGVELOCITY")
    return ordering.sort_groups_desc(m, "mean_AVGVELOCITY", "LINE")


@register("top_k", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
          "ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 10")
def q_top_k(spark, sf):
    li = _li(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ordering.top_k(li, "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


@register("preview_rows", _p("SELECT * FROM trips ORDER BY DATE, LINE, ORIENTATION, TRIPDURATION, AVGDELAY, "
                             "AVGVELOCITY, TIMEOFDAY LIMIT 10"))
def q_preview(spark, sf):
    return ordering.preview_rows(_trips(spark, sf), ["DATE", "LINE", "ORIENTATION", "TRIPDURATION", "AVGDELAY",
                                                     "AVGVELOCITY", "TIMEOFDAY"], 10)


# ---------------------------------------------------------------------------
# survey ids that the combined round-trip queries above also cover, registered
# under their own names
# ---------------------------------------------------------------------------


@register("write_snapshots", _FLAT_SQL)
def q_write_snapshots(spark, sf):
    return q_landing(spark, sf)


@register("read_gps_snapshots", O.with_ctes(O.pings_cte(N_BUSES), body=(
    "SELECT RUTA AS ruta, CAST(floor(epoch_us(timestamp) / 60000000.0) * 60 AS DOUBLE) AS timestamp, "
    "CAST(CAST(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(timestamp) / 60000000.0) AS BIGINT) "
    "* 60) - INTERVAL 5 HOUR AS TIMESTAMP) AS DATE) AS capture_date, count(*) AS n_pings FROM pings "
    "GROUP BY 1, 2, 3, floor(ping_seq / 4096)")))
def q_read_snapshots(spark, sf):
    path = scratch_path(spark, "landing-read")
    write_snapshots(_snapshots(spark, sf), path)
    snaps = read_gps_snapshots(spark, path)
    return snaps.select("ruta", "timestamp", "capture_date",
                        F.json_array_length("gps_data").cast("long").alias("n_pings"))


@register("export_trips_csv", _p("SELECT * FROM trips WHERE strftime(DATE, '%Y-%m') = '2024-01'"))
def q_export_csv(spark, sf):
    return q_trips_csv(spark, sf)


@register("read_trips_csv", _p("SELECT * FROM trips"))
def q_read_csv(spark, sf):
    root = scratch_path(spark, "trips-csv-all")
    t = _trips(spark, sf)
    t.write.mode("overwrite").option("header", True).csv(root)
    return read_trips_csv(spark, root)


@register("pick_timestamp_column", _FLAT_SQL)
def q_pick_ts(spark, sf):
    """Captures without ``timestamp``: flatten falls back to ``ingest_time`` (set to the poll time here)."""
    snaps = _snapshots(spark, sf)
    snaps = snaps.withColumn("ingest_time", F.timestamp_seconds(F.col("timestamp").cast("long"))).drop("timestamp")
    return flatten_pings(parse_gps_payload(snaps))


@register("local_date", "SELECT event_id, CAST(CAST(TIMESTAMP '1970-01-01 00:00:00' + "
          "to_seconds(CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT)) - INTERVAL 5 HOUR AS TIMESTAMP) AS DATE) "
          "AS local_date FROM events")
def q_local_date(spark, sf):
    return q_epoch(spark, sf).select("event_id", "local_date")


@register("efficiency_by_group", _eff_group_sql("TIMEOFDAY"))
def q_eff_group(spark, sf):
    return profile.efficiency_by_group(_trips(spark, sf), "TIMEOFDAY")


@register("daily_refresh", O.medallion("SELECT * FROM trips", N_BUSES, from_captures=True))
def q_refresh(spark, sf):
    """Daily refresh over landed captures and a stops file; the published trips table."""
    caps, stops_file = _refresh_inputs(spark, sf)
    res = refresh(spark, caps, stops_file, scratch_path(spark, "refresh-out"), stops_multiline=False)
    return read_layer(spark, res["root"], "gold_trips_final").select(*_TRIP_COLS)


def _refresh_inputs(spark, sf) -> tuple[str, str]:
    events = _t(spark, sf, "events")
    caps, stops_file = scratch_path(spark, "refresh-captures"), scratch_path(spark, "refresh-stops")
    write_snapshots(fixtures.events_to_snapshots(events, N_BUSES), caps)
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events, N_BUSES))),
                     stops_file)
    return caps, stops_file


@register("refresh_two_dates", O.medallion("SELECT * FROM trips", N_BUSES, from_captures=True))
def q_refresh_two(spark, sf):
    """The landed dates refreshed in two runs into one root: the second keeps what the first published."""
    caps, stops_file = _refresh_inputs(spark, sf)
    dates = sorted(str(r[0]) for r in read_gps_snapshots(spark, caps).select("capture_date").distinct().collect())
    root, half = scratch_path(spark, "refresh-out"), (len(dates) + 1) // 2
    for run in (dates[:half], dates[half:]):
        refresh(spark, caps, stops_file, root, capture_dates=run, stops_multiline=False)
    return read_layer(spark, root, "gold_trips_final").select(*_TRIP_COLS)


@register("incremental_refresh", O.medallion("""SELECT trips.*, CASE WHEN DATE = (SELECT min(date) FROM pings)
    THEN 2 ELSE 1 END AS RUNS FROM trips""", N_BUSES, from_captures=True))
def q_incremental_refresh(spark, sf):
    """Captures land in two deliveries, the second with late ones of the first date only; RUNS counts a date's rewrites."""
    events = _t(spark, sf, "events")
    caps, (root, ckpt) = scratch_path(spark, "late-captures"), (scratch_path(spark, n) for n in ("late-out", "late-ckpt"))
    stops_file = scratch_path(spark, "late-stops")
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events, N_BUSES))), stops_file)
    snaps = with_capture_date(fixtures.events_to_snapshots(events, N_BUSES))
    first = snaps.agg(F.min(PARTITION_COL)).first()[0]
    late = (F.col(PARTITION_COL) == F.lit(first)) & (F.pmod(F.xxhash64("ruta", "timestamp"), F.lit(2)) == 0)
    for delivery in (~late, late):
        write_snapshots(snaps.filter(delivery), caps)
        incremental_refresh(spark, caps, stops_file, root, ckpt, stops_multiline=False)
    runs: dict = {}
    for _, date, _ in history(spark, root, "silver_gps_flat"):
        runs[date] = runs.get(date, 0) + 1
    trips = read_layer(spark, root, "gold_trips_final").select(*_TRIP_COLS)
    counts = spark.createDataFrame([(datetime.date.fromisoformat(d), n) for d, n in runs.items()], "DATE date, RUNS int")
    return trips.join(F.broadcast(counts), "DATE").select(*_TRIP_COLS, "RUNS")  # one row for each date


_CAT_COLS = ["LINE", "TIMEOFDAY", "RUSHHOUR", "ORIENTATION"]


def _cat_sql() -> str:
    parts = []
    for c in _CAT_COLS:
        v = f"CASE WHEN {c} THEN 'true' ELSE 'false' END" if c == "RUSHHOUR" else f"CAST({c} AS VARCHAR)"
        parts.append(
            f"SELECT * FROM (SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM trips) AS n_distinct, "
            f"CAST(row_number() OVER (ORDER BY count(*) DESC, {v}) AS INTEGER) AS rank, {v} AS value, "
            f"count(*) AS count FROM trips WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count DESC, value LIMIT 10)")
    return _p(" UNION ALL ".join(parts))


@register("categorical_summary", _cat_sql())
def q_categorical(spark, sf):
    return profile.categorical_summary(_trips_table(spark, sf), _CAT_COLS, 10)


_TRIP_COLS = ["LINE", "DATE", "TIMEOFDAY", "RUSHHOUR", "ORIENTATION", "TRIPDURATION", "AVGDELAY", "AVGVELOCITY"]


@register("missing_values_trips", _p("SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS missing_count, "
     f"{O.rsig(f'count_if({c} IS NULL) * 100.0e0 / count(*)')} AS missing_percent FROM trips" for c in _TRIP_COLS]
    + ["SELECT '*', " + " + ".join(f"count_if({c} IS NULL)" for c in _TRIP_COLS) + ", "
       + O.rsig("(" + " + ".join(f"count_if({c} IS NULL)" for c in _TRIP_COLS) + ") * 100.0e0 / count(*)")
       + " FROM trips"]) + ")"))
def q_missing_trips(spark, sf):
    return _stable(profile.missing_values(_trips(spark, sf)), "missing_percent")


@register("duplicate_rows_trips", _p("SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM "
                                     f"(SELECT count(*) AS c FROM trips GROUP BY {', '.join(_TRIP_COLS)})"))
def q_dups_trips(spark, sf):
    return profile.duplicate_rows(_trips(spark, sf))


@register("category_share_trips", _p(
    f"SELECT TIMEOFDAY AS value, count(*) AS count, {O.rsig('count(*) * 100.0e0 / sum(count(*)) OVER ()')} "
    "AS percent FROM trips WHERE TIMEOFDAY IS NOT NULL GROUP BY TIMEOFDAY"))
def q_share_trips(spark, sf):
    return _stable(profile.category_share(_trips_table(spark, sf), "TIMEOFDAY"), "percent")


@register("heavy_hitters", _union([
    f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS value, count(*) AS count FROM lineitem WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count DESC, value ASC LIMIT 20)" for c in ("l_partkey", "l_orderkey")]))
def q_heavy(spark, sf):
    """The 20 most frequent part and order keys of the line items, found behind a count-min bound."""
    parts = [heavy.heavy_hitters(_t(spark, sf, "lineitem"), c, 20).select(F.lit(c).alias("column_name"), "value", "count")
             for c in ("l_partkey", "l_orderkey")]
    return reduce(DataFrame.unionByName, parts)


@register("value_counts_topk_trips", _p("SELECT LINE AS value, count(*) AS count FROM trips WHERE LINE IS NOT NULL "
                                        "GROUP BY LINE ORDER BY count DESC, value ASC LIMIT 10"))
def q_topk_trips(spark, sf):
    return profile.value_counts_topk(_trips(spark, sf), "LINE", 10)
