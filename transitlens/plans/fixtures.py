"""Deterministic adapters from the shared test tables to bus-telemetry inputs.

The test tables hold no bus data, so pings are derived from ``events`` (one
ping per event) by a fixed rule, and stops from the pings. Both rules are
plain column expressions, so the same derivation runs in any SQL engine.

Fixed values of the rule:
    BUSNUMBER = user_id % n_buses           RUTA = 'L' || user_id % 3
    STOPID    = k % 12 (k from props)       TRIPID = floor(hour(ts) / 3)
    DELAY     = floor(value * 10) % 600 - 300
    GPSX      = -76.5 + k / 1000            GPSY = 3.4 + value / 1000,
                                            0 where event_id % 97 = 0 (bad fix)
    stops: ORIENTATION 0 for STOPID <= 6, 1 for STOPID >= 6 (6 serves both)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.operators.stops import stop_row_number
from transitlens.schemas import PAYLOAD_TYPE, STOP_FIELDS

BAD_FIX_MODULUS = 97
N_STOPS = 12
TURN_STOP = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def events_to_pings(events: DataFrame, n_buses: int = 10) -> DataFrame:
    """Silver-flat-shaped pings (plus ``ping_seq`` = event_id)."""
    k = _k()
    gpsy = F.when(F.col("event_id") % BAD_FIX_MODULUS == 0, F.lit(0.0)).otherwise(
        F.lit(3.4) + F.col("value") / F.lit(1000.0))
    return events.select(
        (F.col("user_id") % n_buses).cast("string").alias("BUSNUMBER"),
        (F.floor(F.col("value") * 10) % 600 - 300).cast("int").alias("DELAY"),
        F.lit(None).cast("string").alias("PARADA"),
        F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("RUTA"),
        F.lit(None).cast("string").alias("RUTERO"),
        (k % N_STOPS).cast("string").alias("STOPID"),
        F.lit(None).cast("string").alias("TASKID"),
        F.lit(None).cast("string").alias("TELEGRAMDATE"),
        F.floor(F.hour("ts") / 3).cast("int").cast("string").alias("TRIPID"),
        F.col("ts").alias("timestamp"),
        (F.lit(-76.5) + k / F.lit(1000.0)).alias("GPSX"),
        gpsy.alias("GPSY"),
        F.col("event_id").alias("ping_seq"),
        F.to_date("ts").alias("date"),
    )


def stops_from_pings(pings: DataFrame) -> DataFrame:
    """Raw stop rows (LINE, STOPID, ORIENTATION, ROWNUM) for every (RUTA, STOPID) seen."""
    seen = pings.select(F.col("RUTA").alias("LINE"), "STOPID").distinct()
    sid = F.col("STOPID").try_cast("int")
    dirs = F.when(sid < TURN_STOP, F.array(F.lit(0))).when(sid == TURN_STOP, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(1)))
    return seen.select("LINE", "STOPID", F.explode(dirs).alias("ORIENTATION"), sid.alias("ROWNUM"))


def fixture_stops(pings: DataFrame) -> DataFrame:
    """silver_stops_routes for the fixture pings."""
    return stop_row_number(stops_from_pings(pings))


CAPTURE_SECONDS = 60
CAPTURE_BLOCK = 4096  # event ids per capture block: bounds every capture array


def events_to_snapshots(events: DataFrame, n_buses: int = 10) -> DataFrame:
    """Landed-capture rows: one per route, poll minute and block of event ids.

    Coordinates are written as fixed-point strings (x 1e7) and every field as
    text, as the position feed delivers them; the capture time is the poll
    minute in epoch seconds. A capture holds the pings of one route and minute
    whose event ids fall in one block of ``CAPTURE_BLOCK`` ids, so no capture
    array grows with the data. Elements are ordered by event id (payload
    positions are deterministic) and carry the event id as TASKID, the feed's
    task identifier and the last tie-breaker of the ping order.
    """
    p = events_to_pings(events, n_buses)
    fixed = lambda c: F.floor(F.col(c) * F.lit(1e7) + F.lit(0.5)).cast("long").cast("string")
    elem = F.struct(F.struct(
        F.col("BUSNUMBER"), F.col("DELAY").cast("string").alias("DELAY"), fixed("GPSX").alias("GPSX"),
        fixed("GPSY").alias("GPSY"), F.col("PARADA"), F.col("RUTA"), F.col("RUTERO"), F.col("STOPID"),
        F.col("ping_seq").cast("string").alias("TASKID"), F.col("TELEGRAMDATE"), F.col("TRIPID")).alias("element"))
    minute = (F.floor(F.unix_timestamp("timestamp") / F.lit(CAPTURE_SECONDS)) * CAPTURE_SECONDS)
    block = F.floor(F.col("ping_seq") / F.lit(CAPTURE_BLOCK))
    g = (p.groupBy(F.col("RUTA").alias("ruta"), minute.alias("_minute"), block.alias("_block"))
         .agg(F.array_sort(F.collect_list(F.struct(F.col("ping_seq"), elem.alias("e")))).alias("_items")))
    return g.select(
        "ruta",
        F.to_json(F.transform("_items", lambda x: x["e"])).alias("gps_data"),
        F.col("_minute").cast("double").alias("timestamp"),
        F.lit(True).alias("success"),
        F.lit(None).cast("string").alias("error"))


def with_broken_payloads(snaps: DataFrame) -> DataFrame:
    """Captures whose payload takes, by poll minute, one of nine shapes, five of which can't be used (see ``FIXTURES.md``)."""
    wrapped = F.from_json("gps_data", PAYLOAD_TYPE)
    shape = (F.col("timestamp") / CAPTURE_SECONDS).cast("long") % 9
    text = F.col("gps_data")
    return snaps.withColumn("gps_data", F.when(shape == 1, None).when(shape == 2, " ").when(shape == 3, "null")
                            .when(shape == 4, F.substring(text, F.lit(1), F.length(text) - 2))
                            .when(shape == 5, F.to_json(F.transform(wrapped, lambda e: e["element"])))
                            .when(shape == 6, F.to_json(F.get(wrapped, F.lit(0))))
                            .when(shape == 7, F.concat(F.lit("[null,{},"), F.substring(text, F.lit(2), F.length(text))))
                            .when(shape == 8, "42").otherwise(text))


def events_to_fetch_results(events: DataFrame, n_buses: int = 10) -> tuple[DataFrame, DataFrame]:
    """(ok, err) fetch records: a poll whose events include an ``error`` event failed."""
    e = events.withColumn("_minute", F.floor(F.unix_timestamp("ts") / F.lit(CAPTURE_SECONDS)) * CAPTURE_SECONDS)
    e = e.withColumn("ruta", F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")))
    polls = e.groupBy("ruta", "_minute").agg(F.count_if(F.col("event_type") == "error").alias("_errors"))
    snaps = events_to_snapshots(events, n_buses)
    ok = (snaps.join(polls.filter(F.col("_errors") == 0),
                     (snaps["ruta"] == polls["ruta"]) & (snaps["timestamp"] == polls["_minute"].cast("double")),
                     "left_semi").drop("error"))
    err = polls.filter(F.col("_errors") > 0).select(
        "ruta", F.lit("[]").alias("gps_data"),
        F.concat(F.lit("fetch failed: "), F.col("_errors").cast("string"), F.lit(" error event(s)")).alias("error"),
        F.col("_minute").cast("double").alias("timestamp"), F.lit(False).alias("success"))
    return ok, err


def events_to_stop_fetches(events: DataFrame, n_buses: int = 10) -> tuple[DataFrame, DataFrame]:
    """(ok, err) stop fetches, one for each route and date: the stops seen that day; every fifth day of a month fails."""
    p = events_to_pings(events, n_buses)
    failed = F.dayofmonth("date") % 5 == 0
    seen = p.select(F.col("RUTA").alias("ruta"), "date", "STOPID").distinct()
    stop = F.struct(*[(F.col("STOPID") if c == "STOPID" else F.col("ruta") if c == "LINE" else F.lit(None).cast("string")).alias(c)
                      for c in STOP_FIELDS])
    lists = seen.groupBy("ruta", "date").agg(F.collect_list(stop).alias("paradas"))  # bounded by the stops of a route
    lists = lists.withColumn("timestamp", (F.unix_date("date") * 86400).cast("double"))
    ok = lists.filter(~failed).select("ruta", "paradas", "timestamp")
    err = lists.filter(failed).select("ruta", F.lit("timeout").alias("error"), "timestamp")
    return ok, err


def route_stop_lists(stops_raw: DataFrame) -> DataFrame:
    """Per route: the stop objects of both directions (the stops-feed shape).

    One list per route, bounded by the stops of a route (a dimension).
    """
    s = stops_raw.select(
        F.col("LINE").alias("ruta"),
        F.struct(*[F.lit(None).cast("string").alias(c) for c in ("DECIMALLATITUDE", "DECIMALLONGITUDE",
                                                                 "DESCRIPTION")],
                 F.col("LINE"), F.lit(None).cast("string").alias("LINEID"),
                 F.lit(None).cast("string").alias("LINEVA"), F.lit(None).cast("string").alias("LONGNAME"),
                 F.col("ORIENTATION").cast("string").alias("ORIENTATION"),
                 F.lit(None).cast("string").alias("RNK"), F.col("ROWNUM").cast("string").alias("ROWNUM"),
                 F.lit(None).cast("string").alias("SENTIDO"), F.lit(None).cast("string").alias("SHORTNAME"),
                 F.lit(None).cast("string").alias("STOPCHECK"), F.col("STOPID")).alias("stop"))
    return s.groupBy("ruta").agg(F.collect_list("stop").alias("paradas"))
