"""One test per semantic decision (survey 2.13 T-items and bin edges)."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import PING_SCHEMA, line_stops, ping, stops_df, t
from transitlens.functions.timefn import rush_hour_flag, time_of_day_bucket
from transitlens.functions.trip import delay_category
from transitlens.operators.enrich import enrich_core, match_pings_to_stops
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.operators.trips import trip_sanity_filter
from transitlens.plans import gold


def _silver(spark, pings, stops):
    return gold.build_silver(spark.createDataFrame(pings, PING_SCHEMA), stops)


def _trip(bus="1", route="A", trip="0", day=1, start=(7, 0), n=5, step_min=5, lat=4.0, delay=10, gpsy=None):
    rows = []
    for i in range(n):
        h, m = start[0], start[1] + i * step_min
        ts = datetime(2024, 1, day, h + m // 60, m % 60, 0)
        y = (gpsy or {}).get(i, lat + i * 0.01)
        rows.append(ping(bus, route, str(i + 1), trip, ts, y, -76.5 + i * 0.01, delay, i))
    return rows


def test_t1_drop_after_windows(spark):
    rows = _trip(n=5, step_min=5, gpsy={0: 0.5})
    s = _silver(spark, rows, line_stops(spark, "A", 5))
    en = gold.silver_gps_enriched(s).orderBy("timestamp").collect()
    assert len(en) == 4  # first ping dropped from the table ...
    assert en[0]["LASTLATITUDE"] == 0.5  # ... but it still fed lag()
    assert gold.gold_trips_candidates(s).count() == 0  # trip start dropped -> no candidate


def test_t2_running_average_ties_share(spark):
    ts = t(7)
    rows = [ping("1", "A", "1", "0", ts, 4.0, -76.5, 10, 0), ping("1", "A", "2", "0", ts, 4.01, -76.5, 20, 1),
            ping("1", "A", "3", "0", t(7, 10), 4.02, -76.5, 60, 2)]
    s = _silver(spark, rows, line_stops(spark, "A", 3))
    r = s.core.orderBy("timestamp", "row_number").collect()
    assert r[0]["AVGDELAY"] == r[1]["AVGDELAY"] == 15.0
    assert r[2]["AVGDELAY"] == 30.0


def test_t4_bad_strings_become_null(spark):
    payload = json.dumps([{"element": {"BUSNUMBER": "1", "DELAY": "x", "GPSX": "", "GPSY": None}},
                          {"element": {"BUSNUMBER": "2", "DELAY": "1.5", "GPSX": "-765000000", "GPSY": "34000000"}}])
    out = flatten_pings(parse_gps_payload(spark.createDataFrame([(payload, 0.0)], "gps_data string, timestamp double")))
    r = {x.BUSNUMBER: x for x in out.collect()}
    assert r["1"].DELAY is None and r["1"].GPSX is None and r["1"].GPSY is None
    assert r["2"].DELAY is None and r["2"].GPSX == -76.5 and r["2"].GPSY == 3.4


def test_t5_session_zone_does_not_shift(spark):
    el = json.dumps([{"element": {"BUSNUMBER": "1"}}])
    raw = spark.createDataFrame([(el, 1693526400.0)], "gps_data string, timestamp double")
    out = []
    for tz in ("UTC", "America/Bogota", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        r = flatten_pings(parse_gps_payload(raw)).select("timestamp", "date", F.hour("timestamp").alias("h")).first()
        out.append((r.timestamp, r.date, r.h))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out[0] == out[1] == out[2] == (datetime(2023, 8, 31, 19, 0), date(2023, 8, 31), 19)


def test_t6_missing_payload_column(spark):
    raw = spark.createDataFrame([(1.0,)], "timestamp double")
    assert flatten_pings(parse_gps_payload(raw)).count() == 0


@pytest.mark.parametrize("text,rows", [
    (json.dumps([{"BUSNUMBER": "7"}]), 1),            # bare element (no wrapper)
    (json.dumps({"element": {"BUSNUMBER": "7"}}), 1),  # single object
    ("not json", 0), ("", 0), ("null", 0), ("[]", 0),
])
def test_t7_payload_shapes(spark, text, rows):
    raw = spark.createDataFrame([(text, 1.0)], "gps_data string, timestamp double")
    out = flatten_pings(parse_gps_payload(raw)).collect()
    assert len(out) == rows
    if rows:
        assert out[0].BUSNUMBER == "7"


def test_t7_null_and_map_payloads(spark):
    raw = spark.createDataFrame([(None, 1.0)], "gps_data string, timestamp double")
    assert flatten_pings(parse_gps_payload(raw)).count() == 0
    m = spark.createDataFrame([([{"element": {"BUSNUMBER": "3", "GPSY": "40000000"}}], 1.0)],
                              "gps_data array<map<string,map<string,string>>>, timestamp double")
    r = flatten_pings(parse_gps_payload(m)).first()
    assert r.BUSNUMBER == "3" and r.GPSY == 4.0


def test_t9_ties_broken_by_stop_then_position(spark):
    ts = t(7)
    rows = [ping("1", "A", "2", "0", ts, 4.02, -76.5, 0, 0), ping("1", "A", "1", "0", ts, 4.01, -76.5, 0, 1),
            ping("1", "A", "3", "0", t(7, 1), 4.03, -76.5, 0, 2)]
    s = _silver(spark, rows, line_stops(spark, "A", 3))
    r = {x.row_number: x for x in s.core.collect()}
    assert r[1].prev_rownum is None and r[2].prev_rownum == 1 and r[3].prev_rownum == 2


def test_t10_unmatched_ping_own_partition(spark):
    rows = _trip(n=3) + [ping("1", "A", "99", "0", t(7, 2), 4.5, -76.5, 0, 9)]
    s = _silver(spark, rows, line_stops(spark, "A", 3))
    core = s.core.collect()
    un = [r for r in core if r.ORIENTATION is None]
    assert len(un) == 1 and un[0].prev_time is None and un[0].next_time is None
    assert gold.gold_trips_candidates(s).filter(F.col("ORIENTATION").isNull()).count() == 0


def test_t12_sanity_bounds_strict(spark):
    rows = [(d, v) for d, v in [(10.0, 5.0), (11.0, 5.0), (179.0, 5.0), (180.0, 5.0), (50.0, 0.2), (50.0, 100.0),
                                (50.0, 0.21), (50.0, 99.99)]]
    df = spark.createDataFrame(rows, "TRIPDURATION double, AVGVELOCITY double")
    kept = sorted((r.TRIPDURATION, r.AVGVELOCITY) for r in trip_sanity_filter(df).collect())
    assert kept == [(11.0, 5.0), (50.0, 0.21), (50.0, 99.99), (179.0, 5.0)]


def test_t14_midnight_splits_trip(spark):
    rows = [ping("1", "A", str(i + 1), "7", datetime(2024, 1, 1, 23, 50) if i < 2 else datetime(2024, 1, 2, 0, 5 * i),
                 4.0 + i * 0.01, -76.5, 0, i) for i in range(4)]
    s = _silver(spark, rows, line_stops(spark, "A", 4))
    assert s.core.select("date").distinct().count() == 2
    assert s.core.filter(F.col("prev_time").isNull()).count() == 2  # two partitions


def test_t15_name_clash_is_resolved(spark):
    pings = spark.createDataFrame(
        [("1", "A", "t1", "s", 1, 7, 4.0, -74.0, datetime(2025, 9, 1, 8)),
         ("1", "A", "t1", "s", 1, 8, 4.0001, -73.9999, datetime(2025, 9, 1, 8, 0, 10))],
        "BUSNUMBER string, RUTA string, TRIPID string, STOPID string, ORIENTATION long, row_number long, "
        "GPSY double, GPSX double, timestamp timestamp_ntz").withColumn("date", F.to_date("timestamp")) \
        .withColumn("DELAY", F.lit(0))
    stops = stops_df(spark, [("s", "A", 1, 1, 1)])
    core = enrich_core(match_pings_to_stops(pings, stops))
    assert core.filter(F.col("row_number") == 1).count() == 2


@pytest.mark.parametrize("hour,bucket,rush", [
    (3, "night", False), (4, "morning", False), (5, "morning", False), (6, "morning", True), (9, "morning", True),
    (10, "morning", False), (11, "morning", False), (12, "afternoon", False), (15, "afternoon", False),
    (16, "afternoon", True), (17, "afternoon", True), (18, "evening", True), (19, "evening", True),
    (20, "evening", False), (23, "evening", False), (0, "night", False)])
def test_time_of_day_and_rush_edges(spark, hour, bucket, rush):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour, 30),)], "ts timestamp_ntz")
    r = df.select(time_of_day_bucket("ts").alias("b"), rush_hour_flag("ts").alias("r")).first()
    assert (r.b, r.r) == (bucket, rush)


def test_delay_bins_right_closed(spark):
    df = spark.createDataFrame([(-101,), (-100,), (-99,), (0,), (1,), (100,), (101,), (None,)], "d int")
    got = [r.c for r in df.select(delay_category("d").alias("c")).collect()]
    assert got == ["High Negative", "High Negative", "Negative", "Negative", "Positive", "Positive",
                   "High Positive", None]


def test_single_ping_trip_has_no_candidate(spark):
    s = _silver(spark, _trip(n=1), line_stops(spark, "A", 3))
    assert gold.gold_trips_candidates(s).count() == 0


def test_expect_or_drop_records_metrics(spark):
    from pyspark.sql import Observation
    from transitlens.operators.quality import expect_or_drop
    obs = Observation("gpsy")
    df = spark.createDataFrame([(0.5,), (None,), (4.0,), (5.0,)], "GPSY double")
    kept = expect_or_drop(df, "gpsy_positive", "GPSY IS NOT NULL AND GPSY > 1", obs)
    assert kept.count() == 2
    assert obs.get == {"gpsy_positive_passed": 2, "gpsy_positive_failed": 2}


def test_last_ping_dropped_means_no_trip(spark):
    rows = _trip(n=4, step_min=10, gpsy={3: 0.9})
    s = _silver(spark, rows, line_stops(spark, "A", 4))
    assert gold.gold_trips_candidates(s).count() == 0
    assert gold.silver_gps_enriched(s).count() == 3


def test_t3_two_sided_and_leg_speed(spark):
    rows = [ping("1", "A", "1", "0", t(7, 0, 0), 4.0, -76.5, 0, 0), ping("1", "A", "2", "0", t(7, 0, 10), 4.001, -76.5, 0, 1),
            ping("1", "A", "3", "0", t(7, 0, 40), 4.002, -76.5, 0, 2)]
    pings = spark.createDataFrame(rows, PING_SCHEMA)
    joined = match_pings_to_stops(pings, line_stops(spark, "A", 3))
    two = {r.row_number: r for r in enrich_core(joined).collect()}
    one = {r.row_number: r for r in enrich_core(joined, two_sided=False).collect()}
    d = two[2].haversine_dist
    assert two[2].time_s == 40 and two[2].VELOCITY == round(d / 40 + 1e-12, 2)
    assert one[2].time_s == 10 and one[2].VELOCITY == round(d / 10 + 1e-12, 2)
    assert two[3].VELOCITY is None and one[3].time_s == 30  # last ping: no next time, leg time still known
