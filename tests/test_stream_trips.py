"""Trips on a stream: each once, late pings counted, restarts from the checkpoint."""

import json
import os

import pytest

from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.operators.enrich import enrich_core, match_pings_to_stops
from transitlens.operators.trips import pair_trip_endpoints
from transitlens.sources.snapshots import write_snapshots
from transitlens.streaming import trips as S

CAPTURE = "ruta string, gps_data string, timestamp double, success boolean"
NOON = 1704474000.0  # 2024-01-05 12:00 in Bogota
HOUR, DAY = 3600, 86400


def ping(bus, stop, delay=0, trip="T", gpsy=35000000):
    return {"element": {"BUSNUMBER": bus, "DELAY": str(delay), "GPSX": "-765000000", "GPSY": str(gpsy), "RUTA": "L1", "STOPID": str(stop),
                        "TASKID": "0", "TRIPID": trip}}


def capture(spark, *polls):
    """Polls of (time, pings)."""
    return spark.createDataFrame([("L1", json.dumps(pings), float(t), True) for t, pings in polls], CAPTURE)


@pytest.fixture
def stops(spark):
    return spark.createDataFrame([(str(k), "L1", 0, k, k) for k in range(1, 9)],
                                 "STOPID string, LINE string, ORIENTATION int, ROWNUM int, row_number int")


@pytest.fixture
def feed(spark, stops, tmp_path):
    caps, sink, ckpt = (str(tmp_path / d) for d in ("captures", "sink", "ckpt"))

    def run(*polls):
        if polls:
            write_snapshots(capture(spark, *polls), caps)
        S.stream_trip_pairs(spark, caps, stops, sink, ckpt, lateness="2 hours").awaitTermination()
        return sorted((r.BUSNUMBER, str(r.date), r.STARTSTOP, r.ENDSTOP, r.N_PINGS, r.AVGDELAY)
                      for r in S.read_trip_pairs(spark, sink).collect()) if has_files(sink) else []

    def late():
        return sorted((r.BUSNUMBER, str(r.date), r.N_PINGS, r.N_EMITTED, r.N_LATE)
                      for r in S.late_pings(spark, caps, stops, sink, ckpt).collect())

    return run, late, caps, ckpt


def has_files(path):
    return os.path.isdir(path) and any(d.startswith("date=") for d in os.listdir(path))


def test_trips_are_emitted_once_when_their_day_is_over(spark, feed):
    run, late, _, ckpt = feed
    assert S.watermark(spark, ckpt) is None
    assert run((NOON, [ping("b1", 1, 10)]), (NOON + 60, [ping("b1", 2, 20)])) == []
    # out of order, but in time: the day is open
    assert run((NOON - 120, [ping("b1", 3, 30), ping("b2", 1)]), (NOON + HOUR, [])) == []
    # the day ends 12 hours after noon; its pings may come until the clock shows two hours more
    assert run((NOON + 13.5 * HOUR, [ping("b1", 5, 1)])) == []
    assert run((NOON + 13 * HOUR, []), (NOON - 60, [ping("b2", 4, 6)])) == []
    day = [("b1", "2024-01-05", 3, 2, 3, 20.0), ("b2", "2024-01-05", 1, 4, 2, 3.0)]
    assert run((NOON + 14.5 * HOUR, [])) == day  # a poll without buses ends the day
    assert run() == day and late() == []
    assert run((NOON + 3 * DAY, [])) == sorted([*day, ("b1", "2024-01-06", 5, 5, 1, 1.0)])


def test_late_pings_are_counted_and_change_no_trip(spark, feed):
    run, late, _, _ = feed
    run((NOON, [ping("b1", 1, 10), ping("b3", 1, gpsy=0)]), (NOON + 60, [ping("b1", 2, 20), ping("b3", 2)]))
    done = run((NOON + 15 * HOUR, []))
    assert done == [("b1", "2024-01-05", 1, 2, 2, 15.0)] and late() == []  # b3's first ping fails the rule: no pair, nothing late
    after = run((NOON + 120, [ping("b1", 7, 99), ping("b4", 1)]), (NOON + 180, [ping("b4", 2)]), (NOON + 16 * HOUR, []))
    assert after == done
    assert late() == [("b1", "2024-01-05", 3, 2, 1), ("b4", "2024-01-05", 2, 0, 2)]
    assert run((NOON + 240, [ping("b1", 8, 99)])) == done  # a run of late pings only
    assert late() == [("b1", "2024-01-05", 4, 2, 2), ("b4", "2024-01-05", 2, 0, 2)]


def test_a_restart_after_a_failed_batch_emits_nothing_twice(spark, feed, stops, monkeypatch):
    run, late, caps, ckpt = feed
    run((NOON, [ping("b1", 1, 10)]))
    real = S.grouped_trips

    def broken(pings, *keys):
        return real(pings, *keys).withColumn("N_PINGS", S.F.raise_error(S.F.lit("lost")).cast("long"))

    with monkeypatch.context() as m:
        m.setattr(S, "grouped_trips", broken)
        with pytest.raises(Exception, match="lost"):
            run((NOON + 60, [ping("b1", 2, 20)]), (NOON + 15 * HOUR, []))
            run()
    done = run()
    assert done == [("b1", "2024-01-05", 1, 2, 2, 15.0)] and late() == []
    assert run((NOON + 3 * DAY, [])) == done


def test_on_time_trips_equal_the_batch_operator(spark, stops):
    polls = [(NOON + 60 * k, [ping(f"b{k % 3}", 1 + k % 8, k - 20, f"T{k % 2}", 0 if k % 13 == 0 else 35000000), ping("b9", 99)])
             for k in range(60)]
    df = capture(spark, *polls, (NOON + DAY, [ping("b1", 1)]))
    pings = match_pings_to_stops(flatten_pings(parse_gps_payload(df)), stops)
    batch = pair_trip_endpoints(enrich_core(pings)).select("BUSNUMBER", "TRIPID", "date", "STARTTIME", "ENDTIME", "STARTSTOP", "ENDSTOP", "AVGDELAY")
    mine = S.grouped_trips(S.matched_pings(df, stops)).filter("KEPT").select(*batch.columns)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, batch.collect())) and batch.count() > 3


def test_days_are_local_days_whatever_the_session_zone(spark):
    df = spark.createDataFrame([(1704430799.0,), (1704430800.0,), (None,)], "t double")  # around midnight in Bogota
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(S.F.unix_seconds(S.local_event_time(S.F.col("t")))).collect()]
            assert got == [1704430799 - 5 * HOUR, 1704430800 - 5 * HOUR, None] and got[1] % DAY == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
