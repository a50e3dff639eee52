"""What follows the stream: touched dates only, and nothing twice, whatever step a run dies at."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.plans import fixtures, gold
from transitlens.sources.publish import history, manifest, read_layer, versions
from transitlens.sources.snapshots import (LEDGER, landed_batches, read_gps_snapshots, with_capture_date,
                                           write_snapshots)
from transitlens.sources.stops_json import write_stops_json
from transitlens.streaming import incremental


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def feed(spark, tmp_path):
    events = fixtures.table(spark, SF_SMALL, "events")
    stops, out, ckpt, caps = (str(tmp_path / d) for d in ("stops", "out", "ckpt", "captures"))
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events))), stops)
    snaps = with_capture_date(fixtures.events_to_snapshots(events))

    def run(**kw):
        return incremental.incremental_refresh(spark, caps, stops, out, ckpt, stops_multiline=False, **kw)

    return snaps, caps, out, run


def test_late_captures_rewrite_their_date_only(spark, feed):
    snaps, caps, out, run = feed
    two = snaps.filter("capture_date IN ('2024-01-05', '2024-01-06')")
    late = (F.col("capture_date") == "2024-01-05") & (F.pmod(F.xxhash64("ruta", "timestamp"), F.lit(2)) == 0)
    assert two.filter(late).count() and two.filter(~late & (F.col("capture_date") == "2024-01-05")).count()
    write_snapshots(two.filter(~late), caps)
    assert run()["dates"] == ["2024-01-05", "2024-01-06"]
    assert run() is None and versions(spark, out) == [1]
    write_snapshots(two.filter(late), caps)
    assert run(max_files_per_trigger=1)["dates"] == ["2024-01-05"]
    assert [(v, d) for v, d, _ in history(spark, out, "silver_gps_flat")] == [(1, "2024-01-05"), (1, "2024-01-06"), (2, "2024-01-05")]
    flat = flatten_pings(parse_gps_payload(two))
    # the stops of the published layers are those of all dates
    s = gold.build_silver(flat, read_layer(spark, out, "silver_stops_routes"))
    for name, expected in (("gold_trips_final", gold.gold_trips_final(s)), ("gold_route_segment_speed", gold.gold_route_segment_speed(s))):
        assert _rows(read_layer(spark, out, name).select(*expected.columns)) == _rows(expected)


class Killed(BaseException):
    pass


@pytest.mark.parametrize("step", ["ledger", "after_ledger", "refresh", "after_publish"])
def test_a_repeat_after_a_failure_changes_nothing_else(spark, feed, monkeypatch, step):
    snaps, caps, out, run = feed
    write_snapshots(snaps.filter("capture_date = '2024-01-05'"), caps)

    def dies(*a, **k):
        raise (RuntimeError if "ledger" in step else Killed)("gone")

    note, refresh = incremental.note_touched_dates, incremental.refresh
    with monkeypatch.context() as m:
        if step == "ledger":
            m.setattr(incremental, "note_touched_dates", dies)
        elif step == "after_ledger":  # the batch is noted, the stream's checkpoint is not written
            m.setattr(incremental, "note_touched_dates", lambda *a: (note(*a), dies()))
        elif step == "refresh":
            m.setattr(incremental, "refresh", dies)
        else:
            m.setattr(incremental, "refresh", lambda *a, **k: (refresh(*a, **k), dies()))
        with pytest.raises(BaseException, match="gone"):
            run()
    again = run()
    if step == "after_publish":
        assert again is None
    else:
        assert again["dates"] == ["2024-01-05"]
    assert versions(spark, out) == [1] and len(manifest(spark, out).applied) == 1
    assert read_layer(spark, out, "silver_gps_flat").count() == flatten_pings(
        parse_gps_payload(snaps.filter("capture_date = '2024-01-05'"))).count()
    assert run() is None


def test_a_replayed_batch_is_landed_once_and_a_half_landed_one_is_finished(spark, feed, monkeypatch):
    snaps, caps, _, _ = feed
    two = snaps.filter("capture_date IN ('2024-01-05', '2024-01-06')")
    n = two.count()
    assert write_snapshots(two, caps, batch_id="load-1") and not write_snapshots(two, caps, batch_id="load-1")
    assert landed_batches(spark, caps) == ["load-1"] and read_gps_snapshots(spark, caps).count() == n

    from transitlens.sources import snapshots as S
    real, done = S.rename_new, []

    def dies(s, source, target):
        if done:
            raise Killed
        done.append(target)
        return real(s, source, target)

    with monkeypatch.context() as m:
        m.setattr(S, "rename_new", dies)
        with pytest.raises(Killed):
            write_snapshots(two, caps, batch_id="load-2")
    files = set(read_gps_snapshots(spark, caps).inputFiles())
    assert landed_batches(spark, caps) == ["load-1"] and n < read_gps_snapshots(spark, caps).count() < 2 * n
    assert write_snapshots(two, caps, batch_id="load-2") and read_gps_snapshots(spark, caps).count() == 2 * n
    assert files < set(read_gps_snapshots(spark, caps).inputFiles())  # what a stream may have read stays as it is
    assert {r[0] for r in read_gps_snapshots(spark, caps, with_batch=True).select("batch").distinct().collect()} == {"load-1", "load-2"}
    assert not [f for f in os.listdir(caps) if f.startswith("_") and f != LEDGER]
    with pytest.raises(ValueError):
        write_snapshots(two, caps, batch_id="../x")


def test_the_declared_schema_is_read_whatever_the_first_file_holds(spark, tmp_path):
    path = str(tmp_path / "c")
    ok = spark.createDataFrame([("R1", "[]", 1704448800.0, True)], "ruta string, gps_data string, timestamp double, success boolean")
    bad = spark.createDataFrame([("R2", None, 1704448800.0, False, "timeout")],
                                "ruta string, gps_data string, timestamp double, success boolean, error string")
    write_snapshots(ok, path, batch_id="a")
    write_snapshots(bad, path, batch_id="b")
    got = {r["ruta"]: r["error"] for r in read_gps_snapshots(spark, path).collect()}
    assert got == {"R1": None, "R2": "timeout"}
