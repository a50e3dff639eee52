"""The daily refresh over landed captures and a stops file publishes the same
tables as the in-memory composition."""

import os

import pytest
from pyspark.sql import functions as F

from transitlens.config import scratch_path
from transitlens.operators.enrich import ENRICHED_COLUMNS
from transitlens.operators.payload import flatten_pings, parse_gps_payload
import transitlens.plans.refresh as R
from transitlens.plans import fixtures, gold
from transitlens.plans.refresh import DATED, refresh
from transitlens.sources.publish import MANIFESTS, manifest, read_layer, versions
from transitlens.sources.snapshots import read_gps_snapshots, write_snapshots
from transitlens.sources.stops_json import write_stops_json
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_refresh_publishes_all_layers(spark, tmp_path):
    events = fixtures.table(spark, SF_SMALL, "events")
    caps, stops_file, out = (os.path.join(str(tmp_path), d) for d in ("captures", "stops", "out"))
    write_snapshots(fixtures.events_to_snapshots(events), caps)
    pings = fixtures.events_to_pings(events)
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(pings)), stops_file)

    res = refresh(spark, caps, stops_file, out, stops_multiline=False)
    t = {n: read_layer(spark, out, n) for n in res["tables"]}
    assert sorted(os.listdir(out)) == sorted([*res["tables"], MANIFESTS])

    flat = flatten_pings(parse_gps_payload(fixtures.events_to_snapshots(events)))
    s = gold.build_silver(flat, fixtures.fixture_stops(flat))
    for name, expected in (("gold_trips_final", gold.gold_trips_final(s)),
                           ("gold_route_segment_speed", gold.gold_route_segment_speed(s))):
        assert _rows(t[name].select(*expected.columns)) == _rows(expected)
    assert _rows(t["silver_gps_enriched"].select(*ENRICHED_COLUMNS)) == \
        _rows(gold.silver_gps_enriched(s).select(*ENRICHED_COLUMNS))

    m = res["expectations"]
    n_flat = t["silver_gps_flat"].count()
    assert m["gps_has_timestamp_passed"] == n_flat == events.count()
    assert m["gpsy_positive_passed"] + m["gpsy_positive_failed"] == t["silver_gps_enriched_core"].count()
    assert m["gpsy_positive_passed"] == t["silver_gps_enriched"].count()
    assert m["valid_trip_duration_failed"] == 0
    assert m["bronze_has_gps_data_parsed_passed"] == m["bronze_rows"] == t["bronze_gps_raw"].count()
    assert m["flat_rows"] == n_flat and m["trips_rows"] == t["gold_trips_final"].count()
    assert m["gps_has_timestamp_failed"] == m["valid_gps_array_failed"] == 0


def _inputs(spark, tmp_path):
    events = fixtures.table(spark, SF_SMALL, "events")
    caps, stops_file, out = (os.path.join(str(tmp_path), d) for d in ("captures", "stops", "out"))
    write_snapshots(fixtures.events_to_snapshots(events), caps)
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events))),
                     stops_file)
    return caps, stops_file, out


def _published(spark, out):
    names = manifest(spark, out).layers
    return {n: sorted(map(repr, read_layer(spark, out, n).drop("ingest_time").collect())) for n in names}


def test_each_run_replaces_its_own_dates_only(spark, tmp_path):
    caps, stops_file, out = _inputs(spark, tmp_path)

    def run(*dates):
        return refresh(spark, caps, stops_file, out, capture_dates=list(dates), stops_multiline=False)

    def dates(name, column="date"):
        return {str(r[0]) for r in read_layer(spark, out, name).select(column).distinct().collect()}

    run("2024-01-05")
    first = _published(spark, out)
    assert dates("silver_gps_flat") == {"2024-01-05"}
    run("2024-01-06")
    assert dates("silver_gps_flat") == dates("bronze_gps_raw", "capture_date") == {"2024-01-05", "2024-01-06"}
    both = _published(spark, out)
    for name in ("silver_gps_flat", "silver_gps_enriched", "gold_trips_candidates", "gold_route_segment_speed"):
        assert set(first[name]) <= set(both[name]), name
    run("2024-01-05")
    assert _published(spark, out) == both
    run("1999-01-01")  # a date without captures changes nothing
    assert _published(spark, out) == both
    files = read_layer(spark, out, "silver_gps_flat", dates=["2024-01-06"]).inputFiles()
    assert files and all("date=2024-01-06" in f for f in files)


def test_pings_without_a_date_have_a_run_of_their_own(spark, tmp_path):
    caps, stops_file, out = _inputs(spark, tmp_path)
    one = read_gps_snapshots(spark, caps).drop("capture_date").limit(1).withColumn("timestamp", F.lit(None).cast("double"))
    write_snapshots(spark.createDataFrame(one.collect(), one.schema), caps)
    args = {"stops_multiline": False}
    refresh(spark, caps, stops_file, out, capture_dates=["2024-01-05", None], **args)
    undated = read_layer(spark, out, "silver_gps_flat", dates=[None]).count()
    assert undated == read_layer(spark, out, "silver_gps_flat").filter("date IS NULL").count() > 0
    refresh(spark, caps, stops_file, out, capture_dates=["2024-01-05"], **args)
    assert read_layer(spark, out, "silver_gps_flat", dates=[None]).count() == undated


def test_a_run_must_not_replace_dates_that_it_read_in_part(spark, tmp_path):
    caps, stops_file, out = _inputs(spark, tmp_path)
    wrong = read_gps_snapshots(spark, caps).filter("capture_date = '2024-01-06'").withColumn("capture_date", F.lit("2024-01-05").cast("date"))
    write_snapshots(wrong, caps)
    with pytest.raises(ValueError, match="2024-01-06"):
        refresh(spark, caps, stops_file, out, capture_dates=["2024-01-05"], stops_multiline=False)
    assert versions(spark, out) == [] and not os.listdir(os.path.join(out, "silver_gps_flat"))


def test_a_failed_run_leaves_the_published_tables(spark, tmp_path):
    caps, stops_file, out = _inputs(spark, tmp_path)
    refresh(spark, caps, stops_file, out, capture_dates=["2024-01-05"], stops_multiline=False)
    before = _published(spark, out)
    empty = tmp_path / "empty.json"
    empty.write_text("[]")
    with pytest.raises(ValueError, match="no stops"):
        refresh(spark, caps, str(empty), out)
    assert _published(spark, out) == before and versions(spark, out) == [1]
    assert all(len([f for f in os.listdir(os.path.join(out, n)) if not f.startswith(".")]) == 1 for n in before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("transitlens_core")]


def test_a_layer_by_date_has_a_file_for_each_date_not_for_each_task_or_bucket(spark, tmp_path):
    events = fixtures.table(spark, SF_SMALL, "events").repartition(7)
    caps, stops_file, out = (os.path.join(str(tmp_path), d) for d in ("captures", "stops", "out"))
    snaps = fixtures.events_to_snapshots(events)
    write_snapshots(spark.createDataFrame(snaps.collect(), snaps.schema).repartition(7), caps)
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events))), stops_file)
    landed = read_gps_snapshots(spark, caps)
    assert len(landed.inputFiles()) == landed.select("capture_date").distinct().count() > 7
    refresh(spark, caps, stops_file, out, stops_multiline=False)
    m = manifest(spark, out)
    for name in DATED:
        assert len(read_layer(spark, out, name).inputFiles()) == len(m.layers[name].parts), name
    assert len(m.layers["silver_gps_enriched_core"].parts) > 7


def test_a_run_leaves_no_core_in_the_scratch_folder(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(R, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    caps, stops_file, out = _inputs(spark, tmp_path)
    refresh(spark, caps, stops_file, out, capture_dates=["2024-01-05"], stops_multiline=False)
    assert len(made) == 1 and not os.path.exists(made[0].removeprefix("file:"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("transitlens_core")]
    assert read_layer(spark, out, "silver_gps_enriched_core").count() > 0
