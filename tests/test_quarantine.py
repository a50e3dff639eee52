"""Nothing vanishes unnoticed: rows in are rows parsed plus rows set aside."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from transitlens.operators import quarantine as Q
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.plans import fixtures
from transitlens.plans.refresh import refresh
from transitlens.sources import publish as P
from transitlens.sources.snapshots import write_snapshots
from transitlens.sources.stops_json import write_stops_json

CASES = {  # payload -> (elements parsed, reasons set aside)
    None: (0, ["no_payload"]), "": (0, ["empty_text"]), " \t": (0, None), "  ": (0, ["empty_text"]), "null": (0, ["null_text"]),
    " null ": (0, ["null_text"]), "[": (0, ["malformed_json"]), '[{"element":{"RUTA":"A"}}': (0, ["malformed_json"]), "{oops}": (0, ["malformed_json"]),
    "42": (0, ["not_pings"]), '"text"': (0, ["not_pings"]), "[]": (0, []), '[{"element":{"RUTA":"A"}}]': (1, []), '[{"RUTA":"A"},{"DELAY":"x"}]': (2, []),
    '{"RUTA":"A"}': (1, []), '{"element":{"RUTA":"A"}}': (1, []), '[null,{"RUTA":"A"}]': (1, ["empty_element"]),
    '[{},{"element":{}},{"element":null},{"RUTA":"A"},{"OTHER":"x"}]': (1, ["empty_element"] * 4),
}


def test_every_payload_is_parsed_or_set_aside(spark):
    payloads = [p for p in CASES if p != " \t"]
    df = spark.createDataFrame([(i, p, 1704448800.0) for i, p in enumerate(payloads)], "i int, gps_data string, timestamp double")
    out = Q.parse_with_quarantine(df)
    assert out.columns == [*df.columns, "gps_data_parsed", "quarantined"]
    for r in out.collect():
        n, reasons = CASES[payloads[r["i"]]]
        assert (len(r["gps_data_parsed"] or []), [q["reason"] for q in r["quarantined"]]) == (n, reasons), payloads[r["i"]]
        assert (r["gps_data_parsed"] is None) == any(q["pos"] is None for q in r["quarantined"])
    # the pings are those of the plain path, but for the empty ones
    keys = ["RUTA", "DELAY", "BUSNUMBER"]
    plain = flatten_pings(parse_gps_payload(df)).select(*keys, "TASKID", "GPSX").filter("RUTA IS NOT NULL OR DELAY IS NOT NULL")
    assert sorted(map(repr, flatten_pings(out).select(*plain.columns).filter("RUTA IS NOT NULL").collect())) == sorted(map(repr, plain.collect()))
    report = {(r["unit"], r["reason"]): r["n"] for r in Q.quarantine_report(out).collect()}
    assert sum(n for (unit, _), n in report.items() if unit == "capture") == len(payloads)
    assert report["element", "empty_element"] == 5
    rows = Q.quarantine_table(out, "i").collect()
    assert len(rows) == sum(len(CASES[p][1]) for p in payloads)


@pytest.mark.parametrize("make, n, reasons", [
    (lambda s: s.createDataFrame([(1.0,)], "timestamp double"), 0, ["no_payload"]),
    (lambda s: s.createDataFrame([(5, 1.0)], "gps_data int, timestamp double"), 0, ["not_pings"]),
    (lambda s: s.sql("SELECT named_struct('RUTA', 'A') AS gps_data, 1.0D AS timestamp"), 1, []),
    (lambda s: s.sql("SELECT named_struct('element', named_struct('RUTA', 'A')) AS gps_data, 1.0D AS timestamp"), 1, []),
    (lambda s: s.sql("SELECT map('RUTA', 'A') AS gps_data, 1.0D AS timestamp"), 1, []),
    (lambda s: s.sql("SELECT array(named_struct('RUTA', 'A'), NULL) AS gps_data, 1.0D AS timestamp"), 1, ["empty_element"]),
    (lambda s: s.sql("SELECT CAST(NULL AS array<struct<RUTA:string>>) AS gps_data, 1.0D AS timestamp"), 0, ["no_payload"]),
])
def test_payload_columns_of_other_types(spark, make, n, reasons):
    r = Q.parse_with_quarantine(make(spark)).first()
    assert (len(r["gps_data_parsed"] or []), [q["reason"] for q in r["quarantined"]]) == (n, reasons)
    assert flatten_pings(Q.parse_with_quarantine(make(spark))).count() == n


def test_refresh_sets_captures_aside_and_keeps_the_metrics_of_all_runs(spark, tmp_path):
    events = fixtures.table(spark, SF_SMALL, "events")
    caps, stops, out = (str(tmp_path / d) for d in ("captures", "stops", "out"))
    snaps = fixtures.events_to_snapshots(events)
    write_stops_json(fixtures.route_stop_lists(fixtures.stops_from_pings(fixtures.events_to_pings(events))), stops)
    write_snapshots(snaps.filter("timestamp < 1704603600"), caps)
    write_snapshots(fixtures.with_broken_payloads(snaps.filter("timestamp >= 1704603600")), caps)
    first = refresh(spark, caps, stops, out, capture_dates=["2024-01-05"], stops_multiline=False)
    assert first["expectations"]["valid_gps_array_failed"] == 0 and P.read_layer(spark, out, "quarantine").count() == 0
    refresh(spark, caps, stops, out, capture_dates=["2024-01-08"], stops_multiline=False)
    aside = P.read_layer(spark, out, "quarantine")
    bronze = P.read_layer(spark, out, "bronze_gps_raw")
    assert bronze.filter("gps_data_parsed IS NULL").count() == aside.filter("pos IS NULL").count() > 0
    assert {r[0] for r in aside.select("capture_date").distinct().collect()} == {r[0] for r in aside.select(F.to_date(F.lit("2024-01-08"))).distinct().collect()}
    P.remove_old_versions(spark, out, keep=1, min_age_hours=-1)
    metrics = P.all_metrics(spark, out)
    assert list(metrics) == [1, 2] and metrics[1] == first["expectations"]
    changes = {(r["version"], r["rule"]): r for r in Q.metric_changes(Q.metric_history(spark, metrics)).collect()}
    assert changes[2, "valid_gps_array"]["alert"] and not changes[1, "valid_gps_array"]["alert"]
    assert not changes[2, "gps_has_timestamp"]["alert"] and changes[1, "valid_gps_array"]["usual_share"] is None
