"""Sources, sinks, crawl-output operators and the incremental stream."""

import json
import os


from pyspark.sql import functions as F

from transitlens.operators import crawl
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.operators.stops import explode_stops, stop_row_number
from transitlens.plans import fixtures
from transitlens.schemas import STOP_FIELDS
from transitlens.sources.snapshots import read_gps_snapshots, write_snapshots
from transitlens.sources.stops_json import read_stops_json
from transitlens.streaming.incremental import incremental_flatten
from tests.conftest import SF_SMALL

STOP = {"STOPID": "s1", "LINE": "L9", "ORIENTATION": 0, "ROWNUM": 3, "DECIMALLATITUDE": 3.45}


def _write(tmp_path, name, obj):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        json.dump(obj, f, indent=2)
    return p


def test_read_stops_json_three_shapes(spark, tmp_path):
    shapes = {
        "list.json": [{"ruta": "L9", "paradas": [STOP, dict(STOP, STOPID="s2", ROWNUM=4)]}],
        "object_list.json": {"ruta": "L9", "paradas": [STOP, dict(STOP, STOPID="s2", ROWNUM=4)]},
        "object_single.json": {"ruta": "L9", "paradas": STOP},
    }
    counts = {}
    for name, obj in shapes.items():
        df = explode_stops(read_stops_json(spark, _write(str(tmp_path), name, obj)))
        counts[name] = df.count()
        r = stop_row_number(df).orderBy("row_number").first()
        assert (r.STOPID, r.LINE, r.ORIENTATION, r.ROWNUM, r.row_number) == ("s1", "L9", 0, 3, 1)
    assert counts == {"list.json": 2, "object_list.json": 2, "object_single.json": 1}


def test_bare_stop_list_takes_the_same_path(spark, tmp_path):
    df = explode_stops(read_stops_json(spark, _write(str(tmp_path), "bare.json", [STOP, dict(STOP, STOPID="s2", ROWNUM=4)])))
    assert [(r.STOPID, r.row_number) for r in stop_row_number(df).orderBy("row_number").collect()] == [("s1", 1), ("s2", 2)]
    mixed = [{"ruta": "L9", "paradas": [STOP]}, dict(STOP, STOPID="s2"), {"ruta": "L0", "error": "no answer"}]
    assert explode_stops(read_stops_json(spark, _write(str(tmp_path), "mixed.json", mixed))).count() == 2


def test_route_names_in_ordinary_html(spark):
    def names(page):
        return [r.route for r in crawl.extract_route_names(spark.createDataFrame([(1, page)], "page_id long, html string"))
                .orderBy("pos").collect()]

    def table(cls, cell="<a href='/x'>T31</a>"):
        return f"<table{cls}><tr><td>{cell}</td></tr></table>"

    assert names('<TABLE CLASS="category"><TR><TD><A HREF="/x">T31</A></TD></TR></TABLE>') == ["T31"]
    assert names(table(" class=category")) == names(table(" id=r class='routes category big'")) == ["T31"]
    assert names(table(' class="sub-category"')) == names(table(' class="categoryx"')) == names(table("")) == []
    assert names(table(' data-class="category"')) == []
    assert names(table(" class=category", "<abbr>Ruta</abbr> <a href='/x'>T31</a>")) == ["T31"]
    assert names("<tableau class=category><tr><td><a>x</a></td></tr></tableau>") == []
    assert names(table(" class=category", "<a>Jard&iacute;n &amp; R&#237;o &#xe9; &amp;lt; &bogus; A&B &#0;</a>")) == \
        ["Jardín & Río é &lt; &bogus; A&B &#0;"]


def test_extract_route_names_from_listing_table(spark):
    html = ('<html><table class="category"><tr><th>Ruta</th></tr>'
            '<tr><td><a href="/r/t31">\n\t\t\t\t\t\tT31 </a></td></tr>'
            '<tr><td><a href="/r/e21"><b>E21</b></a> <a>x</a></td></tr>'
            '<tr><td><a href="/r/blank">  </a></td></tr></table></html>')
    pages = spark.createDataFrame([(1, html), (2, "<html>no table</html>")], "page_id long, html string")
    got = [(r.page_id, r.pos, r.route) for r in crawl.extract_route_names(pages).orderBy("pos").collect()]
    assert got == [(1, 2, "T31"), (1, 3, "E21")]


def test_pages_before_first_empty_and_dedupe(spark):
    df = spark.createDataFrame([("a", 0, 3), ("a", 10, 0), ("a", 20, 4), ("b", 0, 1), ("b", 10, 2)],
                               "t string, idx int, n int")
    kept = sorted((r.t, r.idx) for r in crawl.pages_before_first_empty(df, "t", "idx", "n").collect())
    assert kept == [("a", 0), ("b", 0), ("b", 10)]
    r = spark.createDataFrame([("x", 2, 1), ("y", 1, 5), ("x", 1, 9)], "route string, page int, pos int")
    d = {x.route: (x.page, x.pos) for x in crawl.dedupe_keep_first(r, "route", ["page", "pos"]).collect()}
    assert d == {"x": (1, 9), "y": (1, 5)}


def test_fetch_outcomes_null_success_is_failure(spark):
    ok = spark.createDataFrame([("A", '[{"element":{}}]', True), ("B", "[]", True)], "ruta string, gps_data string, success boolean")
    err = spark.createDataFrame([("C", "boom", False), ("D", "x", None)], "ruta string, error string, success boolean")
    u = crawl.unify_fetch_results(ok, err)
    assert set(u.columns) == {"ruta", "gps_data", "success", "error"}
    r = crawl.fetch_outcome_counts(u).first()
    assert (r.routes_with_gps, r.routes_failed, r.routes_total) == (1, 2, 4)


def test_stop_fetches_under_one_schema(spark):
    stop = "struct<STOPID:string,LINE:string>"
    ok = spark.createDataFrame([("A", [("1", "A"), ("2", "A")], 10.0), ("A", [("3", "A")], 20.0), ("A", [], 30.0), ("B", None, 5.0)],
                               f"ruta string, paradas array<{stop}>, timestamp double")
    ok = ok.withColumn("paradas", F.expr("transform(paradas, p -> named_struct(" + ", ".join(
        f"'{c}', " + (f"p.{c}" if c in ("STOPID", "LINE") else "CAST(NULL AS string)") for c in STOP_FIELDS) + "))"))
    err = spark.createDataFrame([("A", "timeout", 40), ("C", "JSON decode error", 1)], "ruta string, error string, timestamp int")
    u = crawl.stop_fetch_records(ok, err)
    assert u.columns == ["ruta", "paradas", "timestamp", "error"]
    assert sorted((r.ruta, r.timestamp, r.error, len(r.paradas)) for r in u.collect()) == [
        ("A", 10.0, None, 2), ("A", 20.0, None, 1), ("A", 30.0, None, 0), ("A", 40.0, "timeout", 0), ("B", 5.0, None, 0),
        ("C", 1.0, "JSON decode error", 0)]
    assert [(r.ruta, [p.STOPID for p in r.paradas], r.timestamp) for r in crawl.latest_stop_lists(u).collect()] == [("A", ["3"], 20.0)]


def test_landing_round_trip_and_stream_equals_batch(spark, tmp_path):
    snaps = fixtures.events_to_snapshots(fixtures.table(spark, SF_SMALL, "events"))
    src = os.path.join(str(tmp_path), "src")
    write_snapshots(snaps, src)
    batch = flatten_pings(parse_gps_payload(read_gps_snapshots(spark, src).drop("capture_date")))
    sink, ck = os.path.join(str(tmp_path), "sink"), os.path.join(str(tmp_path), "ck")
    incremental_flatten(spark, src, sink, ck).awaitTermination()
    streamed = spark.read.parquet(sink).select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # a second run finds nothing new
    n = streamed.count()
    incremental_flatten(spark, src, sink, ck).awaitTermination()
    assert spark.read.parquet(sink).count() == n
    assert n == fixtures.table(spark, SF_SMALL, "events").count()


def test_route_text_cleaning(spark):
    html = ("<table class='list category'><tr><td><a>\t&nbsp;T&amp;31\n</a></td></tr>"
            "<tr><td><a>x\n\t\t\t\t\t\ty</a></td></tr></table>"
            '<table class="categoryx"><tr><td><a>no</a></td></tr></table>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [r.route for r in crawl.extract_route_names(pages).orderBy("pos").collect()]
    assert got == ["T&31", "xy"]
