"""The two-level (time-sliced) window equals one ordered window per trip,
also when hot slices are split further by exact timestamp."""

import random
from datetime import datetime, timedelta

import pytest

from tests.helpers import PING_SCHEMA, stops_df
from transitlens.operators.enrich import enrich_core, match_pings_to_stops, public_columns, running_avg_velocity
from transitlens.operators.segments import route_segment_speed
from transitlens.operators.trips import trip_candidates


def _random_pings(seed, n=600, bad=0.5):
    rnd = random.Random(seed)
    rows = []
    base = datetime(2024, 1, 1, 5)
    for i in range(n):
        bus = str(rnd.randint(0, 2))
        ts = base + timedelta(seconds=rnd.choice([0, 30, 60]) * rnd.randint(0, 400))  # many ties
        y = rnd.choice([None, 0.5]) if rnd.random() < bad else 4.0 + rnd.random() / 100
        rows.append((bus, rnd.randint(-300, 300) if rnd.random() > 0.1 else None, rnd.choice(["A", "B"]),
                     str(rnd.randint(0, 7)), str(rnd.randint(0, 1)), ts, -76.5 + rnd.random() / 100, y,
                     i, ts.date()))
    return rows


def _stops(spark):
    rows = []
    for line in "AB":
        for s in range(0, 7):
            for o in ((0,) if s < 4 else (0, 1) if s == 4 else (1,)):
                rows.append((str(s), line, o, s, 0))
    df = stops_df(spark, rows)
    from transitlens.operators.stops import stop_row_number
    return stop_row_number(df)


@pytest.mark.parametrize("seed", [1, 2])
def test_sliced_equals_single_window(spark, seed):
    pings = spark.createDataFrame(_random_pings(seed), PING_SCHEMA)
    joined = match_pings_to_stops(pings, _stops(spark))
    cols = None
    results = []
    for width, hot in ((60, None), (300, 2), (900, 1), (10 ** 9, None)):
        core = enrich_core(joined, slice_seconds=width, hot_rows=hot)
        full = public_columns(running_avg_velocity(core))
        cols = cols or sorted(full.columns)
        rows = sorted((tuple(r) for r in full.select(*cols).collect()), key=repr)
        trips = sorted((tuple(r) for r in trip_candidates(core).collect()), key=repr)
        seg = sorted((tuple(r) for r in route_segment_speed(core).collect()), key=repr)
        results.append((rows, trips, seg))
    # plain slices, slices split by exact timestamp when hot, one window per trip: all equal
    for r in results[:-1]:
        assert r == results[-1]
    assert len(results[0][0]) > 500


def test_hot_slice_marking_same_with_broadcast_or_shuffle(spark):
    from pyspark.sql import functions as F
    from transitlens.operators.enrich import _key_columns, _split_hot_slices
    pings = spark.createDataFrame(_random_pings(9, 500), PING_SCHEMA)
    base = pings.withColumn("_slice", F.floor(F.unix_timestamp("timestamp") / 300))
    base, kcols = _key_columns(base, ["BUSNUMBER", "RUTA", "TRIPID", "date"])
    small = _split_hot_slices(base, kcols, "timestamp", hot_rows=3, max_hot=10 ** 6)
    large = _split_hot_slices(base, kcols, "timestamp", hot_rows=3, max_hot=1)
    none = _split_hot_slices(base, kcols, "timestamp", hot_rows=10 ** 9)
    cols = ["ping_seq", "_sub"]
    a = sorted(tuple(r) for r in small.select(*cols).collect())
    assert a == sorted(tuple(r) for r in large.select(*cols).collect())
    assert sum(1 for r in a if r[1].year > 1970) > 0  # some slices were split
    assert all(r._sub.year == 1970 for r in none.select("_sub").collect())


def test_pings_without_a_time_are_split_by_position(spark):
    rnd = random.Random(4)
    rows = [(bus, delay, line, stop, trip, None if rnd.random() < 0.5 else ts, x, y, i, None if rnd.random() < 0.5 else d)
            for bus, delay, line, stop, trip, ts, x, y, i, d in _random_pings(5, 300)]
    rows = [r[:9] + (None,) if r[5] is None else r for r in rows]
    joined = match_pings_to_stops(spark.createDataFrame(rows, PING_SCHEMA), _stops(spark))
    whole = enrich_core(joined, slice_seconds=10 ** 9, hot_rows=None)
    split = enrich_core(joined, slice_seconds=300, hot_rows=1)
    frames = [public_columns(running_avg_velocity(c)) for c in (whole, split)]
    a, b = (sorted((tuple(r) for r in f.select(*sorted(f.columns)).collect()), key=repr) for f in frames)
    assert a == b
    parts = split.where("timestamp IS NULL").groupBy("_k0", "_k1", "_k2", "_k3", "_k4", "_kn", "_slice", "_sub").count()
    assert parts.agg({"count": "max"}).first()[0] <= 2
