"""Properties: grouped pairing equals the pings ranked first and last; input layout does not matter."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import PING_SCHEMA
from tests.test_slicing import _random_pings, _stops
from transitlens.config import TRIP_KEYS
from transitlens.operators.enrich import enrich_core, match_pings_to_stops, running_avg_velocity
from transitlens.operators.trips import pair_trip_endpoints
from transitlens.plans import fixtures, gold
from tests.conftest import SF_SMALL


def _ranked_pairs(enriched):
    """Trips from numbered pings: the first and the last of a trip, if both pass the drop rule (test oracle only)."""
    trip = Window.partitionBy(*TRIP_KEYS)
    order = [F.col(c).asc_nulls_first() for c in ("timestamp", "row_number", "ping_seq")]
    ranked = (enriched.withColumn("nth", F.row_number().over(trip.orderBy(*order))).withColumn("of_n", F.count("*").over(trip))
              .filter("GPSY > 1"))
    start = ranked.filter("nth = 1").selectExpr(*TRIP_KEYS, "timestamp AS STARTTIME", "row_number AS STARTSTOP",
                                                "next_time AS START_next_time")
    end = ranked.filter("nth = of_n").selectExpr(*TRIP_KEYS, "timestamp AS ENDTIME", "row_number AS ENDSTOP",
                                                 "prev_time AS END_prev_time", "AVGDELAY", "AVGVELOCITY")
    return start.join(end, list(TRIP_KEYS)).withColumnRenamed("RUTA", "LINE")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_grouped_pairing_equals_ranked_pings(spark, seed):
    pings = spark.createDataFrame(_random_pings(seed, 800, bad=0.1), PING_SCHEMA)
    core = enrich_core(match_pings_to_stops(pings, _stops(spark)))
    grouped = pair_trip_endpoints(core)
    joined = _ranked_pairs(running_avg_velocity(core))
    assert _rows(grouped.select(*joined.columns)) == _rows(joined)
    assert grouped.count() > 10


def test_input_layout_does_not_change_results(spark):
    events = fixtures.table(spark, SF_SMALL, "events")
    base = _rows(gold.gold_trips_final(gold.silver_from_sf(spark, SF_SMALL)))
    for layout in (events.repartition(1), events.repartition(13).orderBy(F.rand(7)),
                   events.orderBy(F.desc("event_id")).coalesce(3)):
        pings = fixtures.events_to_pings(layout)
        s = gold.build_silver(pings, fixtures.fixture_stops(pings))
        assert _rows(gold.gold_trips_final(s)) == base


def test_shuffle_partition_count_does_not_change_results(spark):
    base = _rows(gold.gold_route_segment_speed(gold.silver_from_sf(spark, SF_SMALL)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert _rows(gold.gold_route_segment_speed(gold.silver_from_sf(spark, SF_SMALL))) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
