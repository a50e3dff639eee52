"""Plan-shape checks: what reaches the shuffle, what is broadcast, what is pushed down.

Run with AQE off and automatic broadcasting disabled, so the plans are the
ones a large input would get (only explicitly size-checked sides broadcast).
"""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from transitlens.operators import profile
from transitlens.operators.dimension import bounded_broadcast
from transitlens.plans import fixtures, gold


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _raw_exchanges(plan) -> int:
    """Shuffle exchanges whose input contains no aggregation (they move raw rows)."""
    def has_agg(n):
        name = n.nodeName()
        if "Aggregate" in name:
            return True
        return any(has_agg(c) for c in _children(n))

    def walk(n):
        own = 1 if n.nodeName() == "Exchange" and "hashpartitioning" in n.toString() and not has_agg(n) else 0
        if "ReusedExchange" in n.nodeName():
            return 0
        return own + sum(walk(c) for c in _children(n))
    return walk(plan)


@pytest.fixture
def large_plan_conf(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan()


@pytest.mark.parametrize("output", ["trips", "segments", "candidates"])
def test_pipeline_shuffles_raw_pings_once(spark, large_plan_conf, output):
    s = gold.silver_from_sf(spark, SF_SMALL)
    df = {"trips": gold.gold_trips_final, "segments": gold.gold_route_segment_speed,
          "candidates": gold.gold_trips_candidates}[output](s)
    plan = _plan(df)
    assert _raw_exchanges(plan) == 1, plan.toString()
    txt = plan.toString()
    assert "BroadcastHashJoin [STOPID" in txt  # checked stop dimension is broadcast
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_oversized_dimension_is_not_broadcast(spark, large_plan_conf):
    pings = fixtures.events_to_pings(fixtures.table(spark, SF_SMALL, "events"))
    stops, n = bounded_broadcast(fixtures.fixture_stops(pings), max_rows=5)
    assert n > 5
    s = gold.build_silver(pings, fixtures.fixture_stops(pings), broadcast_rows=5)
    txt = _plan(gold.gold_trips_final(s)).toString()
    assert "BroadcastHashJoin [STOPID" not in txt and "SortMergeJoin [STOPID" in txt
    assert gold.gold_trips_final(s).count() == gold.gold_trips_final(gold.silver_from_sf(spark, SF_SMALL)).count()


def test_scan_prunes_columns_and_pushes_filters(spark):
    li = fixtures.table(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") > 10)
    txt = li.select("l_orderkey", "l_quantity")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in txt
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in txt


def test_topk_does_not_sort_everything(spark):
    df = profile.value_counts_topk(fixtures.table(spark, SF_SMALL, "orders"), "o_custkey", 10)
    assert "TakeOrderedAndProject" in _plan(df).toString()


def test_landing_partition_pruning(spark, tmp_path):
    from transitlens.sources.snapshots import read_gps_snapshots, write_snapshots
    snaps = fixtures.events_to_snapshots(fixtures.table(spark, SF_SMALL, "events"))
    write_snapshots(snaps, str(tmp_path))
    df = read_gps_snapshots(spark, str(tmp_path)).filter(F.col("capture_date") == F.lit("2024-01-05").cast("date"))
    txt = _plan(df).toString()
    assert "PartitionFilters: [isnotnull(capture_date" in txt
    assert df.count() > 0


def test_enriched_table_reads_its_core_without_a_raw_shuffle(spark, large_plan_conf):
    s = gold.silver_from_sf(spark, SF_SMALL)
    assert _raw_exchanges(_plan(s.core)) == 1
    enriched = gold.silver_gps_enriched(s)
    assert _raw_exchanges(_plan(enriched)) == 0  # the one raw exchange wrote the core
    assert enriched.count() == gold.silver_gps_enriched(s, running_velocity=False).count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("transitlens_core")]


@pytest.mark.parametrize("partitions, limit, buckets", [("8", "100000", 8), ("400000", "16", 16)])
def test_bucketed_core_needs_no_raw_shuffle(spark, large_plan_conf, tmp_path, partitions, limit, buckets):
    """Also at settings whose shuffle partitions exceed Spark's bucket limit."""
    from transitlens.operators.enrich import running_avg_velocity
    from transitlens.sources.bucketed import write_bucketed
    s = gold.silver_from_sf(spark, SF_SMALL)
    table = "core_plan_test"
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.sources.bucketing.maxBuckets")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", limit)
        core = write_bucketed(spark, str(tmp_path / "core"), table, lambda: s.core)
        assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
        spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert described["Num Buckets"] == str(buckets)
        df = running_avg_velocity(core)
        plan = _plan(df)
        assert _raw_exchanges(plan) == 0, plan.toString()  # only per-slice sums move
        assert df.count() == s.core.count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        for k, v in old.items():
            spark.conf.set(k, v)
