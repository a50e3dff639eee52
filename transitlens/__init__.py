"""transitlens: Spark-native operators for public-transport position data.

Every operator is a pure function ``DataFrame -> DataFrame`` (or a ``Column``
builder) written with built-in Spark SQL expressions, so Catalyst can prune,
push down and plan the whole pipeline as one job.

Where to start:
    plans.refresh.refresh(...)            daily run: captures + stops file -> all tables
    plans.gold.build_silver / gold_*      the same layers composed in memory
    operators.payload / stops / enrich / trips / segments / quality
    operators.profile, operators.quantiles   the profiling report (exact quartiles)
    operators.crawl                       route listings and fetch results as tables
    streaming.incremental.incremental_flatten
    config.build_session
"""

__version__ = "0.1.0"
