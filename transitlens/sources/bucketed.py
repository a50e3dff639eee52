"""The enrichment core as a bucketed table.

The core leaves its window exchange hash-partitioned on (trip key stand-ins,
slice). Written in buckets of exactly these columns and read back, it is joined
to per-slice sums without another shuffle of the pings.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from transitlens.config import scratch_path
from transitlens.operators.enrich import SLICE_COLUMNS

#: more buckets would only make small files
MAX_BUCKETS = 20_000


def write_bucketed(spark: SparkSession, path: str, table: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build and write the core to ``path`` as the external table ``table``; return it as read back.

    The exchange is planned with as many partitions as there are buckets, so
    each task writes its own buckets (no second shuffle); the number follows
    the session but stays within Spark's bucket limit. There is a file for each
    bucket; by date as well there would be one for each bucket of every date.
    """
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    n = min(int(wanted), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")), MAX_BUCKETS)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        core = build()
        part = [c for c in core.columns if re.fullmatch(r"_k(\d+|n)", c)] + SLICE_COLUMNS
        core.write.mode("overwrite").option("path", path).bucketBy(n, *part).sortBy(*part).saveAsTable(table)
        return spark.table(table).select(*core.columns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", wanted)


def stored_core(core: DataFrame) -> DataFrame:
    """The core written once to the session's scratch folder, for readers that need it more than once.

    The catalog entry is dropped at once: the returned plan reads the files.
    """
    spark = core.sparkSession
    table = f"transitlens_core_{uuid.uuid4().hex[:12]}"
    try:
        return write_bucketed(spark, scratch_path(spark, "core"), table, lambda: core)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
