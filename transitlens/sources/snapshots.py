"""Landed capture snapshots: Parquet by capture date and batch.

    path/capture_date=<date>/batch=<id>/part-*.parquet
    path/_batches/<id>                                    the batch has landed whole

A batch is written to a hidden folder, its dates are renamed into place one by
one, and its name goes into the ledger last. A batch of that name is then
skipped. Where landing died half-way, the repeat adds the dates that are
missing; those already in place were complete, and a stream may have read them.
"""

from __future__ import annotations

import datetime
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.config import LOCAL_TZ, file_system
from transitlens.functions.timefn import epoch_to_local_time
from transitlens.schemas import BATCH_COL, LANDED_SNAPSHOT_SCHEMA
from transitlens.sources.publish import delete, gathered, rename_new, write_text

PARTITION_COL = "capture_date"
LEDGER = "_batches"


def read_gps_snapshots(spark: SparkSession, path: str, with_batch: bool = False) -> DataFrame:
    """Scan of the landed captures in their declared schema; partition filters on ``capture_date`` prune files."""
    found = spark.read.schema(LANDED_SNAPSHOT_SCHEMA).option("basePath", path).parquet(path)
    return found if with_batch else found.drop(BATCH_COL)


def with_capture_date(df: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """The local date of the capture time, where the captures don't name one."""
    if PARTITION_COL in df.columns:
        return df
    return df.withColumn(PARTITION_COL, F.to_date(epoch_to_local_time(F.col("timestamp"), tz)))


def new_batch_id() -> str:
    """The load time in UTC, made unique."""
    return f"{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def landed_batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that have landed whole."""
    fs, p = file_system(spark, os.path.join(path, LEDGER))
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if not n.startswith("."))


def write_snapshots(df: DataFrame, path: str, batch_id: str | None = None, tz: str = LOCAL_TZ) -> bool:
    """Land a batch of captures; False, with nothing written, if a batch of that name has landed before.

    Give the batch a name of its own (a load time, a source file) if it may be
    repeated; without one it is named by the load time and lands every time.
    """
    spark = df.sparkSession
    name = batch_id or new_batch_id()
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
        raise ValueError(f"not a batch name: {name!r}")
    fs, entry = file_system(spark, os.path.join(path, LEDGER, name))
    if fs.exists(entry):
        return False
    staging = os.path.join(path, f"_staging-{uuid.uuid4().hex}")
    try:
        gathered(with_capture_date(df, tz), PARTITION_COL).write.partitionBy(PARTITION_COL).parquet(staging)
        for found in fs.listStatus(file_system(spark, staging)[1]):
            date = found.getPath().getName()
            if date.startswith(f"{PARTITION_COL}="):
                folder = os.path.join(path, date)
                fs.mkdirs(file_system(spark, folder)[1])
                rename_new(spark, os.path.join(staging, date), os.path.join(folder, f"{BATCH_COL}={name}"))
        write_text(spark, os.path.join(path, LEDGER, name), "")
    finally:
        delete(spark, staging)
    return True
