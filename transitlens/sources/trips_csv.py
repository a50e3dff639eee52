"""The published trips file (8 columns, header row)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.schemas import TRIP_COLUMNS, TRIPS_SCHEMA


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(TRIPS_SCHEMA).csv(path)


def export_trips_csv(df: DataFrame, month: str, path: str) -> str:
    """Write one month (``YYYY-MM``) of trips as header CSV under ``path/month=..``.

    Overwrite makes a re-run of the same month idempotent.
    """
    out = os.path.join(path, f"month={month}")
    (df.filter(F.date_format("DATE", "yyyy-MM") == F.lit(month)).select(*TRIP_COLUMNS)
     .write.mode("overwrite").option("header", True).csv(out))
    return out
