"""Stop lists from JSON files (no HTTP: the fetch is outside the engine)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.schemas import STOP_FIELDS, STOPS_FILE_SCHEMA


def read_stops_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Routes with their stop lists, from any of the published shapes.

    * a list of route objects ``[{"ruta": .., "paradas": [..]}, ..]``
    * one route object whose ``paradas`` is a list
    * one route object whose ``paradas`` is a single stop object
    * a plain list of stop objects without ``paradas``
    ``paradas`` is kept as raw JSON text (the declared schema reads nested
    values as text) and parsed by :func:`explode_stops`, which treats a single
    object as a one-stop list. A bare stop becomes the one-stop list of its
    own row, so all shapes, even mixed ones, take the same path.
    """
    known = set(STOPS_FILE_SCHEMA.fieldNames())
    schema = T.StructType([*STOPS_FILE_SCHEMA.fields, *[T.StructField(f, T.StringType()) for f in STOP_FIELDS
                                                        if f not in known]])
    rows = spark.read.schema(schema).option("multiLine", multiline).json(path)
    bare = F.to_json(F.struct(*[F.col(f) for f in STOP_FIELDS]))
    is_bare = F.col("paradas").isNull() & F.coalesce(*[F.col(f) for f in STOP_FIELDS]).isNotNull()
    return rows.withColumn("paradas", F.when(is_bare, bare).otherwise(F.col("paradas"))).select(*STOPS_FILE_SCHEMA.fieldNames())


def write_stops_json(routes: DataFrame, path: str) -> None:
    """Route rows (ruta, paradas array) as JSON lines, one route object per line
    (read back with ``multiline=False``)."""
    routes.select("ruta", "paradas").write.mode("overwrite").json(path)
