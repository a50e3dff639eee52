"""Declared schemas (no inference anywhere in the pipeline).

Fixed values: the eleven ping fields and the fourteen stop fields below, in
the order the upstream feeds deliver them.
"""

from __future__ import annotations

from pyspark.sql import types as T

PING_FIELDS = ("BUSNUMBER", "DELAY", "GPSX", "GPSY", "PARADA", "RUTA", "RUTERO",
               "STOPID", "TASKID", "TELEGRAMDATE", "TRIPID")

STOP_FIELDS = ("DECIMALLATITUDE", "DECIMALLONGITUDE", "DESCRIPTION", "LINE", "LINEID",
               "LINEVA", "LONGNAME", "ORIENTATION", "RNK", "ROWNUM", "SENTIDO",
               "SHORTNAME", "STOPCHECK", "STOPID")

PING_STRUCT = T.StructType([T.StructField(f, T.StringType(), True) for f in PING_FIELDS])
# canonical payload: array<struct<element: struct<11 strings>>>
PAYLOAD_TYPE = T.ArrayType(T.StructType([T.StructField("element", PING_STRUCT, True)]), True)
# lenient parse type: wrapped or bare elements are both accepted
PAYLOAD_PARSE_TYPE = T.ArrayType(
    T.StructType([T.StructField("element", PING_STRUCT, True)] + list(PING_STRUCT.fields)), True)

STOP_STRUCT = T.StructType([T.StructField(f, T.StringType(), True) for f in STOP_FIELDS])
STOP_LIST_TYPE = T.ArrayType(STOP_STRUCT, True)

# one landed capture per route and poll (success and error records unified)
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("ruta", T.StringType(), True),
    T.StructField("gps_data", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("error", T.StringType(), True),
])

# landed captures carry the partition columns of the landing layout
BATCH_COL = "batch"
LANDED_SNAPSHOT_SCHEMA = T.StructType(list(SNAPSHOT_SCHEMA.fields) + [
    T.StructField("capture_date", T.DateType(), True), T.StructField(BATCH_COL, T.StringType(), True)])

# stops file: one route per object; paradas kept as raw JSON, parsed later
STOPS_FILE_SCHEMA = T.StructType([
    T.StructField("ruta", T.StringType(), True),
    T.StructField("paradas", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("error", T.StringType(), True),
])

# published trips (8 columns)
TRIPS_SCHEMA = T.StructType([
    T.StructField("LINE", T.StringType(), True),
    T.StructField("DATE", T.DateType(), True),
    T.StructField("TIMEOFDAY", T.StringType(), True),
    T.StructField("RUSHHOUR", T.BooleanType(), True),
    T.StructField("ORIENTATION", T.IntegerType(), True),
    T.StructField("TRIPDURATION", T.IntegerType(), True),
    T.StructField("AVGDELAY", T.IntegerType(), True),
    T.StructField("AVGVELOCITY", T.DoubleType(), True),
])
TRIP_COLUMNS = tuple(f.name for f in TRIPS_SCHEMA.fields)
