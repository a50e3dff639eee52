from datetime import datetime

from pyspark.sql import types as T

PING_SCHEMA = T.StructType([
    T.StructField("BUSNUMBER", T.StringType()), T.StructField("DELAY", T.IntegerType()),
    T.StructField("RUTA", T.StringType()), T.StructField("STOPID", T.StringType()),
    T.StructField("TRIPID", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("GPSX", T.DoubleType()), T.StructField("GPSY", T.DoubleType()),
    T.StructField("ping_seq", T.LongType()), T.StructField("date", T.DateType()),
])

STOP_SCHEMA = "STOPID string, LINE string, ORIENTATION int, ROWNUM int, row_number int"


def ping(bus, route, stop, trip, ts, lat, lon, delay=0, seq=0):
    return (bus, delay, route, stop, trip, ts, lon, lat, seq, ts.date())


def t(h, m=0, s=0, day=1):
    return datetime(2024, 1, day, h, m, s)


def stops_df(spark, rows):
    return spark.createDataFrame(rows, STOP_SCHEMA)


def line_stops(spark, line="A", n=5, orientation=0):
    return stops_df(spark, [(str(i), line, orientation, i, i) for i in range(1, n + 1)])
