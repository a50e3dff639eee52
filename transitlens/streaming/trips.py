"""Trip pairs on a stream: each trip once, when the watermark passes its day.

The batch operator groups pings by trip key, and the date is one of the keys,
so a trip can grow until its day is over. On the stream, event time is the local
time of the capture and a trip lies in the window of its day: Spark keeps one
row of state for each open trip (first and last ping, sums), and emits it when
the watermark, the latest capture time less the allowed lateness, has passed
the end of the day. Captures without pings move the watermark, too.

Pings of a day that has been closed are late: the state operator drops them. They
are counted afterwards, trip by trip, from what has landed and what has been
emitted (``late_pings``); the incremental refresh puts them right in the batch
layers. Pings without a time have no day and take no part.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitlens.config import LOCAL_TZ, TRIP_KEYS, file_system
from transitlens.functions.numeric import round_half_away, safe_ratio
from transitlens.functions.timefn import epoch_to_local_time
from transitlens.operators.enrich import GPSY_POSITIVE, match_pings_to_stops
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.schemas import LANDED_SNAPSHOT_SCHEMA
from transitlens.sources.publish import read_text
from transitlens.sources.snapshots import read_gps_snapshots

EVENT_TIME = "event_time"
DEFAULT_LATENESS = "2 hours"
#: the order of pings within a trip, as in the batch layers
ORDER = ("timestamp", "row_number", "ping_seq", "TASKID")
PAIR_COLUMNS = ("BUSNUMBER", "LINE", "TRIPID", "date", "ORIENTATION", "STARTTIME", "ENDTIME", "STARTSTOP", "ENDSTOP",
                "N_PINGS", "AVGDELAY")


def local_event_time(timestamp: Column, tz: str = LOCAL_TZ) -> Column:
    """Local wall clock as a timestamp, whatever the session's time zone: days of windows are local days."""
    wall = epoch_to_local_time(timestamp, tz)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(F.timestamp_diff("SECOND", start, wall))


def matched_pings(captures: DataFrame, stops: DataFrame, *carry: str) -> DataFrame:
    """Pings of captures with the stops they match; ``carry`` names capture columns that every ping keeps.

    With ``carry``, a capture without pings gives a row without a ping: an inner
    explode would let the optimizer filter such captures before the watermark sees them.
    """
    pings = flatten_pings(parse_gps_payload(captures), carry=carry, keep_empty=bool(carry))
    return match_pings_to_stops(pings, stops)


def grouped_trips(pings: DataFrame, *more_keys: Column) -> DataFrame:
    """One row for each trip: :data:`PAIR_COLUMNS` and ``KEPT``, whether its first and last ping pass the drop rule.

    A plain grouped aggregation, the same on a batch and on a stream.
    """
    whole = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(ORDER)], F.col("row_number").alias("stop"),
                     F.coalesce(F.expr(GPSY_POSITIVE), F.lit(False)).alias("kept"))
    known = pings.filter(" AND ".join(f"{k} IS NOT NULL" for k in TRIP_KEYS))
    trips = known.groupBy(*TRIP_KEYS, *more_keys).agg(
        F.min(whole).alias("first"), F.max(whole).alias("last"), F.count(F.lit(1)).alias("N_PINGS"),
        F.sum("DELAY").alias("delays"), F.count("DELAY").alias("n_delays"))
    return trips.select(
        "BUSNUMBER", F.col("RUTA").alias("LINE"), "TRIPID", "date", "ORIENTATION", F.col("first.b0").alias("STARTTIME"),
        F.col("last.b0").alias("ENDTIME"), F.col("first.stop").alias("STARTSTOP"), F.col("last.stop").alias("ENDSTOP"),
        "N_PINGS", round_half_away(safe_ratio("delays", "n_delays")).alias("AVGDELAY"),
        (F.col("first.kept") & F.col("last.kept")).alias("KEPT"))


def stream_trip_pairs(spark: SparkSession, captures_path: str, stops: DataFrame, sink: str, checkpoint: str,
                      lateness: str = DEFAULT_LATENESS, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Work in what has landed since the last run, and append the trips whose day is over to ``sink``, by date.

    Trips without a pair (``KEPT`` is false) are appended as well, so that every
    ping that was in time is accounted for; ``read_trip_pairs`` leaves them out.

    ``stops`` is a static dimension (pass it through ``bounded_broadcast``). With
    a bound on files per batch, later days may come first when a long backlog
    is worked in, and the rest of earlier days would be late; leave it out there.
    """
    reader = spark.readStream.schema(LANDED_SNAPSHOT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    captures = (reader.parquet(captures_path).withColumn(EVENT_TIME, local_event_time(F.col("timestamp")))
                .withWatermark(EVENT_TIME, lateness))
    trips = grouped_trips(matched_pings(captures, stops, EVENT_TIME), F.window(EVENT_TIME, "1 day"))
    return (trips.writeStream.format("parquet").outputMode("append").option("path", sink)
            .option("checkpointLocation", checkpoint).partitionBy("date").trigger(availableNow=True).start())


def read_trip_pairs(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).filter("KEPT").select(*PAIR_COLUMNS)


def watermark(spark: SparkSession, checkpoint: str) -> int | None:
    """The stream's watermark in milliseconds of local time, from its checkpoint; None before the first batch."""
    folder = os.path.join(checkpoint, "offsets")
    fs, p = file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    batches = sorted(int(n) for n in names if n.isdigit())
    if not batches:
        return None
    return json.loads(read_text(spark, os.path.join(folder, str(batches[-1]))).splitlines()[1])["batchWatermarkMs"]


def late_pings(spark: SparkSession, captures_path: str, stops: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Trip keys, ``N_PINGS`` landed, ``N_EMITTED`` and ``N_LATE`` for the trips of closed days that miss pings.

    A batch reconciliation of the sink with what has landed, restricted to
    closed days; both sides are counts by trip key. A ping that matches two
    directions counts in both trips.
    """
    mark = watermark(spark, checkpoint) or 0
    keys = ["BUSNUMBER", "LINE", "TRIPID", "date", "ORIENTATION"]
    captures = read_gps_snapshots(spark, captures_path).withColumn(EVENT_TIME, local_event_time(F.col("timestamp")))
    closed = F.unix_millis(F.window(EVENT_TIME, "1 day")["end"]) <= F.lit(mark)
    pings = matched_pings(captures.filter(closed), stops).filter(" AND ".join(f"{k} IS NOT NULL" for k in TRIP_KEYS))
    landed = pings.withColumn("LINE", F.col("RUTA")).groupBy(*keys).agg(F.count(F.lit(1)).alias("N_PINGS"))
    sent = spark.read.parquet(sink).groupBy(*keys).agg(F.sum("N_PINGS").alias("N_EMITTED"))
    both = landed.join(sent, keys, "left").withColumn("N_EMITTED", F.coalesce("N_EMITTED", F.lit(0).cast("long")))
    return both.withColumn("N_LATE", F.col("N_PINGS") - F.col("N_EMITTED")).filter("N_LATE > 0")
