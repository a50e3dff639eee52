"""Fixed values and session conventions.

Fixed values (must equal the source pipeline for identical results):
    local time zone ........ America/Bogota
    coordinate scale ....... 1e7 (fixed-point strings -> degrees)
    earth radius ........... 6371000.0 metres
    trip partition keys .... BUSNUMBER, RUTA, TRIPID, date, ORIENTATION
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# --- fixed values -----------------------------------------------------------
LOCAL_TZ = "America/Bogota"
GPS_SCALE = 1e7
EARTH_METERS = 6371000.0
TRIP_KEYS = ("BUSNUMBER", "RUTA", "TRIPID", "date", "ORIENTATION")
# ---------------------------------------------------------------------------

# Rows above which a derived dimension is joined by shuffle instead of broadcast.
DEFAULT_BROADCAST_ROWS = 2_000_000
# Width of the time slices that split one trip partition across tasks.
DEFAULT_SLICE_SECONDS = 900


def build_session(master: str = "local[*]", app: str = "transitlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session with the conventions the operators assume (UTC, AQE, no UI)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised layers.

    Uses ``spark.checkpoint.dir`` from the session. Only a local-mode session
    without that setting (tests, the single-node bench) gets a private temp
    folder; a cluster session without it is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        d = tempfile.mkdtemp(prefix="transitlens-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some sessions reject runtime core settings
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.conf.get("spark.checkpoint.dir", None) or d


def file_system(spark: SparkSession, path: str):
    """(file system, path) objects of a folder in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's own folder under the shared root; the folder goes with the session."""
    own = os.path.join(checkpoint_root(spark), f"transitlens-{spark.sparkContext.applicationId}")
    fs, p = file_system(spark, own)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return os.path.join(own, f"{name}-{uuid.uuid4().hex[:12]}")
