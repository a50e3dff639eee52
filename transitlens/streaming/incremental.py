"""Incremental ingest: only captures not seen before are parsed and flattened.

Parsing and flattening are stateless per capture, so they run unchanged on a
stream. The file source's checkpoint records which files were processed;
``availableNow`` processes the backlog in bounded micro-batches and stops,
which gives daily-batch scheduling with exactly-once file sinks.
The source layout is the landing layout (``capture_date=...`` folders).
Enrichment needs ``lead`` (not supported on streams) and runs in batch over
the dates a run touched: ``incremental_refresh``. Its stream only finds out
which capture dates the new files belong to, from their folders. Every
micro-batch leaves one small file with its dates in a ledger, named by the batch
number; the refresh takes the dates of all batches not worked in yet, and the
version it publishes records the last batch. Wherever a run dies, the next one
goes on from there:

* before the ledger file: the stream repeats the batch under the same number;
* between ledger file and checkpoint: the repeat writes the same file again;
* before publishing: the batch is still open, its dates are refreshed next time;
* after publishing: the version says that the batch is done.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from transitlens.config import file_system
from transitlens.operators.payload import flatten_pings, parse_gps_payload
from transitlens.plans.refresh import refresh
from transitlens.schemas import LANDED_SNAPSHOT_SCHEMA
from transitlens.sources.publish import manifest, read_text, write_text
from transitlens.sources.snapshots import PARTITION_COL


def incremental_flatten(spark: SparkSession, src: str, sink: str, checkpoint: str,
                        max_files_per_trigger: int = 1000, schema=LANDED_SNAPSHOT_SCHEMA) -> StreamingQuery:
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(src))
    flat = flatten_pings(parse_gps_payload(stream))
    return (flat.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .option("path", sink)
            .partitionBy("date")
            .trigger(availableNow=True)
            .start())


def _ledger_file(ledger: str, batch: int) -> str:
    return os.path.join(ledger, f"{batch:010d}.json")


def note_touched_dates(batch: DataFrame, batch_id: int, ledger: str) -> None:
    """Write the capture dates of a micro-batch to the ledger; a repeat writes the same file again.

    Only the partition column is read: a date for each day touched.
    """
    dates = sorted((str(r[0]) if r[0] is not None else None for r in batch.select(PARTITION_COL).distinct().collect()),
                   key=lambda d: d or "")
    write_text(batch.sparkSession, _ledger_file(ledger, batch_id), json.dumps(dates))


def open_batches(spark: SparkSession, ledger: str, done: int) -> dict[int, list[str | None]]:
    """Batches of the ledger after number ``done``, with their dates."""
    fs, p = file_system(spark, ledger)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    numbers = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
    return {n: json.loads(read_text(spark, _ledger_file(ledger, n))) for n in numbers if n > done}


def incremental_refresh(spark: SparkSession, captures_path: str, stops_path: str, out_root: str, checkpoint: str,
                        max_files_per_trigger: int = 1000, **options) -> dict | None:
    """Refresh, in all layers, the dates that captures landed since the last run belong to.

    Returns what :func:`transitlens.plans.refresh.refresh` returns, with the
    ``dates`` it replaced, or None where nothing new has landed. ``options`` go
    to the refresh. ``checkpoint`` holds the stream's checkpoint and the ledger.
    """
    ledger = os.path.join(checkpoint, "ledger")
    query = (spark.readStream.schema(LANDED_SNAPSHOT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(captures_path).writeStream
             .foreachBatch(lambda batch, batch_id: note_touched_dates(batch, batch_id, ledger))
             .option("checkpointLocation", os.path.join(checkpoint, "stream"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    source = str(query.id)  # kept in the checkpoint: the same for every run
    todo = open_batches(spark, ledger, manifest(spark, out_root).applied.get(source, -1))
    if not todo:
        return None
    dates = sorted({d for found in todo.values() for d in found}, key=lambda d: d or "")
    done = refresh(spark, captures_path, stops_path, out_root, capture_dates=dates, applied={source: max(todo)}, **options)
    return done | {"dates": dates}
