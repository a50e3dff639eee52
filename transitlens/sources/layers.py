"""Publish pipeline layers as one version of a shared folder.

Each layer is a function of a ``read(name)`` callback, so a layer reads its
upstream by name from what was written before it (the write also cuts the
lineage, so a lost executor never recomputes the whole chain). Readers see all
layers of a run or none (``sources.publish``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from transitlens.sources.publish import Run, publishing, read_layer


def materialize_layers(spark: SparkSession, layers: list[tuple[str, Callable]], root: str,
                       by: dict[str, str] | None = None, dates: Iterable | None = None) -> dict[str, DataFrame]:
    """Build and publish ``layers``; each as read back from the new version.

    ``by`` names the date column of layers published by date; with ``dates``
    these dates of them are replaced and all others kept.
    """
    by = by or {}

    def work(run: Run):
        written: dict[str, DataFrame] = {}
        for name, build in layers:
            written[name] = run.write(name, build(written.__getitem__), by.get(name))
        return {"dates": dates}

    version = publishing(spark, root, work).version
    return {name: read_layer(spark, root, name, version=version) for name, _ in layers}
