"""Versioned publishing: all layers of a run appear together, by one rename.

    root/<layer>/_run=<id>/[<date column>=<date>/]part-*.parquet   written once, never changed
    root/_manifest/0000000012.json                                what version 12 consists of

A run writes its layers into folders of its own. Publishing then writes one
small file, the manifest of the next version, under a temporary name and
renames it; the rename refuses to replace a file. Before it nobody sees the
run, after it everybody sees all of it. No published file is moved, replaced or
deleted, so whatever moment a run dies at, every older version stays readable,
and a reader that has resolved a version goes on reading it.

A layer is published whole or by date: a run for some dates takes over the
current version's other dates. When two runs publish at once, the second
finds its version taken, reads that manifest and puts its own dates on top of
it. A manifest names a run for each date of a layer; it grows with dates, not
with rows. ``remove_old_versions`` deletes, when called, what no kept version
names.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.config import file_system

MANIFESTS = "_manifest"
METRICS = "_metrics"
RUN = "_run"
#: how a folder of rows without a date is named
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: times a run tries to publish while others do
ATTEMPTS = 20


@dataclass(frozen=True)
class Layer:
    """A layer of one version: its schema, its date column if it has one, and the run that wrote each date."""

    schema: T.StructType
    by: str | None
    parts: dict[str, str]


@dataclass(frozen=True)
class Manifest:
    """What a version consists of.

    ``applied`` holds how far each incremental source has been worked in,
    ``metrics`` what the run counted.
    """

    version: int = 0
    layers: dict[str, Layer] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    metrics: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        layers = {n: {"schema": x.schema.jsonValue(), "by": x.by, "parts": x.parts} for n, x in self.layers.items()}
        return json.dumps({"version": self.version, "layers": layers, "applied": self.applied,
                           "metrics": self.metrics}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], {n: Layer(T.StructType.fromJson(x["schema"]), x["by"], x["parts"])
                                       for n, x in d["layers"].items()}, d["applied"], d["metrics"])


def part_name(date) -> str:
    """The folder value of a date; None stands for rows without one."""
    return NO_DATE if date is None else str(date)


def _children(spark: SparkSession, path: str) -> list:
    fs, p = file_system(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def _manifest_path(root: str, version: int) -> str:
    return os.path.join(root, MANIFESTS, f"{version:010d}.json")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    names = [s.getPath().getName() for s in _children(spark, os.path.join(root, MANIFESTS))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The manifest of ``version`` or of the newest one; an empty one where nothing has been published."""
    if version is None:
        found = versions(spark, root)
        if not found:
            return Manifest()
        version = found[-1]
    return Manifest.from_json(read_text(spark, _manifest_path(root, version)))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source`` to ``target`` unless that exists; whether it was done."""
    jvm = spark._jvm
    _, p = file_system(spark, source)
    _, t = file_system(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(p), context.makeQualified(t), options)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _read(spark: SparkSession, root: str, name: str, layer: Layer, dates: Iterable | None) -> DataFrame:
    if dates is not None and layer.by is None:
        raise ValueError(f"{name} is not published by date")
    wanted = None if dates is None else {part_name(d) for d in dates}
    parts = {d: r for d, r in layer.parts.items() if wanted is None or d in wanted}
    base = os.path.join(root, name)
    folders = [os.path.join(base, f"{RUN}={r}", *([f"{layer.by}={d}"] if layer.by else [])) for d, r in sorted(parts.items())]
    if not folders:
        return spark.createDataFrame([], layer.schema)
    rows = spark.read.schema(layer.schema).option("basePath", base).parquet(*folders)
    return rows.select(*[f"`{c}`" for c in layer.schema.names])


def read_layer(spark: SparkSession, root: str, name: str, dates: Iterable | None = None, version: int | None = None) -> DataFrame:
    """A published layer as of one version (the newest unless stated), whole or for some dates.

    Only the files of this version are listed and read.
    """
    m = manifest(spark, root, version)
    if name not in m.layers:
        raise KeyError(f"{name} is not published under {root}")
    return _read(spark, root, name, m.layers[name], dates)


def history(spark: SparkSession, root: str, name: str) -> list[tuple[int, str, str]]:
    """(version, date, run) for each kept version in which a date of the layer came to another run."""
    out, before = [], {}
    for v in versions(spark, root):
        layer = manifest(spark, root, v).layers.get(name)
        now = layer.parts if layer else {}
        out += [(v, d, r) for d, r in sorted(now.items()) if before.get(d) != r]
        before = now
    return out


def gathered(df: DataFrame, by: str) -> DataFrame:
    """Rows of one date next to each other, a large date over several tasks.

    Written by date as they come, rows make a file for each task and date. This
    way there are about as many files as dates, or as the bytes need.
    """
    return df.hint("rebalance", F.col(f"`{by}`"))


class Run:
    """The layers that one run writes; unseen until ``publish``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, uuid.uuid4().hex
        self.begun: set[str] = set()
        self.written: dict[str, tuple[T.StructType, str | None]] = {}

    def path(self, name: str) -> str:
        self.begun.add(name)
        return os.path.join(self.root, name, f"{RUN}={self.id}")

    def took(self, name: str, schema: T.StructType, by: str | None = None) -> None:
        """Say that ``path(name)`` has been written."""
        self.written[name] = (schema, by)

    def write(self, name: str, df: DataFrame, by: str | None = None,
              last: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """Write a layer; as read back, for the layers after it.

        ``last`` is applied to the rows as gathered by date. Observed metrics
        belong there: a task of the shuffle that is repeated counts its rows again.
        """
        df = last(gathered(df, by) if by else df)
        out = df.write.mode("overwrite")
        (out.partitionBy(by) if by else out).parquet(self.path(name))
        self.took(name, df.schema, by)
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*[f"`{c}`" for c in df.columns])

    def _parts(self, name: str, by: str | None) -> dict[str, str]:
        if by is None:
            return {"": self.id}
        named = [s.getPath().getName().partition("=") for s in _children(self.spark, self.path(name))]
        return {value: self.id for column, _, value in named if column == by}

    def publish(self, dates: Iterable | None = None, applied: dict[str, int] | None = None,
                metrics: dict[str, int] | None = None) -> Manifest:
        """Make the run the newest version; the manifest.

        With ``dates``, layers by date keep the current version's other dates
        (a date without rows is then gone), and a row of any other date is an
        error, as it would replace a date that the run has read in part.
        Without, every written layer is replaced whole.
        """
        replaced = None if dates is None else {part_name(d) for d in dates}
        mine = {n: Layer(schema, by, self._parts(n, by)) for n, (schema, by) in self.written.items()}
        for name, layer in mine.items():
            if replaced is not None and layer.by and (strange := sorted(set(layer.parts) - replaced)):
                raise ValueError(f"{name} has rows of {', '.join(strange[:5])}, outside the dates of the run")
        for _ in range(ATTEMPTS):
            base = manifest(self.spark, self.root)
            layers = dict(base.layers)
            for name, layer in mine.items():
                if replaced is not None and layer.by and name in layers:
                    kept = {d: r for d, r in layers[name].parts.items() if d not in replaced}
                    layer = replace(layer, parts=kept | layer.parts)
                layers[name] = layer
            done = Manifest(base.version + 1, layers, base.applied | (applied or {}), metrics or {})
            if self._commit(done):
                return done
        raise OSError(f"could not publish under {self.root}: other runs came first {ATTEMPTS} times")

    def _commit(self, m: Manifest) -> bool:
        target = _manifest_path(self.root, m.version)
        temporary = os.path.join(self.root, MANIFESTS, f".{m.version:010d}-{self.id}")
        write_text(self.spark, temporary, m.to_json())
        if rename_new(self.spark, temporary, target):
            return True
        delete(self.spark, temporary)
        return False

    def published(self) -> bool:
        """Whether any version names the run (its last answer may have been lost on the way)."""
        return any(self.id in layer.parts.values() for v in versions(self.spark, self.root)
                   for layer in manifest(self.spark, self.root, v).layers.values())

    def abandon(self) -> None:
        """Delete what an unpublished run wrote; a published one stays."""
        if not self.published():
            for name in sorted(self.begun):
                delete(self.spark, self.path(name))


def publishing(spark: SparkSession, root: str, work: Callable[[Run], dict]) -> Manifest:
    """Run ``work`` on a new :class:`Run` and publish it; a failed run's files are deleted.

    ``work`` writes the layers and returns the arguments of :meth:`Run.publish`.
    """
    run = Run(spark, root)
    try:
        return run.publish(**work(run))
    except BaseException:
        run.abandon()
        raise


def all_metrics(spark: SparkSession, root: str) -> dict[int, dict[str, int]]:
    """The metrics of every version ever published, oldest first."""
    old = [s.getPath().getName() for s in _children(spark, os.path.join(root, METRICS))]
    kept = {int(n[:-5]): json.loads(read_text(spark, os.path.join(root, METRICS, n))) for n in old
            if n.endswith(".json") and n[:-5].isdigit()}
    return dict(sorted((kept | {v: manifest(spark, root, v).metrics for v in versions(spark, root)}).items()))


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2, min_age_hours: float = 168) -> list[str]:
    """Delete all but the newest ``keep`` manifests and the run folders that no kept one names; the deleted folders.

    Folders younger than ``min_age_hours`` stay: they may belong to a run that
    is still writing. Manifests go first, so no kept version ever names a
    deleted folder.
    """
    found = versions(spark, root)
    if keep < 1:
        raise ValueError("at least one version must be kept")
    if not found:
        return []
    named = {(n, r) for v in found[-keep:] for n, layer in manifest(spark, root, v).layers.items() for r in layer.parts.values()}
    before = (time.time() - min_age_hours * 3600) * 1000
    for v in found[:-keep]:  # their metrics stay
        write_text(spark, os.path.join(root, METRICS, f"{v:010d}.json"), json.dumps(manifest(spark, root, v).metrics))
        delete(spark, _manifest_path(root, v))
    gone = []
    for layer in _children(spark, root):
        name = layer.getPath().getName()
        if name == METRICS:
            continue
        if name == MANIFESTS:
            stale = [s.getPath() for s in _children(spark, layer.getPath().toString())
                     if s.getPath().getName().startswith(".") and s.getModificationTime() < before]
            for p in stale:
                delete(spark, p.toString())
            continue
        for s in _children(spark, layer.getPath().toString()):
            folder = s.getPath().getName()
            if folder.startswith(f"{RUN}=") and (name, folder.partition("=")[2]) not in named and s.getModificationTime() < before:
                delete(spark, s.getPath().toString())
                gone.append(os.path.join(name, folder))
    return gone
