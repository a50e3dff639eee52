"""Document fingerprints by randomised edit embedding.

One random walk, shared by all texts, reads a text: at output step ``j`` it
writes the current character and moves on to the next one if a coin that
depends on ``j`` and the character says so. Two texts that differ by few edits
soon walk in step again behind each edit, so the Hamming distance of the
outputs follows the edit distance.

The fingerprint samples the output at ``SAMPLES`` places, one in each equal
block; the block size is the power of two that covers the whole walk, so every
part of a text counts. Places of a coarser level are chosen among those of the
finer level, which keeps texts of different levels comparable. A place holds a
four-bit code of its character, 0 where the walk had ended.

``near_pairs`` finds near copies of a stated query set: fingerprints are banded
by sampled places, and a candidate is verified by its likeness. Texts with
equal fingerprints are one class and searched once.

Edge cases: a null text is empty; the empty text has an all-zero fingerprint,
equal to itself; equal texts have equal fingerprints; ids may repeat or be
null; characters are code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import slices, text_or_empty, written

SAMPLES = 128
#: the coins repeat after so many steps; a character's coins are those of its class
PERIOD = 1 << 15
CLASSES = 64
SEED = 20240229
#: code points walked together, which bounds the memory of a step
WALK_POINTS = 1 << 20
BANDS = 16
BAND_PLACES = 6
LIKENESS = 0.8


def coin_table() -> np.ndarray:
    """Steps from (class, j mod PERIOD) to the step behind the next head; flat, class-major."""
    heads = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    heads[:, -1] |= ~heads.any(1)
    out = np.empty((CLASSES, PERIOD), np.int64)
    for c in range(CLASSES):
        at = np.flatnonzero(heads[c])
        following = at[np.searchsorted(at, np.arange(PERIOD)) % len(at)]
        out[c] = (following - np.arange(PERIOD)) % PERIOD + 1
    return out.ravel()


def char_class(points: np.ndarray) -> np.ndarray:
    return ((points.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(26)).astype(np.int64)


def char_code(points: np.ndarray) -> np.ndarray:
    return ((points.astype(np.uint32) * np.uint32(2246822519)) >> np.uint32(17)).astype(np.int64) % 15 + 1


def level_of(n: int) -> int:
    """Smallest level whose places cover three output steps for each of ``n`` characters."""
    level = 0
    while SAMPLES << level < 3 * n:
        level += 1
    return level


def places(level: int) -> np.ndarray:
    """Output steps sampled at ``level``: one in each block, a choice among the finer level's."""
    at = np.arange(SAMPLES, dtype=np.int64)
    for k in range(level, 0, -1):
        pick = np.random.default_rng(SEED + k).integers(0, 2, SAMPLES << (level - k))
        at = 2 * at + pick[at]
    return at


def walk(classes: list[np.ndarray], coins: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """Output step at which each character of each text is first written, for texts that start at ``begin``.

    Texts are walked side by side, longest first, one character a step.
    """
    order = np.argsort([-len(c) for c in classes], kind="stable")
    lengths = np.array([len(classes[i]) for i in order])
    longest = int(lengths[0]) if len(lengths) else 0
    grid = np.zeros((longest, len(order)), np.int64)
    for k, i in enumerate(order):
        grid[:lengths[k], k] = classes[i]
    grid *= PERIOD
    steps = np.empty((longest + 1, len(order)), np.int64)
    steps[0] = begin[order]
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for i, n in enumerate(active.tolist()):
        j = steps[i, :n]
        np.add(j, coins[grid[i, :n] + (j & (PERIOD - 1))], out=steps[i + 1, :n])
    out: list = [None] * len(order)
    for k, i in enumerate(order):
        out[i] = steps[:lengths[k] + 1, k].copy()
    return out


def sampled(codes: np.ndarray, steps: np.ndarray, spots: dict[int, np.ndarray]) -> str:
    """Fingerprint of a text from its character codes and their steps (one more step ends the walk)."""
    level = level_of(len(codes))
    if level not in spots:
        spots[level] = places(level)
    at = np.searchsorted(steps, spots[level], side="right") - 1
    value = np.append(codes, 0)[np.minimum(at, len(codes))]
    return f"{level:02x}" + "".join(map("0123456789abcdef".__getitem__, value.tolist()))


def _finer(level: int, wanted: int, symbols: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` (coarser) that a text of ``level`` has sampled; 0 behind its last block."""
    for k in range(level, wanted):
        pick = np.random.default_rng(SEED + k + 1).integers(0, 2, SAMPLES)
        kept = symbols[np.minimum(2 * np.arange(SAMPLES) + pick, SAMPLES - 1)]
        symbols = np.where(np.arange(SAMPLES) < SAMPLES // 2, kept, 0)
    return symbols


def likeness(a: str, b: str) -> float:
    """Share of equal places among those that either walk reached (1 for two empty texts)."""
    if a == b:
        return 1.0
    la, lb = int(a[:2], 16), int(b[:2], 16)
    x = np.frombuffer(a[2:].encode(), np.uint8) - ord("0")
    y = np.frombuffer(b[2:].encode(), np.uint8) - ord("0")
    x, y = _finer(la, max(la, lb), x), _finer(lb, max(la, lb), y)
    used = (x != 0) | (y != 0)
    return float(((x == y) & used).sum() / used.sum()) if used.any() else 1.0


class Printer:
    """Fingerprints of batches of texts; holds the shared coins and places."""

    def __init__(self):
        self.coins, self.spots = coin_table(), {}

    def __call__(self, texts: list[np.ndarray], edits: list[tuple[int, np.ndarray]]) -> tuple[list[str], list[str]]:
        """Prints of ``texts`` (code points) and of each text cut at an index and continued by other points.

        Kept beginnings are walked once.
        """
        prints: list = [None] * len(texts)
        changed: list = [None] * len(texts)
        for group in self._groups([len(t) + len(e) for t, (_, e) in zip(texts, edits, strict=True)]):
            steps = walk([char_class(texts[i]) for i in group], self.coins, np.zeros(len(group), np.int64))
            begin = np.array([s[edits[i][0]] for i, s in zip(group, steps, strict=True)], np.int64)
            tails = walk([char_class(edits[i][1]) for i in group], self.coins, begin)
            for i, s, tail in zip(group, steps, tails, strict=True):
                cut, more = edits[i]
                codes = char_code(texts[i])
                prints[i] = sampled(codes, s, self.spots)
                changed[i] = sampled(np.append(codes[:cut], char_code(more)), np.append(s[:cut], tail), self.spots)
        return prints, changed

    @staticmethod
    def _groups(sizes: list[int]) -> Iterator[list[int]]:
        """Indices by falling size, cut so that a group's grid stays within ``WALK_POINTS``."""
        group: list[int] = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if group and sizes[group[0]] * (len(group) + 1) > WALK_POINTS:
                yield group
                group = []
            group.append(i)
        if group:
            yield group


def points_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``."""

    @F.arrow_udf("string")
    def prints(texts: pa.Array) -> pa.Array:
        printer = Printer()
        points = [points_of(t.as_py()) for t in texts]
        return pa.array(printer(points, [(0, points_of(""))] * len(points))[0], pa.string())

    return docs.withColumn("fingerprint", prints(F.col(text)))


def _edited(points: np.ndarray, following: np.ndarray) -> tuple[int, np.ndarray]:
    half = len(points) // 2
    return len(points) - half, following[:half]


def _row(doc_id, points, cut, more, own, changed, following) -> tuple:
    text = np.append(points[:cut], more).astype("<u4").tobytes().decode("utf-32-le")
    return (doc_id, len(points), hashlib.sha256(text.encode()).hexdigest(), own, changed,
            likeness(own, changed), likeness(own, following))


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")]]


def edit_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit by the text that follows in falling id order.

    Rows are range-partitioned by id once; each task compares neighbours as they
    stream by, and keeps one text back. Where a partition ends, its last and
    the next one's first text, two a partition, are written and joined.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        printer = Printer()
        kept: list = []  # the row whose successor is not read yet
        edge = None
        id_type = None
        for piece in slices(batches, "text"):
            id_type = piece.schema.field("doc_id").type
            ids = [*[k[0] for k in kept], *piece.column("doc_id").to_pylist()]
            texts = [*[k[1] for k in kept], *map(points_of, piece.column("text").to_pylist())]
            edits = [_edited(a, b) for a, b in zip(texts, texts[1:])]
            own, changed = printer(texts, [*edits, (0, points_of(""))])
            if edge is None:
                edge = (texts[0], own[0])
                yield _batch([(None,) * 7], id_type, [part], ["first"], [_text(texts[0])], [own[0]])
            out = [_row(i, t, cut, more, f, e, g) for i, t, (cut, more), f, e, g in
                   zip(ids, texts, edits, own, changed, own[1:])]
            if out:
                yield _batch(out, id_type, [part] * len(out), [None] * len(out), [None] * len(out), [None] * len(out))
            kept = [(ids[-1], texts[-1], own[-1])]
        for i, t, f in kept:
            yield _batch([(i,) + (None,) * 6], id_type, [part], ["last"], [_text(t)], [f])

    edge_cols = "part int, edge string, edge_text string, edge_print string"
    made = written(dealt.mapInArrow(run, f"doc_id {kind}, {SCHEMA}, {edge_cols}"), "edit-prints")
    # Two rows for each partition: the successor of a partition's last row is the next one's first.
    firsts = made.where("edge = 'first'").select(F.col("part").alias("_to"), F.col("edge_text").alias("_text"),
                                                 F.col("edge_print").alias("_print"))
    used = sorted(r["part"] for r in made.where("edge = 'first'").select("part").collect())
    after = spark.createDataFrame([(p, used[(k + 1) % len(used)]) for k, p in enumerate(used)], "part int, _to int")
    lasts = (made.where("edge = 'last'").select("doc_id", "part", "edge_text", "edge_print")
             .join(F.broadcast(after), "part").join(firsts, "_to"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer()
        for b in batches:
            ids, texts, own, nexts, prints = (b.column(c).to_pylist() for c in
                                              ("doc_id", "edge_text", "edge_print", "_text", "_print"))
            points = list(map(points_of, texts))
            edits = [_edited(p, points_of(n)) for p, n in zip(points, nexts, strict=True)]
            changed = printer(points, edits)[1]
            out = [_row(i, p, cut, more, f, e, g) for i, p, (cut, more), f, e, g in
                   zip(ids, points, edits, own, changed, prints, strict=True)]
            yield _batch(out, b.schema.field("doc_id").type)

    ends = lasts.select("doc_id", "edge_text", "edge_print", "_text", "_print").mapInArrow(close, f"doc_id {kind}, {SCHEMA}")
    return made.where("edge IS NULL").select(*_NAMES).unionByName(ends)


def _text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le")


def _batch(rows: list[tuple], id_type: pa.DataType, *edges: list) -> pa.RecordBatch:
    types = [id_type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    names, arrays = list(_NAMES), [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)]
    if edges:
        names += ["part", "edge", "edge_text", "edge_print"]
        arrays += [pa.array(e, t) for e, t in zip(edges, [pa.int32(), *[pa.string()] * 3], strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def band_spots() -> list[np.ndarray]:
    chosen = np.random.default_rng(SEED).choice(SAMPLES, BANDS * BAND_PLACES, replace=False)
    return [np.sort(band) for band in chosen.reshape(BANDS, BAND_PLACES)]


def band_keys(fingerprint: str, spots: list[np.ndarray]) -> list[str]:
    """Keys of the bands at a print's own level and the next coarser one, so that texts on either side of a
    level's bound still meet."""
    level = int(fingerprint[:2], 16)
    symbols = np.frombuffer(fingerprint[2:].encode(), np.uint8) - ord("0")
    keys = []
    for at in (level, level + 1):
        own = _finer(level, at, symbols)
        keys += [f"{b}:{at}:{own[spot].tobytes().hex()}" for b, spot in enumerate(spots) if own[spot].any()]
    return keys


def near_pairs(queries: DataFrame, prints: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(query, other, near): distinct fingerprints that share a band with a query's and are at least ``least`` alike.

    Both tables need ``fingerprint``. Copies are searched once: the result is
    between distinct fingerprints, to be joined back where rows are wanted.
    """

    @F.arrow_udf("double")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([likeness(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())

    spots = band_spots()

    @F.arrow_udf("array<string>")
    def keys(prints: pa.Array) -> pa.Array:
        return pa.array([band_keys(p, spots) for p in prints.to_pylist()], pa.list_(pa.string()))

    def banded(df: DataFrame, name: str) -> DataFrame:
        one = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return one.select(name, F.explode_outer(keys(F.col(name))).alias("band"))

    met = banded(queries, "query").join(banded(prints, "other"), "band").select("query", "other").distinct()
    return met.withColumn("near", alike("query", "other")).where(F.col("near") >= least)
