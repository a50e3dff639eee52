"""Hard-negative mining over rotated one-bit codes.

Integer vectors are rotated by signed Hadamard steps, which keeps them whole
numbers: ``y = H D x`` has ``|y|^2 = n |x|^2``. A row's code is the sign bit of
each of the ``n`` components; stored beside it are its squared length and its
alignment ``A = sum |y_i|``, the product of the rotated vector with its own
code vector ``s`` of plus and minus ones.

For an anchor with rotated vector ``z``, let ``T = z.s``. Both vectors split
into a part along ``s`` and a residual across it, so by Cauchy-Schwarz

    | z.y - A T / n |  <=  sqrt(|z|^2 - T^2 / n) * sqrt(|y|^2 - A^2 / n).

``T`` is estimated by popcounts of the code against eight bit planes of ``z``;
the rounding error of the planes is known exactly and widens the interval. The
interval is deterministic: a row outside it can't be an answer. A row is
dropped when its interval misses the wanted score range, or when enough other
rows have a lower end above its upper end; the scores of all surviving
intervals are computed in integers.

Anchors are a stated query set: they are taken in blocks of bounded size, and
every block meets all rows twice, once for its positives and once for the
negatives between the bounds that these set. A task returns the best few rows
for each anchor or pair; Spark ranks them.

Edge cases: rows with a null label, or with a null or non-finite vector, take
no part (see ``vectors`` for lengths and sizes); "other" rows are those with
another id than the anchor; repeated rows each count, a repeated anchor is
mined once for each of its rows; a null id is no anchor and comes last among
equal scores; anchors without positives, and positives without a score above
zero, have no negatives within the bounds but at score zero; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitlens.config import scratch_path
from transitlens.llm.common import discard, written
from transitlens.llm.vectors import integer_vectors, matrix, portions

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: negatives score between these percentages of their positive
BETWEEN = (30, 90)
#: numbers of anchor vectors held by the driver and every task at a time (32 MB)
BLOCK_VALUES = 1 << 22
#: rows and anchors compared side by side
ROWS = 4096
ANCHORS = 128
PLANES = 8
SEED = 20250117



def rotated(x: np.ndarray) -> np.ndarray:
    """``H D x`` for each row, filled with zeros to a power of two of at least 64; whole numbers."""
    n = max(64, 1 << max(0, x.shape[1] - 1).bit_length())
    flips = np.random.default_rng(SEED).integers(0, 2, n) * 2 - 1
    y = np.zeros((len(x), n), np.int64)
    y[:, :x.shape[1]] = x * flips[:x.shape[1]]
    h = 1
    while h < n:
        pairs = y.reshape(len(x), n // (2 * h), 2, h)
        y = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return y


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass
class Codes:
    """One-bit codes of rows: bit words, length, alignment, and the residual's length, of the rotated vectors."""

    words: np.ndarray
    ones: np.ndarray
    size: np.ndarray
    align: np.ndarray
    across: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, size: np.ndarray, align: np.ndarray) -> Codes:
        n = words.shape[1] * 64
        ones = np.bitwise_count(words).sum(1, dtype=np.int64)
        across = np.sqrt(np.maximum(n * size - align ** 2 / n, 0))
        return cls(words, ones, size, align, across)


@dataclass
class Queries:
    """Rotated anchors as bit planes, with the exact bound of the planes' rounding."""

    planes: np.ndarray
    base: np.ndarray
    step: np.ndarray
    levels: np.ndarray
    slack: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, q: np.ndarray) -> Queries:
        z = rotated(q).astype(float)
        top = np.abs(z).max(1, initial=0)
        step = np.where(top > 0, 2 * top / ((1 << PLANES) - 1), 1.0)
        level = np.clip(np.rint((z + top[:, None]) / step[:, None]), 0, (1 << PLANES) - 1)
        error = np.abs(z - (level * step[:, None] - top[:, None])).sum(1)
        level = level.astype(np.int64)
        planes = np.stack([_words((level >> b) & 1 == 1) for b in range(PLANES)], axis=1)
        return cls(planes, -top, step, level.sum(1), error, (z ** 2).sum(1))


def intervals(rows: Codes, queries: Queries, which: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the products of every row (down) with the chosen queries (across)."""
    n = rows.words.shape[1] * 64
    planes = queries.planes[which]
    met = np.zeros((len(rows.words), len(planes)), np.int64)
    for b in range(PLANES):
        for w in range(rows.words.shape[1]):
            met += np.bitwise_count(rows.words[:, w, None] & planes[None, :, b, w]).astype(np.int64) << b
    along = (queries.step[which] * (2 * met - queries.levels[which])
             + queries.base[which] * (2 * rows.ones - n)[:, None])
    slack = queries.slack[which]
    least = np.maximum(np.abs(along) - slack, 0)
    across = np.sqrt(np.maximum(queries.size[which] - least ** 2 / n, 0))
    # The last terms cover the rounding of doubles.
    half = (rows.align[:, None] * slack / n + across * rows.across[:, None]
            + 1e-9 * np.sqrt(queries.size[which]) * np.sqrt(n * rows.size)[:, None] + 1e-3)
    middle = rows.align[:, None] * along / n
    return (middle - half) / n, (middle + half) / n


def _product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products; doubles hold them below 2^53 and multiply faster."""
    if x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) < 1 << 53:
        return (x.astype(float) @ q.astype(float)).astype(np.int64)
    return x @ q


class _Best:
    """The first ``k`` rows so far of each of many queries: higher scores first, ties by id, null ids last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * n
        self.id = [np.zeros(0, np.int64)] * n
        self.null = [np.zeros(0, bool)] * n

    def bar(self, i: int) -> float:
        """A score that a row must reach to come among the first."""
        return self.score[i][-1] if len(self.score[i]) == self.k else -np.inf

    def add(self, i: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        s, d, m = (np.concatenate(p) for p in ((self.score[i], score), (self.id[i], ids), (self.null[i], null)))
        first = np.lexsort((d, m, -s))[:self.k]
        self.score[i], self.id[i], self.null[i] = s[first], d[first], m[first]

    def rows(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        of = np.repeat(np.arange(len(self.score)), [len(s) for s in self.score])
        ids, null = (np.concatenate(p) if p else np.zeros(0) for p in (self.id, self.null))
        return of, pa.array(ids, pa.int64(), mask=null.astype(bool)), np.concatenate(self.score) if self.score else np.zeros(0, np.int64)


def _kth_highest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


@dataclass
class _Batch:
    ids: np.ndarray
    null: np.ndarray
    label: np.ndarray
    v: np.ndarray
    codes: Codes


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[_Batch]:
    for b in portions(batches, ROWS):
        ids = b.column("id")
        words = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint64).reshape(b.num_rows, -1)
        yield _Batch(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), b.column("label").to_numpy(),
                     matrix(b.column("v"), width),
                     Codes.of(words, b.column("size").to_numpy().astype(float), b.column("align").to_numpy().astype(float)))


@dataclass
class Block:
    """A bounded block of anchors."""

    ids: np.ndarray
    label: np.ndarray
    v: np.ndarray


def _add(best: _Best, i: int, batch: _Batch, rows: np.ndarray, q: np.ndarray) -> None:
    if len(rows):
        best.add(i, _product(batch.v[rows], q), batch.ids[rows], batch.null[rows])


def best_positives(batches: Iterator[_Batch], block: Block, k: int) -> _Best:
    """Each anchor's first ``k`` rows of its label and another id."""
    queries, best = Queries.of(block.v), _Best(len(block.ids), k)
    for b in batches:
        for start in range(0, len(block.ids), ANCHORS):
            which = slice(start, min(start + ANCHORS, len(block.ids)))
            low, high = intervals(b.codes, queries, which)
            for i in range(which.start, which.stop):
                rows = np.flatnonzero((b.label == block.label[i]) & ((b.ids != block.ids[i]) | b.null))
                if len(rows) > 4 * k:  # the most promising rows first: their scores rule out others
                    order = np.argpartition(-high[rows, i - start], 2 * k)
                    _add(best, i, b, rows[order[:2 * k]], block.v[i])
                    rows = rows[order[2 * k:]]
                bar = max(best.bar(i), _kth_highest(low[rows, i - start], k))
                _add(best, i, b, rows[high[rows, i - start] >= bar], block.v[i])
    return best


@dataclass
class Pairs:
    """Anchors with one positive each, and the lowest and highest score of its negatives."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray


def best_negatives(batches: Iterator[_Batch], block: Block, pairs: Pairs, k: int) -> _Best:
    """Each pair's first ``k`` rows of another label than the anchor's and a score within the pair's bounds."""
    queries, best = Queries.of(block.v), _Best(len(pairs.anchor), k)
    order = np.argsort(pairs.anchor, kind="stable")
    edges = np.searchsorted(pairs.anchor[order], np.arange(len(block.ids) + 1))
    for b in batches:
        for start in range(0, len(block.ids), ANCHORS):
            which = slice(start, min(start + ANCHORS, len(block.ids)))
            lows, highs = intervals(b.codes, queries, which)
            for i in range(which.start, which.stop):
                own = order[edges[i]:edges[i + 1]]
                own = own[pairs.low[own] <= pairs.high[own]]
                if not len(own):
                    continue
                low, high = lows[:, i - start], highs[:, i - start]
                wanted = np.zeros(len(b.ids), bool)
                other = b.label != block.label[i]
                for p in own:
                    sure = other & (low >= pairs.low[p]) & (high <= pairs.high[p])
                    bar = max(pairs.low[p], best.bar(p), _kth_highest(low[sure], k))
                    wanted |= other & (high >= bar) & (low <= pairs.high[p])
                rows = np.flatnonzero(wanted)
                score = _product(b.v[rows], block.v[i])
                for p in own:
                    within = (score >= max(pairs.low[p], best.bar(p))) & (score <= pairs.high[p])
                    if within.any():
                        best.add(p, score[within], b.ids[rows[within]], b.null[rows[within]])
    return best


def coded(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors`` (``id``, ``label``, ``v``) with ``code``, ``size`` (squared length) and ``align``."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches, ROWS):
            v = matrix(b.column("v"), width)
            y = rotated(v)
            words = _words(y >= 0).tobytes()
            step = len(words) // max(1, len(v))
            code = pa.array([words[i * step:(i + 1) * step] for i in range(len(v))], pa.binary())
            yield pa.record_batch([*[b.column(c) for c in ("id", "label", "v")], code, pa.array((v ** 2).sum(1)),
                                   pa.array(np.abs(y).sum(1))], names=["id", "label", "v", "code", "size", "align"])

    return vectors.select("id", "label", "v").mapInArrow(
        codes, "id long, label long, v array<int>, code binary, size long, align long")


def _first(rows: DataFrame, by: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(vec_id).asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mined(rows: DataFrame, width: int, block: Block, positives: int, negatives: int, between: tuple[int, int]) -> DataFrame:
    """Ranked negatives of one block: two passes over all rows."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, ids, score = best_positives(_batches(batches, width), block, positives).rows()
        yield pa.record_batch({"a": pa.array(of, pa.int32()), "positive_id": ids, "positive_score": pa.array(score, pa.int64())})

    found = rows.mapInArrow(nearest, "a int, positive_id long, positive_score long")
    near = _first(found, ["a"], "positive_score", "positive_id", positives).toArrow()  # at most ``positives`` an anchor
    anchor, score = near["a"].to_numpy(), near["positive_score"].to_numpy()
    least, most = between
    pairs = Pairs(anchor, -(-least * score // 100), most * score // 100)
    positive = near["positive_id"].combine_chunks()
    anchors = pa.array(block.ids[anchor], pa.int64())

    def between_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, ids, s = best_negatives(_batches(batches, width), block, pairs, negatives).rows()
        yield pa.record_batch({"pair": pa.array(of, pa.int32()), "anchor_id": anchors.take(pa.array(of)),
                               "positive_id": positive.take(pa.array(of)), "positive_score": pa.array(score[of], pa.int64()),
                               "negative_id": ids, "negative_score": pa.array(s, pa.int64())})

    found = rows.mapInArrow(between_bounds, "pair int, anchor_id long, positive_id long, positive_score long, "
                                            "negative_id long, negative_score long")
    return _first(found, ["pair"], "negative_score", "negative_id", negatives)


def mine(df: DataFrame, vec_id: Column, label: Column, is_anchor: Column, vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, between: tuple[int, int] = BETWEEN,
         scale: int = SCALE, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for all anchors.

    ``is_anchor`` is a condition on the column ``id``.
    """
    spark = df.sparkSession
    vectors, width = integer_vectors(df.where(label.isNotNull()), scale,
                                     {"id": vec_id.cast("long"), "label": label.cast("long")}, vector)
    rows = written(coded(vectors, width), "one-bit-codes")
    discard(vectors)
    anchors = rows.where(is_anchor).select("id", "label", "v")
    most = max(1, block_values // max(1, width))
    n_blocks = -(-anchors.count() // most)
    out = scratch_path(spark, "hard-negatives")
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    # Blocks are dealt by row, not by id, so that a repeated anchor can't fill one; half full on average.
    n_blocks = n_blocks if n_blocks < 2 else 2 * n_blocks
    dealt = written(anchors.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(max(1, n_blocks)))),
                    "anchors")
    for b in range(n_blocks):
        held = dealt.where(F.col("block") == b).toArrow()
        if held.num_rows:
            block = Block(held["id"].to_numpy(), held["label"].to_numpy(), matrix(held["v"], width))
            _mined(rows, width, block, positives, negatives, between).select(*names).write.mode("append").parquet(out)
    if not n_blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)
