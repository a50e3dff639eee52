"""Vector code compression: product codebooks of integer vectors, searched by equal averages.

A vector is cut into equal consecutive parts; every part position has its own
codebook. Codebooks start as the parts of the rows with the smallest ids and
are refined by rounds of assignment and averaging (floor of the mean).

The nearest entry of a part is found by its component sum. By Cauchy-Schwarz
the squared gap of two sums is at most the dimension times the squared
distance, so entries are visited outward from the part's own sum, nearer sums
first, until the squared gap over the dimension strictly exceeds the best
distance; an entry at the same distance with a lower index is therefore never
missed. The search works on many parts side by side and visits, for each, its
own entries only.

A round is one pass over the stored integer vectors. A task returns a sum and a
count for each (part, entry, position), at most ``parts * entries * (width + 1)``
numbers whatever its rows; Spark adds them up and the driver sees the totals.

Edge cases: rows with a null or non-finite vector are dropped (see
``vectors``), a length that the parts don't divide is filled with zeros; null
ids come last in the order of ids, equal ids in the order of their vectors, and
every repeated row gets its code; fewer rows than entries give smaller
codebooks; an empty table gives an empty result and empty codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import discard, within, written
from transitlens.llm.vectors import integer_vectors, matrix, portions

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: vectors searched side by side
BATCH = 8192
#: labels whose totals are broadcast (16 bytes each and a label); more are joined by shuffle, hot ones salted
BROADCAST_LABELS = 100_000
SALTS = 32


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (ties to the lower index) and its squared distance."""
    k, d = entries.shape
    sums = entries.sum(1)
    order = np.argsort(sums, kind="stable")
    # Doubles hold these whole numbers exactly below 2^53 and are compared faster.
    reach = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    exact = np.float64 if d * (2 * reach) ** 2 < 1 << 53 else np.int64
    table, ranked, rows = entries[order].astype(exact), sums[order], x.astype(exact)
    own = x.sum(1)
    right = np.searchsorted(ranked, own)
    left = right - 1
    best = np.full(len(x), np.iinfo(np.int64).max)
    index = np.full(len(x), k)
    padded = np.concatenate([ranked, [0]])
    far = np.int64(1) << 40
    live = np.arange(len(x))
    while len(live):
        lo, hi, s = left[live], right[live], own[live]
        gap_left = np.where(lo >= 0, s - padded[lo], far)
        gap_right = np.where(hi < k, padded[hi] - s, far)
        gap = np.minimum(gap_left, gap_right)
        # The margin only lets a search go on: rounding never ends one early.
        going = (gap < far) & (gap.astype(float) ** 2 <= d * best[live].astype(float) * (1 + 1e-12))
        live, lo, hi = live[going], lo[going], hi[going]
        leftward = gap_left[going] <= gap_right[going]
        at = np.where(leftward, lo, hi)
        left[live] -= leftward
        right[live] += ~leftward
        gaps = rows[live] - table[at]
        distance = np.einsum("ij,ij->i", gaps, gaps).astype(np.int64)
        entry = order[at]
        better = (distance < best[live]) | (distance == best[live]) & (entry < index[live])
        won = live[better]
        best[won], index[won] = distance[better], entry[better]
    return index, best


def _cut(v: np.ndarray, books: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    width = books.shape[2]
    for p in range(len(books)):
        yield p, v[:, p * width:(p + 1) * width]


def _first_books(vectors: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """(part, entry, position): the parts of the rows with the smallest ids; at most ``entries`` rows are fetched."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    v = matrix(first["v"], width)
    return np.ascontiguousarray(v.reshape(len(v), parts, width // parts).transpose(1, 0, 2))


def _refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, then every used entry to the floor of its parts' mean."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in portions(batches, BATCH):
            for p, x in _cut(matrix(batch.column("v"), parts * width), books):
                index, _ = nearest(x, books[p])
                order = np.argsort(index, kind="stable")
                used, start = np.unique(index[order], return_index=True)
                total[p, used, :width] += np.add.reduceat(x[order], start, axis=0)
                total[p, used, width] += np.diff([*start, len(x)])
        slots = np.flatnonzero(np.repeat(total[:, :, width].ravel() > 0, width + 1))
        yield pa.record_batch({"slot": pa.array(slots, pa.int64()), "total": pa.array(total.ravel()[slots])})

    found = (vectors.select("v").mapInArrow(sums, "slot long, total long").groupBy("slot")
             .agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).toArrow())
    whole = {s.as_py(): int(t.as_py()) for s, t in zip(found["slot"], found["total"], strict=True)}
    new = books.copy()
    for slot, n in whole.items():
        if slot % (width + 1) == width:  # the count of a used entry, behind its sums
            p, e = divmod(slot // (width + 1), entries)
            new[p, e] = [whole[slot - width + i] // n for i in range(width)]
    return new


def train(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) of ``vectors`` (columns ``id``, ``v``), fitted on all rows."""
    books = _first_books(vectors, width, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = _refined(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """Columns of ``vectors`` but ``v``, with ``code`` (two hex digits a part for up to 256 entries) and ``error``."""
    parts, entries, width = books.shape
    digits = max(2, -(-max(entries - 1, 0).bit_length() // 4))
    carried = [f for f in vectors.schema.fields if f.name != "v"]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, BATCH):
            text, error = [], np.zeros(batch.num_rows, np.int64)
            for p, x in _cut(matrix(batch.column("v"), parts * width), books):
                index, distance = nearest(x, books[p])
                names = np.array([f"{e:0{digits}x}" for e in range(entries)])
                text.append(names[index])
                error += distance
            code = text[0]
            for t in text[1:]:
                code = np.char.add(code, t)
            yield pa.record_batch([*[batch.column(f.name) for f in carried], pa.array(code.tolist(), pa.string()), pa.array(error)],
                                  names=[*[f.name for f in carried], "code", "error"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in carried], "code string", "error long"])
    return vectors.mapInArrow(codes, schema)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_group_total(rows: DataFrame, by: str, value: str, name: str, max_groups: int = BROADCAST_LABELS) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal ``by`` (nulls are one group).

    Sums merge before the shuffle. They are broadcast while there are few; beyond
    that both sides are shuffled by (group, salt), so a hot group meets in many tasks.
    """
    total = F.least(F.sum(F.col(value).cast("decimal(20,0)")), F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("long")
    totals = rows.groupBy(F.col(by).alias("_by")).agg(total.alias(name))
    if within(totals, max_groups):
        return rows.join(F.broadcast(totals), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    spread = totals.withColumn("_of", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return dealt.join(spread, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_salt") == F.col("_of"))).drop("_by", "_salt", "_of")


def compress(df: DataFrame, vec_id: Column, label: Column, vector: str = "embedding", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(``id, label, code, error`` of every kept row as a stored table, codebooks fitted on all kept rows)."""
    vectors, width = integer_vectors(df, scale, {"id": vec_id, "label": label}, vector, parts)
    books = train(vectors, width, parts, entries, rounds)
    coded = written(encode(vectors, books), "codes")
    discard(vectors)
    return coded, books
