"""Best-fit-decreasing packing of tokenized documents into fixed-length sequences.

Piece lengths are whole numbers up to the sequence length, so the packing is
planned on the histogram of lengths: pieces of one length are interchangeable,
and so are open bins with one remaining capacity. The plan runs best fit
decreasing over these classes - a segment tree over remaining capacities finds
the tightest class that still takes a length in logarithmic time - and is the
packing that piece-by-piece best fit decreasing would make. It holds at most
``sequence length`` squared rows whatever the corpus size; only the histogram
reaches the driver. Pieces are then numbered within their length across all
tasks, and a piece's number gives its bin and place in the plan.

Edge cases: a null text is empty and has the end token alone; repeated rows and
null ids are packed like any other; an empty table gives no sequences.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitlens.llm.common import slices, written

SEQUENCE = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file; its ids are merge ranks, which is all that BPE needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # Byte-level vocabularies print a byte as itself where it is printable, else as a code point from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


def token_ids(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text; strings of special tokens get their ids, none is added."""
    return bpe.encode_to_numpy(text, allowed_special="all")


def piece_bounds(length: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but a shorter first one."""
    first = length % sequence or min(length, sequence)
    return [(0, first), *[(at, sequence) for at in range(first, length, sequence)]]


def tokenized_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
                     doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, its ``ids``."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)  # once a task
        for part in slices(batches, "text"):
            origin, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, value in enumerate(part.column("text").to_pylist()):
                tokens = np.append(token_ids(bpe, value or ""), end_id).astype("<u4")
                for k, (at, n) in enumerate(piece_bounds(len(tokens), sequence)):
                    own = tokens[at:at + n]
                    origin.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(own.tobytes()))
                    if keep_ids:
                        ids.append(own.astype("i4"))
            columns = [part.column("doc_id").take(pa.array(origin, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                             + ", ids array<int>" * keep_ids)


class OpenBins:
    """Open bins grouped by remaining capacity, under a segment tree that marks the capacities in use."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, r: int) -> None:
        at = r + self.leaves
        self.used[at] = bool(self.groups[r])
        while at > 1:
            at //= 2
            self.used[at] = self.used[2 * at] or self.used[2 * at + 1]

    def put(self, r: int, first: int, count: int) -> None:
        """``count`` bins from number ``first`` on, each with ``r`` left."""
        if count and r:
            self.groups[r].append((first, count))
            self._mark(r)

    def tightest(self, size: int) -> int | None:
        """The smallest capacity in use that takes ``size``."""
        at = size + self.leaves
        if self.used[at]:
            return size
        while at > 1:  # up to the first right neighbour with a mark, then down its left-most one
            if at % 2 == 0 and self.used[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.used[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None

    def take(self, r: int) -> tuple[int, int]:
        group = self.groups[r].pop()
        self._mark(r)
        return group


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from, to, first bin, pieces a bin, offset): pieces ``from``..``to`` of a length fill bins in order."""
    bins, rows, opened = OpenBins(capacity), [], 0
    for size in sorted(histogram, reverse=True):
        at, n = 0, histogram[size]
        while at < n:
            r = bins.tightest(size)
            if r is None:
                r, (first, count) = capacity, (opened, -(-(n - at) // (capacity // size)))
                opened += count
            else:
                first, count = bins.take(r)
            each = r // size
            full = min(count, (n - at) // each)
            if full:
                rows.append((size, at, at + full * each, first, each, capacity - r))
                bins.put(r - each * size, first, full)
                at, first, count = at + full * each, first + full, count - full
            if count and at < n:  # the last pieces of this length do not fill one more bin
                rows.append((size, at, n, first, n - at, capacity - r))
                bins.put(r - (n - at) * size, first, 1)
                at, first, count = n, first + 1, count - 1
            bins.put(r, first, count)
    return rows


def numbered(pieces: DataFrame, salts: int) -> DataFrame:
    """``pieces`` (with a unique ``_tie``) with ``_rank``, gapless from 0 within each length.

    A length may hold most rows, so it is numbered in ``salts`` parts whose
    counts, at most lengths times salts many, give each part its first number.
    """
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_tie"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_tie")) - 1
    return (salted.withColumn("_at", inside).join(starts, ["length", "_salt"])
            .withColumn("_rank", F.col("_start") + F.col("_at")).drop("_salt", "_at", "_start"))


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (any table with ``length``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    stored = written(pieces.withColumn("_tie", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(best_fit_plan(histogram, sequence), np.int64).reshape(-1, 6)
    sent = spark.sparkContext.broadcast(plan[np.lexsort((plan[:, 1], plan[:, 0]))])
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sent.value
        firsts = np.searchsorted(rows[:, 0], np.arange(sequence + 2))
        for b in batches:
            size = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            row = np.empty(len(size), np.int64)
            for s in np.unique(size):
                here = size == s
                lo, hi = firsts[s], firsts[s + 1]
                row[here] = lo + np.searchsorted(rows[lo:hi, 1], rank[here], side="right") - 1
            _, start, _, bin_, each, offset = rows[row].T
            k = rank - start
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bin_ + k // each), pa.array(offset + k % each * size)],
                [*names, "sequence_id", "offset"])

    names = pieces.columns
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return numbered(stored, salts).select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
                   doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    path = path or public_tokenizers.path(VOCABULARY)
    return pack(tokenized_pieces(docs, path, sequence, end_id, doc_id, text, keep_ids), sequence)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token sequences of a packing made with ``keep_ids``; none is longer than the bound."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
