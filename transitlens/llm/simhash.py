"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word
shingles. Fingerprints at most ``max_bits`` apart are linked; documents in one
connected component are one group.

Links are found over distinct fingerprints. The 64 bits are cut into segments;
if two fingerprints differ in at most ``max_bits`` bits, some segment differs in
at most its share of them, so probing each segment table with the small Hamming
ball around a fingerprint's own segment meets every link. Each candidate's
complete distance is then checked.

A segment value shared by more than ``dense`` fingerprints would meet them all
with each other. Such fingerprints take an exact path without pairs: two of
them are within ``max_bits`` if and only if their balls of half that radius
share a point, so each point links its fingerprints to their smallest. At most
as many distinct fingerprints as a ball has points can share one point.

Edge cases: a null or blank text has fingerprint zero and is linked like any
other; a null id takes part, but the component's id is its smallest non-null
id (null if none has one); repeated rows stay; empty tables give empty results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import AUTO_ROWS, by_shuffle_beyond, fresh, written, written_counted
from transitlens.llm.components import stars

# Fixed values of the fingerprint.
SEED = 42
BITS = 64

SEGMENTS = 3
DENSE = 256
#: crowded segment values, or rows that stay, that may be broadcast
BROADCAST_ROWS = 1_000_000
#: fingerprints of one task whose ball points are made
BALLS = 2048


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of one UTF-8 text."""
    words = (text or b"").lower().split()  # on bytes both follow ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1:], strict=False)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a long text
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(texts: Column, shingle: int) -> Column:
    """Fingerprint column (bigint) of a text column."""

    @F.arrow_udf("long")
    def simhash(batch: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in batch.cast(pa.binary())], pa.int64())

    return simhash(texts)


def ball_masks(bits: int, radius: int) -> list[int]:
    """All values of ``bits`` bits with at most ``radius`` ones."""
    return [sum(1 << b for b in chosen) for k in range(radius + 1) for chosen in combinations(range(bits), k)]


def segment_plan(segments: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each segment.

    If the first ``rest + 1`` segments differed in over ``share`` bits and the
    others in over ``share - 1``, all would differ in over ``max_bits``. A segment
    whose radius would be negative needs no table.
    """
    share, rest = divmod(max_bits, segments)
    plan, shift = [], 0
    for i in range(segments):
        bits = BITS // segments + (i < BITS % segments)
        plan.append((shift, bits, share if i <= rest else share - 1))
        shift += bits
    return [p for p in plan if p[2] >= 0]


def _segment(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _literals(masks: list[int]) -> Column:
    # one folded literal, not thousands in every plan
    return F.split(F.lit(",".join(str(m - (1 << 64) if m >= 1 << 63 else m) for m in masks)), ",").cast("array<bigint>")


def _probes(fp: Column, i: int, shift: int, bits: int, radius: int) -> Column:
    """Keys of the small ball around segment ``i`` of a fingerprint."""
    own = _segment(fp, shift, bits)
    return F.transform(_literals(ball_masks(bits, radius)),
                       lambda m: F.struct(F.lit(i).alias("seg"), own.bitwiseXOR(m).alias("value")))


def _points(members: DataFrame, radius: int) -> DataFrame:
    """``fp, point``: every point of the ball around each fingerprint."""
    ball = _literals(ball_masks(BITS, radius))
    return members.select("fp", F.explode_outer(F.transform(ball, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))


def _star_links(members: DataFrame, max_bits: int) -> DataFrame:
    """Edges through shared ball points: each point's fingerprints to its smallest one.

    Points are some thousand times the fingerprints that Spark's estimate is
    made of, so their joins are never left to it.
    """
    points = _points(members, max_bits // 2)
    if max_bits % 2:  # an odd distance: one of the two balls reaches a bit further
        other = _points(members, max_bits // 2 + 1).withColumnRenamed("fp", "v").hint("merge")
        return points.join(other, "point").where("fp != v").select(F.col("fp").alias("u"), "v")
    least = points.groupBy("point").agg(F.min("fp").alias("v"), F.max("fp").alias("w")).where("v != w")
    return (points.join(least.select("point", "v").hint("merge"), "point").where("fp != v")
            .select(F.col("fp").alias("u"), "v"))


def links(nodes: DataFrame, max_bits: int, segments: int = SEGMENTS, dense: int = DENSE, rows: int = 0) -> DataFrame:
    """Edges ``u, v`` that connect exactly the fingerprints linked directly or through others.

    ``nodes`` has distinct ``fp``, at most ``rows``. Each edge joins two fingerprints within ``max_bits``
    (by the pair check) or sharing a ball point (hence within ``max_bits``).
    """
    plan = segment_plan(segments, max_bits)
    fp = F.col("fp")
    own = F.array(*[F.struct(F.lit(i).alias("seg"), _segment(fp, s, b).alias("value"))
                    for i, (s, b, _) in enumerate(plan)])
    near = F.concat(*[_probes(fp, i, *p) for i, p in enumerate(plan)])
    table = nodes.select("fp", F.explode_outer(own).alias("k")).select("fp", "k.seg", "k.value")
    probes = nodes.select("fp", F.explode_outer(near).alias("k")).select("fp", "k.seg", "k.value")
    crowded, n = written_counted(table.groupBy("seg", "value").agg(F.count("*").alias("n")).where(F.col("n") > dense)
                                 .select("seg", "value"), "crowded")
    starred = None
    if n:
        hot = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded.hint("merge")
        members, m = written_counted(probes.join(hot, ["seg", "value"], "left_semi").select("fp").distinct(), "dense")
        table = table.join(hot, ["seg", "value"], "left_anti")
        starred = _star_links(members.repartition(-(-m // BALLS)), max_bits)
    met = (probes.select(F.col("fp").alias("u"), "seg", "value")
           .join(by_shuffle_beyond(table.select(F.col("fp").alias("v"), "seg", "value"), len(plan) * rows), ["seg", "value"])
           .where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
           .select("u", "v"))
    return met if starred is None else met.unionByName(starred)


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text",
                    segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Per row: the id, ``fp`` (bigint), ``root`` and ``component_id``, the smallest id of its group.

    ``root`` names the group by its smallest fingerprint.
    """
    marked = written(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")),
                     "fingerprints")
    nodes, n = written_counted(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fp-nodes")
    linked = stars(links(nodes.select("fp"), max_bits, segments, dense, n)).withColumnsRenamed({"u": "fp", "v": "_v"})
    grouped = (nodes.join(by_shuffle_beyond(linked, n), "fp", "left")
               .select("fp", "rep", F.coalesce("_v", "fp").alias("root")))
    smallest = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    # One row per fingerprint: a fingerprint with very many copies is split by the skew join. Left to itself, Spark
    # could broadcast all rows, whose file is small where copies are many.
    named = grouped.select("fp", "root").join(by_shuffle_beyond(smallest, n), "root")
    named = F.broadcast(named) if n <= AUTO_ROWS else named.hint("merge")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left of each group: the smallest id's, null ids last, then by position.

    Rows are numbered once and stored with their numbers: a number given anew
    at every reading would depend on how files are dealt over tasks then. Only
    the first row of each fingerprint is carried to its group.
    """
    row = fresh("_row", docs.columns)
    fp = fresh("_fp", docs.columns)
    placed, n = written_counted(docs.withColumns({row: F.monotonically_increasing_id(),
                                                  fp: fingerprints(F.col(text), shingle)}), "numbered")
    first = F.struct(F.col(doc_id).isNull().alias("a"), F.col(doc_id).alias("doc_id"), F.col(row).alias("row"))
    nodes = written(placed.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), "fp-nodes")
    linked = stars(links(nodes.select("fp"), max_bits, rows=n)).withColumnRenamed("u", "fp")
    grouped = (nodes.join(by_shuffle_beyond(linked, n), "fp", "left")
               .groupBy(F.coalesce("v", "fp")).agg(F.min("first").alias("w")))
    winners, kept = written_counted(grouped.select(F.col("w.row").alias(row)), "winners")
    winners = F.broadcast(winners) if kept <= BROADCAST_ROWS else winners.hint("merge")
    return placed.join(winners, row, "left_semi").select(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
