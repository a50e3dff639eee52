"""Jump consistent hashing: stable keys to shards without a ring table.

A key's jumps 0 = j0 < j1 < ... come from a 64-bit linear congruential
generator seeded with the key; with ``n`` shards the key lives in the last jump
below ``n``. One more shard therefore moves only the keys whose next jump is
that shard.

Native column expressions throughout. The generator works on two 32-bit halves
held as longs, so nothing overflows, whatever the session's ANSI setting.

Edge cases: a null key is key 0; a null text has no bytes (size 1, crc 0);
repeated rows each get a slot; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitlens.llm.common import discard, text_or_empty, written

# The published generator of jump consistent hashing.
MULTIPLIER = 2862933555777941757
INCREMENT = 1

_M_HI, _M_LO = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_MASK = 0xFFFFFFFF


def _low32(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MASK))


def _times32(a: Column, m: int) -> tuple[Column, Column]:
    """(high, low) 32-bit halves of ``a * m`` for unsigned 32-bit ``a`` and ``m``."""
    low = a.bitwiseAND(F.lit(0xFFFF)) * F.lit(m)
    high = F.shiftright(a, 16) * F.lit(m)
    s = low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)
    return F.shiftright(s, 32) + F.shiftright(high, 16), _low32(s)


def _advance(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's next state, modulo 2^64, as two halves."""
    carry, low = _times32(lo, _M_LO)
    low = low + F.lit(INCREMENT)
    cross = _times32(lo, _M_HI)[1] + _times32(hi, _M_LO)[1]
    return _low32(carry + F.shiftright(low, 32) + cross), _low32(low)


def jump_shards(key: Column, counts: Sequence[int]) -> Column:
    """Struct ``s0, s1, ...``: the shard of a bigint key for each shard count."""
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(_low32(F.shiftrightunsigned(key, 32)).alias("hi"), _low32(key).alias("lo"),
                     F.lit(0).cast("bigint").alias("j"),
                     *[F.lit(0).cast("int").alias(f"s{i}") for i in range(len(counts))])

    def step(s: Column, _: Column) -> Column:
        hi, lo = _advance(s["hi"], s["lo"])
        r = F.shiftright(hi, 1) + F.lit(1)
        j = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(2147483648.0) / r.cast("double")))
        return F.when(s["j"] >= F.lit(max(counts)), s).otherwise(F.struct(
            hi.alias("hi"), lo.alias("lo"), j.alias("j"),
            *[F.when(j < F.lit(n), j.cast("int")).otherwise(s[f"s{i}"]).alias(f"s{i}")
              for i, n in enumerate(counts)]))

    # Jumps strictly increase, so as many steps as shards always suffice.
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(counts))), start, step)


def assign_shards(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Slots number a shard's rows gaplessly in key order without gathering a
    shard in one task: rows are range-partitioned by (shard, key, scan order)
    and numbered inside their partition; the counts of the (shard, partition)
    pairs, at most partitions plus shards many, give each its first slot.
    """
    spark = docs.sparkSession
    body = F.encode(text_or_empty(text), "UTF-8")
    s = F.col("_s")
    narrow = (docs.select(F.col(key).alias(key), F.octet_length(body).cast("bigint").alias("_n"),
                          F.crc32(body).alias("text_crc32"),
                          jump_shards(F.col(key), (n_shards, n_shards + 1)).alias("_s"),
                          F.monotonically_increasing_id().alias("_tie"))
              .select(key, (F.col("_n") + 1).alias("size"), "text_crc32", s["s0"].alias("shard"),
                      s["s1"].alias("grown_shard"), "_tie"))
    narrow = written(narrow, "shard-rows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", key, "text_crc32", "_tie"]
    dealt = written(narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()), "shard-slots")
    discard(narrow)
    part = F.shiftright(F.col("_at"), 33)
    counts = dealt.groupBy("shard", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_part", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # At most one row for each partition and shard boundary: a bounded broadcast.
    return (dealt.withColumn("_part", part).join(F.broadcast(starts), ["shard", "_part"])
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_start") + F.col("_at") - F.col("_first")).alias("slot"), "grown_shard"))
