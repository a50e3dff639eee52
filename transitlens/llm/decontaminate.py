"""Benchmark decontamination by winnowing, in native column expressions.

Words of a text are cut into k-grams and hashed; of every run of ``w``
consecutive k-grams the smallest hash is kept as a fingerprint (ties keep all).
Two texts that share ``w + k - 1`` consecutive words choose the same
fingerprint inside that span, so joining document and benchmark fingerprints
misses no shared window. Every hit is then extended word by word, at most
``w - 1`` to each side; words of a hit that reaches the full window length are
contaminated.

With windows of 10 words ``k`` is 5 and ``w`` 6. An item with fewer words is one
window of its own length ``n``: ``k = min(5, n)``, ``w = n - k + 1``. Only lengths
that occur are searched.

Scale: fingerprints of documents are streamed against those of the benchmark;
the benchmark side is broadcast behind a row count, else both are shuffled by
hash. Work on hits is per distinct text (md5 of the text), so copies cost
nothing twice, and only texts with a fingerprint hit are read a second time.

Edge cases: a null text has no words; null or repeated ids are rows of their
own; equal items share hits; an item id is compared as text, a null one counts
as empty; empty tables give no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import (broadcast_if, fresh, lower_ascii, text_key, text_or_empty, within, without,
                                    written)

# Fixed value: characters between words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: fingerprints (hash, item, position and up to 15 words) that may be broadcast
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(lower_ascii(text), SEPARATORS), lambda w: w != F.lit(""))


def _gram_sizes(window: int) -> tuple[int, int]:
    k = min(GRAM, window)
    return k, window - k + 1


def gram_hashes(ws: Column, window: int) -> Column:
    """Hash of every k-gram, by position; empty where the text is shorter than the window."""
    k, _ = _gram_sizes(window)
    return F.when(F.size(ws) >= window, F.transform(
        F.sequence(F.lit(0), F.size(ws) - k),
        lambda i: F.xxhash64(F.lit(window), *[F.get(ws, i + j) for j in range(k)]))).otherwise(
            F.array().cast("array<bigint>"))


def window_minima(grams: Column, window: int) -> Column:
    """Smallest hash of each run of ``w`` k-grams."""
    _, w = _gram_sizes(window)
    if w == 1:
        return grams
    return F.when(F.size(grams) >= w, F.transform(
        F.sequence(F.lit(0), F.size(grams) - w),
        lambda i: F.least(*[F.get(grams, i + j) for j in range(w)]))).otherwise(F.array().cast("array<bigint>"))


def anchors(df: DataFrame, window: int, keep: list[str]) -> DataFrame:
    """One row per kept fingerprint: ``keep``, window, hash, position and the words around it.

    A k-gram is kept when it is the smallest of some run that holds it, that
    is when it equals the largest of the minima of those runs.
    """
    k, w = _gram_sizes(window)
    # Outer explodes: for an inner one Spark infers a filter that computes the array a second time.
    d = df.withColumn("_g", gram_hashes(F.col("_words"), window))
    d = d.withColumn("_m", window_minima(F.col("_g"), window))
    # beyond either end there is no run: get() yields null, which greatest() skips
    chosen = F.greatest(F.lit(None).cast("bigint"), *[F.get(F.col("_m"), F.col("_p") - j) for j in range(w)])
    d = (d.select(*keep, "_words", "_m", F.posexplode_outer("_g").alias("_p", "_hash"))
         .where(F.col("_hash") == chosen))
    around = [F.get(F.col("_words"), F.col("_p") + j).alias(f"_w{j + w - 1}") for j in range(1 - w, k + w - 1)]
    return d.select(*keep, F.lit(window).alias("_window"), F.col("_hash"), F.col("_p").alias("_pos"),
                    F.array(*around).alias("_around"))


def _run(flags: Column, longest: int) -> Column:
    """How many leading flags are true."""
    stop = F.array_position(flags, F.lit(False)).cast("int")
    return F.when(stop > 0, stop - 1).otherwise(F.lit(longest))


def extended(met: DataFrame, window: int) -> DataFrame:
    """Hits whose words agree over a whole window, with the words matched on either side of the k-gram."""
    k, w = _gram_sizes(window)
    same = F.zip_with("_around", "_item_around", lambda a, b: F.coalesce(a == b, F.lit(False)))
    met = met.select("text_key", "_item", "_pos", same.alias("_same"))
    met = met.select("text_key", "_item", "_pos",
                     _run(F.slice("_same", w, k), k).alias("_core"),
                     (_run(F.reverse(F.slice("_same", 1, w - 1)), w - 1) if w > 1 else F.lit(0)).alias("_left"),
                     (_run(F.slice("_same", w + k, w - 1), w - 1) if w > 1 else F.lit(0)).alias("_right"))
    return (met.where((F.col("_core") == k) & (F.col("_left") + F.col("_right") + k >= window))
            .select("text_key", F.col("_item").alias("item"), (F.col("_pos") - F.col("_left")).alias("first"),
                    (F.col("_pos") + k + F.col("_right")).alias("last")))


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
              item_text: str = "text") -> DataFrame:
    """Maximal shared spans per distinct text: ``text_key, item, first, last`` (word positions, last exclusive)."""
    items = (benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("_item"),
                              words(text_or_empty(item_text)).alias("_words"))
             .where(F.size("_words") > 0))
    items = written(items.withColumn("_window", F.least(F.size("_words"), F.lit(WINDOW))), "items")
    # at most ten different window lengths exist
    windows = sorted(r["_window"] for r in items.select("_window").distinct().collect())
    if not windows:
        empty = "text_key binary, item string, first int, last int"
        return docs.sparkSession.createDataFrame([], empty)

    prints = written(reduce(DataFrame.unionByName, [
        anchors(items.where(F.col("_window") == n).drop("_window"), n, ["_item"]) for n in windows]).select(
            "_item", "_window", "_hash", F.col("_around").alias("_item_around")), "item-prints")
    small = within(prints, BROADCAST_ROWS)
    hashes = prints.select("_hash").distinct()
    hashes = F.broadcast(hashes) if small else hashes
    prints = F.broadcast(prints) if small else prints

    body = text_or_empty(text)
    texts = docs.select(body.alias("_text"))
    kept = texts.select(text_key(F.col("_text")).alias("text_key"), words(F.col("_text")).alias("_words"))
    # A column for each step: a lambda must not hold the work of the step before it.
    for n in windows:
        kept = kept.withColumn(f"_g{n}", gram_hashes(F.col("_words"), n))
    for n in windows:
        kept = kept.withColumn(f"_m{n}", window_minima(F.col(f"_g{n}"), n))
    kept = kept.select("text_key", F.array_distinct(F.concat(*[F.col(f"_m{n}") for n in windows])).alias("_kept"))
    candidates = written(kept.select("text_key", F.explode_outer("_kept").alias("_hash"))
                         .join(hashes, "_hash", "left_semi").select("text_key").distinct(), "candidates")

    # Second look, at candidate texts alone and once per distinct text.
    again = (texts.withColumn("text_key", text_key(F.col("_text")))
             .join(broadcast_if(candidates, 1_000_000), "text_key", "left_semi")
             .groupBy("text_key").agg(F.first("_text").alias("_text"))
             .select("text_key", words(F.col("_text")).alias("_words")))
    found = [extended(anchors(again, n, ["text_key"])
                      .join(prints.where(F.col("_window") == n).drop("_window"), "_hash"), n) for n in windows]
    return reduce(DataFrame.unionByName, found)


def contamination(hits: DataFrame) -> DataFrame:
    """Per distinct text with hits: ``n_hit``, ``n_items``, ``items_sha256``.

    Rows per text and item are bounded by that text's own words and the
    benchmark; overlapping spans count each word once.
    """
    covered = (hits.select("text_key", F.explode(F.sequence("first", F.col("last") - 1)).alias("_at")).distinct()
               .groupBy("text_key").agg(F.count("*").alias("n_hit")))
    named = (hits.select("text_key", "item").distinct().groupBy("text_key")
             .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("_items"))
             .select("text_key", "n_items",
                     F.sha2(F.encode(F.array_join("_items", ","), "UTF-8"), 256).alias("items_sha256")))
    return covered.join(named, "text_key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated`` per row."""
    found = written(contamination(find_hits(docs, benchmark, text, item_id, item_text)), "contamination")
    added = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    own = without(docs.columns, added)
    key = fresh("_key", docs.columns)
    body = text_or_empty(text)
    out = docs.select(*own, F.size(words(body)).cast("bigint").alias("n_words"), text_key(body).alias(key))
    hit = broadcast_if(found.withColumnRenamed("text_key", key), 1_000_000)
    return out.join(hit, key, "left").select(
        *own, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
