"""One query per training-data operator: ``QUERIES`` and, where SQL can say it, ``SQL``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm import codes as _codes
from transitlens.llm import decontaminate as _decontaminate
from transitlens.llm import editprint as _editprint
from transitlens.llm import hardneg as _hardneg
from transitlens.llm import langid as _langid
from transitlens.llm import maxent as _maxent
from transitlens.llm import packing as _packing
from transitlens.llm import pii as _pii
from transitlens.llm import queries_sql as _sql
from transitlens.llm import rollup as _rollup
from transitlens.llm import secrets as _secrets
from transitlens.llm import sharding as _sharding
from transitlens.llm import simhash as _simhash
from transitlens.llm import styletree as _styletree
from transitlens.config import scratch_path
from transitlens.llm.common import id_bucket, load, small_batches, written

N_SHARDS = 16
SHINGLE = 4
MAX_BITS = 4


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _styletree.extract(load(spark, sf_dir, "pages"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maxent.score(load(spark, sf_dir, "documents"), id_bucket(F.col("doc_id"), 10) == 0)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.assign_shards(load(spark, sf_dir, "documents"), N_SHARDS)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack_documents(load(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _editprint.edit_report(load(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    model = _langid.train(docs.where(~held_out))
    return _langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return _decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark")).drop("text")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after five commits: all documents by either tokenizer, a revision, a delete, and a repeat.

    The revision strips the repeated lines from documents labelled low in quality (the first of equal
    lines stays); the delete drops documents labelled toxic, with their revised counts.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counts = written(_rollup.with_counts(docs), "token-counts")  # texts are read once and never shuffled
    labels = (load(spark, sf_dir, "labels").groupBy("doc_id")
              .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    judged = counts.join(labels, "doc_id")
    low = judged.where("quality = 0")
    store = _rollup.TokenRollup(spark, scratch_path(spark, "token-rollup"))

    def rows(frame: DataFrame, sign: int, tokens: Callable[[str], Column]) -> DataFrame:
        return reduce(DataFrame.unionByName, [_rollup.signed(frame, v, tokens(v), sign) for v in _rollup.TOKENIZERS])

    revision = rows(low, -1, F.col).unionByName(rows(low, 1, lambda v: F.col(f"{v} once")))
    delete = rows(judged.where("toxic = 1"), -1,
                  lambda v: F.when(F.col("quality") == 0, F.col(f"{v} once")).otherwise(F.col(v)))
    for batch, version in enumerate(_rollup.TOKENIZERS, 1):
        store.apply(batch, _rollup.signed(counts, version, F.col(version)))
    store.apply(3, revision)
    store.apply(4, delete)
    store.apply(3, revision)  # a repeated batch changes nothing
    return store.totals()


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.near_duplicates(load(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)
    return found.select("doc_id", _simhash.hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return _pii.find_pii(docs, _pii.train(docs)).drop("text")


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = _codes.compress(load(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("label"))
    summed = _codes.with_group_total(coded, "label", "error", "label_error")
    return summed.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                         F.lit(_codes.digest(books)).alias("codebooks_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return _hardneg.mine(load(spark, sf_dir, "embeddings"), vec_id, moved, F.col("id") % 100 == 0)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = _secrets.find_secrets(docs, _secrets.train(docs))
    counts = [_secrets.count_of("base", kind).alias(f"n_{kind}") for kind in _secrets.PATTERNS]
    return found.select("doc_id", *counts, F.sha2(_secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        _secrets.listed(F.col("spans")).alias("spans"))


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": _bounded(op1_html),
    "op2_language_model": _bounded(op2_language_model),
    "op3_sharding": op3_sharding,
    "op4_packing": _bounded(op4_packing),
    "op5_fingerprints": _bounded(op5_fingerprints),
    "op6_language": _bounded(op6_language),
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_simhash": _bounded(op9_simhash),
    "op10_pii": _bounded(op10_pii),
    "op11_codes": op11_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secrets": op13_secrets,
}

# The others need trained models, 64-bit hashes of shingles, or a BPE: tests hold them against brute force.
SQL: dict[str, str] = {
    "op1_html": _sql.OP1,
    "op3_sharding": _sql.OP3,
    "op7_decontamination": _sql.OP7,
    "op8_token_counts": _sql.OP8,
    "op11_codes": _sql.OP11,
    "op12_hard_negatives": _sql.OP12,
}
