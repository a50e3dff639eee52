"""The corpus pipeline: every stage works on all that its predecessor kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes to the shared folder and reads
back as the next stage's input. All but the last return the columns of
documents; the last one returns the packed pieces.

No stage but the third can be said in SQL (trained models, 64-bit hashes, BPE),
so the pipeline has no ``ORACLE_SQL``; tests hold it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm import langid, packing, pii, simhash
from transitlens.llm.common import discard, id_bucket, load, small_batches, written
from transitlens.llm.decontaminate import decontaminate

SHINGLE = 4
MAX_BITS = 4
#: a text that resembles no learned language scores below this
LEAST_SCORE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; a missing ``lang`` is filled by the prediction."""
    small_batches(spark)
    model = langid.train(docs.where(id_bucket(F.col("doc_id"), 4) != 2))
    judged = langid.identify(docs, model)
    kept = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return simhash.one_of_each_group(docs, SHINGLE, MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    judged = decontaminate(docs, load(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` counted anew."""
    small_batches(spark)
    found = pii.find_pii(docs, pii.train(docs), redact=True)
    changed = found.withColumn("text", F.col("redacted"))
    changed = changed.withColumn("n_chars", F.when(F.col("n_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                                 .otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
