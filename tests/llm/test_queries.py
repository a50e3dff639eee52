"""Registered queries: SQL twins, and the contracts' columns."""

import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tools.compare import compare
from transitlens.llm import packing, pii, simhash
from transitlens.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_html": "page_id url text n_chars",
    "op2_language_model": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_language": "doc_id held_out lang_pred score",
    "op7_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op8_token_counts": "source lang tokenizer docs tokens",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_codes": "vec_id code error label_error codebooks_sha256",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, name):
    ok, message = compare(QUERIES[name](spark, SF_SMALL), SQL[name], SF_SMALL)
    assert ok, message


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    wanted = COLUMNS[name].split()
    assert df.columns[:len(wanted)] == wanted
    table = {"op1_html": "pages", "op11_codes": "embeddings"}.get(name, "documents")
    if name not in ("op4_packing", "op8_token_counts", "op12_hard_negatives"):
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(10 ** 6, None, "en", "s", None), (10 ** 6 + 1, "12 34 %", None, "s", 7)], docs.schema)
    path = str(tmp_path / "d")
    docs.unionByName(more).write.parquet(path)
    d = spark.read.parquet(path)
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, d = d, stage(spark, d, SF_SMALL)
        assert d.columns == docs.columns and d.dtypes == docs.dtypes, name
        d.write.parquet(f"{path}-{k}")
        d = spark.read.parquet(f"{path}-{k}")
        sizes.append(d.count())
        if k == 0:
            assert {r["doc_id"] for r in before.select("doc_id").subtract(d.select("doc_id")).collect()} == {10 ** 6, 10 ** 6 + 1}
        if k == 1:
            groups = simhash.near_duplicates(before, 4, 4).select("component_id").distinct()
            assert sorted(r[0] for r in groups.collect()) == sorted(r["doc_id"] for r in d.collect())
        if k == 2:
            judged = {r["doc_id"] for r in QUERIES["op7_decontamination"](spark, SF_SMALL).where("contaminated").collect()}
            gone = {r["doc_id"] for r in before.select("doc_id").subtract(d.select("doc_id")).collect()}
            assert gone == judged & {r["doc_id"] for r in before.collect()} and gone
        if k == 3:
            for r in d.collect():
                assert not pii.strict_spans(r["text"]) and r["n_chars"] == len(r["text"])
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    pieces = corpus_pipeline.best_fit(spark, d, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == sizes[-1]
    assert pieces.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= packing.SEQUENCE


def test_pipeline_on_an_empty_table(spark, tmp_path):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, SF_SMALL).write.parquet(f"{tmp_path}/{k}")
        d = spark.read.parquet(f"{tmp_path}/{k}")
        assert d.count() == 0
