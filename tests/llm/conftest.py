import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Build a documents table, written once so that it is a stored table with several files."""

    def make(rows, tmp_path, parts=3):
        full = [(r + (None,) * 5)[:5] for r in rows]
        full = [(i, t, lang, s, len(t) if t is not None and n is None else n) for i, t, lang, s, n in full]
        path = str(tmp_path / "documents.parquet")
        spark.createDataFrame(full, DOC_SCHEMA).repartition(parts).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
