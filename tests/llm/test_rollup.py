import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from transitlens.llm import rollup as R

SCHEMA = "source string, lang string, tokenizer string, tokens long, sign int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_any_order_repeats_and_compaction_give_the_same_totals(spark, tmp_path):
    rnd = random.Random(2)
    batches = {b: [(rnd.choice(["a", "b", None]), rnd.choice(["en", None]), "v1", rnd.choice([0, 5, 7, None]),
                    rnd.choice([1, -1, None])) for _ in range(30)] for b in range(5)}
    expected = defaultdict(lambda: [0, 0])
    for s, lang, v, n, sign in sum(batches.values(), []):
        sign = 1 if sign is None else sign
        expected[s, lang, v][0] += sign
        expected[s, lang, v][1] += sign * (n or 0)
    want = sorted(((*k, *v) for k, v in expected.items() if any(v)), key=str)
    store = R.TokenRollup(spark, str(tmp_path / "r"))
    assert store.totals().count() == 0
    for b in (3, 0, 3, 4, 1):
        assert store.apply(b, spark.createDataFrame(batches[b], SCHEMA))
    store.compact()
    assert not store.apply(3, spark.createDataFrame(batches[3], SCHEMA))
    store.apply(2, spark.createDataFrame(batches[2], SCHEMA))
    store.apply(2, spark.createDataFrame(batches[2], SCHEMA))
    assert rows_of(store.totals()) == want
    store.compact()
    assert rows_of(store.totals()) == want and store.committed() == [] and store.folded() == set(range(5))


def test_a_failed_write_or_half_made_base_is_not_read(spark, tmp_path):
    store = R.TokenRollup(spark, str(tmp_path / "r"))
    store.apply(1, spark.createDataFrame([("a", "en", "v", 3, 1)], SCHEMA))
    (tmp_path / "r" / "deltas" / "batch=2").mkdir()
    (tmp_path / "r" / "base" / "version=0" / "totals").mkdir(parents=True)
    assert store.committed() == [1] and rows_of(store.totals()) == [("a", "en", "v", 1, 3)]
    store.compact()
    assert rows_of(store.totals()) == [("a", "en", "v", 1, 3)]


def test_revision_and_delete_leave_nothing(spark, tmp_path):
    store = R.TokenRollup(spark, str(tmp_path / "r"))
    docs = spark.createDataFrame([("a", "en", "one two"), ("a", "en", None), ("b", None, "x " * 50000)], "source string, lang string, text string")
    store.apply(1, R.counted(docs, "words-1"))
    assert rows_of(store.totals()) == [("a", "en", "words-1", 2, 2), ("b", None, "words-1", 1, 50000)]
    store.apply(2, R.counted(docs, "words-1", -1))
    store.apply(3, R.counted(docs.limit(0), "words-1"))
    assert store.totals().count() == 0 and store.committed() == [1, 2, 3]


def test_counts_with_and_without_repeated_lines(spark):
    df = spark.createDataFrame([("a b\nc, d\na b",), ("one two",), (None,), ("",), ("x\nx",)], "text string")
    got = [tuple(r) for r in R.with_counts(df).collect()]
    assert got == [(6, 7, 4, 5), (2, 2, 2, 2), (0, 0, 0, 0), (0, 0, 0, 0), (2, 2, 1, 1)]


def test_a_repeat_that_fails_midway_leaves_the_committed_batch(spark, tmp_path):
    store = R.TokenRollup(spark, str(tmp_path / "r"))
    rows = spark.createDataFrame([("a", "en", "v", 3, 1), ("b", "en", "v", 4, 1)], SCHEMA)
    store.apply(1, rows)
    want = rows_of(store.totals())
    broken = rows.withColumn("tokens", F.when(F.col("source") == "b", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("tokens")))
    with pytest.raises(Exception, match="lost"):
        store.apply(1, broken)
    assert rows_of(store.totals()) == want and store.committed() == [1]
    again = R.TokenRollup(spark, str(tmp_path / "r"))
    assert again.apply(1, rows) and rows_of(again.totals()) == want
    assert len(list((tmp_path / "r" / "deltas" / "batch=1").glob("write=*"))) == 1


def test_counts_keep_columns_with_clashing_names(spark):
    df = spark.createDataFrame([("a b", 7, "y")], "text string, _lines int, _ONCE string")
    got = R.with_counts(df)
    assert got.columns[:2] == ["_lines", "_ONCE"] and got.first()[:2] == (7, "y")
