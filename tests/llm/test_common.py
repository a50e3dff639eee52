import pyarrow as pa

from transitlens.llm.common import fresh, slices, small_batches, without


def test_slices_cut_and_join_batches():
    texts = ["", None, "a" * 10, "b" * 90, "c" * 500, "d" * 5, "é" * 30] * 7
    cut = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 3], pa.string()), pa.array(range(i, min(i + 3, len(texts))))],
                                      ["text", "k"]) for i in range(0, len(texts), 3)]
    for limit, rows in ((100, 4096), (10 ** 9, 4096), (10 ** 9, 5), (1, 4096)):
        got = list(slices(iter(cut), "text", limit, rows))
        assert sum((p.column("k").to_pylist() for p in got), []) == list(range(len(texts)))
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= limit for p in got)
        assert all(p.num_rows <= rows for p in got)
    assert len(list(slices(iter(cut), "text", 10 ** 9))) == 1 and not list(slices(iter([]), "text"))


def test_names():
    assert fresh("_p", ["a", "_P", "_p_"]) == "_p__" and without(["A", "b"], ("a",)) == ["b"]


def test_batch_size_keeps_a_choice_of_the_session(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        small_batches(spark)
        assert spark.conf.get(key) == "1000"
        spark.conf.set(key, "77")
        small_batches(spark)
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.set(key, old)
