from collections import Counter

from transitlens.llm.sharding import assign_shards, jump_shards


def jump(key, n):
    key, b, j = (key or 0) % 2 ** 64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_matches_the_published_algorithm(spark):
    keys = [0, 1, 2, 12345, 2 ** 31, 2 ** 62, -1, -(2 ** 63), 2 ** 63 - 1, None, *range(1000, 1400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for r in df.select("k", jump_shards(df["k"], (1, 2, 16, 17, 1000)).alias("s")).collect():
        assert list(r["s"])[-5:] == [jump(r["k"], n) for n in (1, 2, 16, 17, 1000)]


def test_slots_growth_sizes_and_odd_rows(spark, docs, tmp_path):
    rows = [(i, f"text {i % 7}") for i in range(500)] + [(None, None), (None, ""), (3, "é"), (3, "é"), (3, "é" * 100000)]
    got = assign_shards(docs(rows, tmp_path), 16).collect()
    assert len(got) == len(rows)
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    assert Counter(r["size"] for r in got if r["doc_id"] is None) == {1: 2}
    assert {r["size"] for r in got if r["doc_id"] == 3} == {7, 3, 200001}


def test_one_hot_key_and_empty_table(spark, docs, tmp_path):
    got = assign_shards(docs([(7, "same")] * 300, tmp_path), 4).collect()
    assert sorted(r["slot"] for r in got) == list(range(300)) and len({r["shard"] for r in got}) == 1
    assert assign_shards(docs([(1, "x")], tmp_path / "e").limit(0), 4).count() == 0
