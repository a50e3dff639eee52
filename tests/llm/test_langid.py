import tracemalloc

import numpy as np

from transitlens.llm import langid as L
from transitlens.llm.common import id_bucket


def grams(text):
    words = "".join(c if c >= "\x80" or "a" <= c <= "z" else " " for c in text.lower()).split()
    raw = (" " + " ".join(words) + " ").encode()
    return {raw[i:i + n] for n in L.ORDERS for i in range(len(raw) - n + 1)}


def test_presence_counts_each_gram_once():
    seen = np.zeros(L.COLUMNS, bool)
    for t in ["", "a", "Ab ab, AB!", "é ñ 12 x", "ab " * 1000]:
        found = L.presence(t, seen)
        assert not seen.any() and abs(len(found) - len(grams(t))) <= 1  # at most a hash collision apart


def test_scores_are_the_nystrom_ridge_regression():
    texts = ["the cat and the dog", "the man with the hat", "der hund und die katze", "die frau mit dem hut"] * 2
    labels = ["en", "en", "de", "de"] * 2
    model = L.fit(texts, labels, landmarks_per_language=2)
    marks = [0, 1, 2, 3]  # the first two texts of each language (with repeats), by language
    order = [2, 3, 0, 1]

    def k(a, b):
        return len(grams(a) & grams(b)) / (len(grams(a)) * len(grams(b))) ** 0.5

    among = np.array([[k(texts[i], texts[j]) for j in order] for i in order])
    values, vectors = np.linalg.eigh(among)
    whiten = vectors / np.sqrt(values)
    x = np.array([[k(t, texts[j]) for j in order] for t in texts]) @ whiten
    y = np.array([[lab == "de", lab == "en"] for lab in labels], float)
    w = np.linalg.solve(x.T @ x / 4 + L.RIDGE * np.eye(len(marks)), x.T @ y / 4)
    for t in ["the dog", "und die", "katze hat"]:
        expected = np.array([k(t, texts[j]) for j in order]) @ whiten @ w
        assert np.allclose(model.scores([t])[0], expected, atol=0.02)


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = id_bucket(d["doc_id"], 4) == 2
    model = L.train(d.where(~held_out))
    got = L.identify(d.where(held_out), model).select("lang", "lang_pred", "score").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.99 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark, docs, tmp_path):
    rows = [(i, "the cat and the other thing", "en") for i in range(5)] + [(i, "der hund und die katze", "de") for i in range(5, 10)]
    rows += [(20, None, "en"), (21, "", None), (22, "12 %% 34", "de"), (None, "the thing", None), (23, "und " * 40000, None)]
    d = docs(rows, tmp_path).selectExpr("*", "7 AS Score", "8 AS _p")
    got = {r["doc_id"]: r for r in L.identify(d, L.train(d)).collect()}
    assert [got[i]["lang_pred"] for i in (0, 5, 20, 21, 22, None, 23)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert got[22]["score"] == 0 and got[0]["_p"] == 8
    unlabelled = docs([(1, "abc", None)], tmp_path / "u")
    assert L.train(unlabelled) is None
    assert L.identify(unlabelled, None).first()["lang_pred"] == "und"
    assert L.identify(d.limit(0), L.train(d)).count() == 0


def test_a_fit_holds_no_presence_matrix_of_all_landmarks():
    rnd = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 500, 30)) + f" {'abc'[i % 3] * 5}" for i in range(300)]
    labels = [f"l{i % 3}" for i in range(300)]
    tracemalloc.start()
    model = L.fit(texts, labels, landmarks_per_language=100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    full = L.COLUMNS * 300 * 4
    assert peak < full / 2, (peak, full)
    got = model.scores(texts).argmax(1)
    assert sum(model.languages[k] == y for k, y in zip(got, labels, strict=True)) >= 290


def test_a_sample_is_ordered_without_a_sort_in_spark(spark, docs, tmp_path):
    rows = [(i, f"the cat and thing {i}", "en") for i in range(60)] + [(i, f"der hund und {i}", "dé") for i in range(60, 90)]
    rows += [(1, "another text of a repeated id", "en"), (1, "der text", "de"), (None, "the thing", "en"), (95, "text", None)]
    d = docs(rows, tmp_path)
    hashed = dict(spark.range(100).selectExpr("id", "xxhash64(id)").collect())
    spark.sparkContext.setJobGroup("sample", "sample of the languages")
    try:
        got = L.labelled_sample(d)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("sample"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    least = {}
    for i, t, lang in sorted(r for r in rows if r[0] is not None and r[2]):
        least.setdefault((lang, hashed[i], i), t)
    assert got == [(t, key[0]) for key, t in sorted(least.items())]
    assert jobs <= 6, jobs  # seven with a global sort
