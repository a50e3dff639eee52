import math
import zlib
from collections import Counter

import numpy as np
import pytest

from transitlens.llm import maxent as M
from transitlens.llm.common import id_bucket


def test_factors_are_distributions():
    rnd = np.random.default_rng(1)
    n_head = 40
    parts = M.tables(rnd.normal(size=(M.CLASS_ROWS, M.CLASSES)).astype("f4"),
                     rnd.normal(size=(M.WORD_ROWS, M.WIDTH)).astype("f4"), n_head)
    for context in (0, 5, M.START * M.SYMBOLS + M.START, 1234):
        head = np.arange(n_head)
        tail = np.arange(M.HEAD, M.START)
        p = np.exp(M.log_head(np.full(len(head), context), head, *parts))
        q = np.exp(M.log_head(np.full(len(tail), context), tail, *parts))
        shares = np.exp(parts[0][context])
        # three head classes hold words; those without words are never used
        assert p.sum() + q.sum() == pytest.approx(shares[:3].sum() + shares[M.HEAD_CLASSES:].sum(), rel=1e-4)


def test_updates_raise_the_likelihood():
    rnd = np.random.default_rng(0)
    symbols = [0, 1, 2, 3, M.HEAD + 1, M.HEAD + 2]
    code = np.unique([(a * M.SYMBOLS + b) * M.SYMBOLS + s for a in symbols for b in symbols for s in symbols])
    n = rnd.integers(1, 50, len(code)) ** 2
    weights = [np.zeros((M.CLASS_ROWS, M.CLASSES), "f4"), np.zeros((M.WORD_ROWS, M.WIDTH), "f4")]
    seen = []
    for _ in range(8):
        parts = M.tables(*weights, 4)
        seen.append((n * M.log_head(code // M.SYMBOLS, code % M.SYMBOLS, *parts)).sum() / n.sum())
        for level, rows, sums in M.gradients(code, n, *weights, M.word_mask(4)):
            a, b = np.split(sums, 2, axis=1)
            weights[level][rows] += M.RATE * np.log((a + M.PRIOR) / (b + M.PRIOR))
    assert all(b > a - 1e-3 for a, b in zip(seen, seen[1:])) and seen[-1] > seen[0] + 0.5
    best = {}
    for c, k in zip(code, n):
        best.setdefault(c // M.SYMBOLS, []).append(k)
    limit = sum(k * math.log(k / sum(v)) for v in best.values() for k in v) / n.sum()
    assert seen[-1] > limit - 0.2  # word weights have no trigrams, so the limit itself is out of reach


def brute_base(rows):
    words = {}
    for k, (i, t) in enumerate(rows):
        low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        words[k] = [w for w in low.split(" ") if w] + [None]
    held = {k: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for k, (i, _) in enumerate(rows)}
    c = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held[k], len(words[k]), sum(c[w] > 0 for w in words[k]), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[k])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("hot", [M.HOT_WORDS, 20])
def test_base_scores_against_brute_force(spark, docs, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(M.frequent, "__defaults__", (hot,))
    rows = [(i, f"The cat {i} sat\x0bon É{i % 5} mat {'x' * (i % 4)} w{i * i}") for i in range(80)]
    rows += [(90, None), (91, ""), (None, "the end"), (3, "again THE"), (3, "again THE"), (92, "long word " * 20000)]
    d = docs(rows, tmp_path)
    got = M.score(d, id_bucket(d["doc_id"], 10) == 0, rounds=2).collect()
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=str)
    for a, b in zip(mine, sorted(brute_base(rows), key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_held_out_texts_score_better_than_the_base(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in M.score(d, id_bucket(d["doc_id"], 10) == 0).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) * 0.97


def test_nothing_to_learn_from(spark, docs, tmp_path):
    d = docs([(1, "a b"), (2, None)], tmp_path)
    got = {r["doc_id"]: r for r in M.score(d, id_bucket(d["doc_id"], 1) == 0, rounds=1).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and math.isfinite(got[1]["score"])
    assert got[1]["base_score"] == pytest.approx(0.0)
    assert M.score(d.limit(0), id_bucket(d["doc_id"], 10) == 0, rounds=1).count() == 0


def test_leaves_of_a_tail_class_are_a_distribution():
    rnd = np.random.default_rng(2)
    depth = 2
    shares = M.tail_shares(rnd.random(M.TAIL_CLASSES * M.WIDTH ** depth) + 0.1, depth)
    weights = rnd.integers(-60, 60, ((1 << M.BLOCK_BITS) * M.BLOCK_ROWS, M.WIDTH)).astype(np.int8)
    path = np.arange(M.WIDTH ** depth, dtype=np.uint64)
    klass = np.full(len(path), 3)
    one, two = np.full(len(path), 77, np.uint64), np.full(len(path), 99, np.uint64)
    p = np.exp(M.log_tail(klass, path, one, two, [np.log(s) for s in shares], weights))
    assert p.sum() == pytest.approx(1.0, rel=1e-5) and p.std() > 0


@pytest.mark.parametrize("apart", [False, True])
def test_words_past_the_head_learn_their_contexts(spark, docs, tmp_path, apart):
    rnd = np.random.default_rng(3)
    common = [f"c{i}" for i in range(M.HEAD)]
    pairs = [(f"left{i}x{i * 7 % 97}", f"right{i}y{i * 5 % 89}") for i in range(400)]

    def text(chosen, order):
        between = rnd.choice(common, len(chosen)) if apart else [""] * len(chosen)
        return " ".join(f"{pairs[a][0]} {m} {pairs[b][1]}" for a, m, b in zip(chosen, between, order))

    rows = [(i, text(c, c)) for i, c in ((i, rnd.integers(0, 400, 40)) for i in range(1, 200))]
    rows += [(1000 + i, " ".join(common) + " " + " ".join(common)) for i in range(100)]
    chosen = rnd.integers(0, 400, 400)
    rows += [(-1, text(chosen, chosen)), (-2, text(chosen, rnd.permutation(chosen)))]
    d = docs(rows, tmp_path)
    got = {r["doc_id"]: r["score"] for r in M.score(d, d["doc_id"] < 0, rounds=3).where("held_out").collect()}
    assert got[-1] - got[-2] > 0.5 * len(chosen)
