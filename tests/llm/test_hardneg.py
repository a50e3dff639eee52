import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlens.llm import hardneg as H

SCHEMA = "vec_id long, embedding array<double>, label int, code string, size int, block int"


@settings(max_examples=80, deadline=None)
@given(st.sampled_from([1, 3, 64, 70, 130]), st.sampled_from([1, 300, 2 ** 20]), st.integers(0, 2 ** 32 - 1))
def test_intervals_hold_the_true_products(d, size, seed):
    rnd = np.random.default_rng(seed)
    x, q = rnd.integers(-size, size + 1, (30, d)), rnd.integers(-size, size + 1, (7, d))
    x[0], q[0], x[1] = 0, 0, q[1]
    y = H.rotated(x)
    n = y.shape[1]
    assert ((y ** 2).sum(1) == n * (x ** 2).sum(1)).all()
    rows = H.Codes.of(H._words(y >= 0), (x ** 2).sum(1).astype(float), np.abs(y).sum(1).astype(float))
    low, high = H.intervals(rows, H.Queries.of(q), slice(0, len(q)))
    true = x @ q.T
    assert (low <= true).all() and (true <= high).all()
    # Neither end is worse than plain Cauchy-Schwarz on the whole vectors, but for the planes' rounding.
    whole = np.sqrt((x ** 2).sum(1))[:, None] * np.sqrt((q ** 2).sum(1))
    assert (high - low <= 2.2 * whole + 1).all()


def plain(rows, is_anchor, positives, negatives, between, scale):
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for ai, al, av in kept:
        if ai is None or not is_anchor(ai):
            continue

        def score(v, av=av):
            return sum(a * b for a, b in zip(av, v, strict=False))

        order = sorted(((-score(v), i is None, i or 0, i, lab) for i, lab, v in kept))
        near = [(i, -s) for s, _, _, i, lab in order if lab == al and i != ai][:positives]
        for p, ps in near:
            fit = [(i, -s) for s, _, _, i, lab in order if lab != al and between[0] * ps <= -100 * s <= between[1] * ps]
            out += [(ai, p, rank, i, ps, s) for rank, (i, s) in enumerate(fit[:negatives], 1)]
    return out


def _key(r):
    return tuple((x is None, x) for x in r)


def test_mine_equals_brute_force_on_odd_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(int(i), [round(float(x), 2) for x in rnd.normal(0, 0.4, 5)], int(rnd.integers(0, 3))) for i in range(300)]
    rows += [rows[20]] * 3 + [(21, rows[20][1], 2), (None, rows[20][1], rows[20][2]), (None, rows[20][1], (rows[20][2] + 1) % 3),
                              (400, None, 1), (410, [1.0, None], 1), (420, [float("nan")] * 5, 1), (430, [float("inf")], 1),
                              (440, [1.0] * 5, None), (450, [], 1), (460, [0.5, 0.5], 1), (470, [0.0] * 5, 9)]
    df = spark.createDataFrame([r + ("x", 1, 2) for r in rows], SCHEMA).repartition(5)
    expected = sorted(plain(rows, lambda i: i % 10 == 0, 3, 4, (30, 90), 256), key=_key)
    for block_values in (H.BLOCK_VALUES, 20):  # one block, and many
        got = H.mine(df, F.col("vec_id"), F.col("label"), F.col("id") % 10 == 0, positives=3, negatives=4, block_values=block_values)
        assert sorted((tuple(r) for r in got.collect()), key=_key) == expected and expected
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_many_small_batches_and_ties(spark, monkeypatch):
    rows = [(i, [0.5 if i % 3 else 0.25, 0.125], i % 2) for i in range(240)]
    df = spark.createDataFrame([r + ("x", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = H.mine(df, F.col("vec_id"), F.col("label"), F.col("id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, lambda i: i % 50 == 0, 5, 10, (30, 90), 256))


def test_nothing_to_mine(spark):
    df = spark.createDataFrame([(5, [1.0], 1, "", 0, 0)], SCHEMA)
    for d in (df, df.limit(0), df.withColumn("vec_id", F.lit(100).cast("long"))):
        assert H.mine(d, F.col("vec_id"), F.col("label"), F.col("id") % 100 == 0).count() == 0


def test_the_interval_filter_drops_rows(monkeypatch):
    """Where vectors form groups, most rows are ruled out by their codes alone."""
    rnd = np.random.default_rng(0)
    centers = rnd.normal(0, 400, (20, 64))
    x = (centers[rnd.integers(0, 20, 2000)] + rnd.normal(0, 20, (2000, 64))).astype(np.int64)
    y = H.rotated(x)
    rows = H.Codes.of(H._words(y >= 0), (x ** 2).sum(1).astype(float), np.abs(y).sum(1).astype(float))
    batch = H._Batch(np.arange(2000), np.zeros(2000, bool), np.ones(2000, int), x, rows)
    scored = []
    product = H._product
    monkeypatch.setattr(H, "_product", lambda v, q: scored.append(len(v)) or product(v, q))
    best = H.best_positives(iter([batch]), H.Block(np.arange(10), np.ones(10, int), x[:10]), 5)
    assert sum(scored) < 0.3 * 10 * 2000
    for i in range(10):
        true = x @ x[i]
        assert best.id[i].tolist() == sorted((j for j in range(2000) if j != i), key=lambda j: (-true[j], j))[:5]
