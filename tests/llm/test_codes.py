import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlens.llm import codes as C
from transitlens.llm.vectors import limit

SCHEMA = "vec_id long, embedding array<float>, label int, code string, `_by` int"


def plain_nearest(x, entries):
    d = ((x[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    return [min(range(len(row)), key=lambda i: (row[i], i)) for row in d], [min(row) for row in d]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5), st.sampled_from([2, 40, 2 ** 20, 2 ** 28]), st.integers(0, 2 ** 32 - 1))
def test_nearest_is_the_brute_force_one_with_ties(d, size, seed):
    rnd = np.random.default_rng(seed)
    size = min(size, limit(d))
    x, entries = rnd.integers(-size, size + 1, (40, d)), rnd.integers(-size, size + 1, (25, d))
    entries[rnd.integers(0, 25, 5)] = entries[rnd.integers(0, 25, 5)]  # repeated entries
    index, distance = C.nearest(x, entries)
    assert (index.tolist(), distance.tolist()) == plain_nearest(x, entries)


def plain_compress(rows, parts, entries, rounds, scale):
    kept = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, _, v in kept), default=0)
    width = -(-width // parts) * parts
    kept = [(i, lab, v + [0] * (width - len(v))) for i, lab, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = width // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            at = [min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(c[p], books[p][e], strict=True)), e))
                  for p in range(parts)]
            out.append((at, sum(sum((a - b) ** 2 for a, b in zip(c[p], books[p][at[p]], strict=True)) for p in range(parts))))
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, (at, _) in zip(cut, found, strict=True) if at[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, "".join(f"{e:02x}" for e in at), err, lab) for (i, lab, _), (at, err) in zip(kept, assign(), strict=True)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def _key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("entries", [3, 16])
def test_compress_equals_brute_force_on_odd_rows(spark, entries):
    rnd = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rnd.normal(0, 1, 6)], int(rnd.integers(0, 3))) for i in rnd.permutation(60)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, [1.0] * 6, None), (None, [-1.0, 0.5], None),
             (90, None, 1), (91, [1.0, None], 1), (92, [float("nan")] * 6, 1), (93, [float("inf")] * 6, 1), (94, [], 2)]
    df = spark.createDataFrame([r + ("x", 1) for r in rows], SCHEMA).repartition(4)
    coded, books = C.compress(df, F.col("vec_id"), F.col("label"), entries=entries)
    expected, digest = plain_compress(rows, C.PARTS, entries, C.ROUNDS, C.SCALE)
    got = [(r["id"], r["code"], r["error"], r["label"]) for r in coded.collect()]
    assert sorted(got, key=_key) == sorted(expected, key=_key) and C.digest(books) == digest
    assert len(got) == len(rows) - 4
    totals = {}
    for _, _, e, lab in expected:
        totals[lab] = totals.get(lab, 0) + e
    for max_groups in (100, 0):  # broadcast, and the salted join beyond the bound
        summed = C.with_group_total(coded, "label", "error", "label_error", max_groups).collect()
        assert sorted(((r["label"], r["label_error"]) for r in summed), key=_key) == sorted(
            ((lab, totals[lab]) for _, _, _, lab in expected), key=_key)


def test_empty_table_and_huge_components(spark):
    df = spark.createDataFrame([], SCHEMA)
    coded, books = C.compress(df, F.col("vec_id"), F.col("label"))
    assert coded.count() == 0 and C.digest(books) == hashlib.sha256(b"").hexdigest()
    assert C.with_group_total(coded, "label", "error", "label_error").count() == 0
    df = spark.createDataFrame([(1, [3e38] * 8, 1, "", 0), (2, [-3e38] * 8, 1, "", 0)], SCHEMA)
    coded, _ = C.compress(df, F.col("vec_id"), F.col("label"), entries=1, rounds=1)
    assert all(0 < r["error"] < 1 << 62 for r in coded.collect())


def test_a_round_returns_sums_not_rows(spark):
    rnd = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [float(x) for x in rnd.normal(0, 1, 8)], 1, "", 0) for i in range(4000)], SCHEMA).repartition(2)
    vectors, width = C.integer_vectors(df, C.SCALE, {"id": F.col("vec_id"), "label": F.col("label")}, "embedding", 4)
    books = C.train(vectors, width, entries=5, rounds=2)
    assert books.shape == (4, 5, 2)
