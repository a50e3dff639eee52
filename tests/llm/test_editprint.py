import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from transitlens.llm import editprint as E

PRINTER = E.Printer()


def print_of(text):
    return PRINTER([E.points_of(text)], [(0, E.points_of(""))])[0][0]


def plain_print(text):
    """The walk step by step, writing out every step."""
    coins = E.coin_table().reshape(E.CLASSES, E.PERIOD)
    points = E.points_of(text)
    classes, codes, written, j = E.char_class(points), E.char_code(points), [], 0
    for c, code in zip(classes, codes):
        n = int(coins[c, j % E.PERIOD])
        written += [int(code)] * n
        j += n
    level = E.level_of(len(points))
    return f"{level:02x}" + "".join(f"{written[p] if p < len(written) else 0:x}" for p in E.places(level).tolist())


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_print_is_the_sampled_walk(text):
    assert print_of(text) == plain_print(text)


def test_batches_do_not_matter():
    rnd = np.random.default_rng(2)
    texts = ["".join(rnd.choice(list("abc é"), n)) for n in (0, 1, 5, 400, 3000, 401, 7)]
    prints, changed = PRINTER([E.points_of(t) for t in texts], [(len(t) // 2, E.points_of("tail" * 50)) for t in texts])
    assert prints == [print_of(t) for t in texts]
    assert changed == [print_of(t[:len(t) // 2] + "tail" * 50) for t in texts]


def test_likeness_follows_edits():
    """On average over texts: single walks may lose step for long, so means are compared."""
    rnd = np.random.default_rng(4)
    near = {n: [] for n in (0, 4, 40, 400)}
    other = []
    for _ in range(12):
        base = "".join(rnd.choice(list("etaoin shrdlu"), 3000))
        for n, values in near.items():
            chars = list(base)
            for k in rnd.integers(0, len(chars), n):
                chars[k] = "x" * int(rnd.integers(0, 3))
            values.append(E.likeness(print_of(base), print_of("".join(chars))))
        other.append(E.likeness(print_of(base), print_of("".join(rnd.choice(list("etaoin shrdlu"), 3000)))))
    means = [np.mean(v) for v in near.values()]
    assert means[0] == 1 and means[1] > 0.85 and means[2] > 0.5
    assert all(a >= b for a, b in zip(means, means[1:])) and means[-1] > np.mean(other) - 0.02
    assert np.mean(other) < 0.25
    assert E.likeness(print_of("a" * 1365 + "b"), print_of("a" * 1365)) > 0.95  # on either side of a level's bound
    assert E.likeness(print_of(""), print_of("")) == 1 and E.likeness(print_of(""), print_of("abc")) == 0


def edit(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@pytest.mark.parametrize("rows", [
    [(i, ("Text %d é😀 " % (i * 37)) * (i % 9)) for i in range(60)] + [(70, None), (71, "x" * 30000), (72, "")],
    [(5, "only one text")], [(1, "first text"), (2, "second one here")]])
def test_report_against_brute_force(spark, docs, tmp_path, rows):
    d = docs(rows, tmp_path).selectExpr("*", "1 AS part", "'x' AS edge")
    got = {r["doc_id"]: r for r in E.edit_report(d).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed, r = edit(text, following), got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (print_of(text), print_of(changed))
        assert r["near_edited"] == E.likeness(print_of(text), print_of(changed))
        assert r["near_next"] == E.likeness(print_of(text), print_of(following))


def test_repeated_and_null_ids_and_empty_table(spark, docs, tmp_path):
    d = docs([(1, "same text")] * 5 + [(None, "no id")] * 2, tmp_path)
    got = E.edit_report(d).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1"] * 5 + ["None"] * 2
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1
    assert E.edit_report(d.limit(0)).count() == 0


def test_search_finds_near_copies_only(spark):
    rnd = np.random.default_rng(9)
    bases = ["".join(rnd.choice(list("etaoin shrdlu"), 900 + 200 * k)) for k in range(12)]
    rows = [(k, b) for k, b in enumerate(bases)] + [(100 + k, b[:300] + "zz" + b[302:]) for k, b in enumerate(bases)]
    table = E.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    prints = {r["doc_id"]: r["fingerprint"] for r in table.collect()}
    met = {(r["query"], r["other"]) for r in E.near_pairs(table.where("doc_id < 100"), table).collect()}
    found = sum((prints[k], prints[100 + k]) in met for k in range(12))
    assert found >= 11 and all(E.likeness(a, b) >= E.LIKENESS for a, b in met)
    assert not any((prints[a], prints[b]) in met for a in range(12) for b in range(12) if a != b)
