import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from transitlens.llm import packing as P

PATH = public_tokenizers.path(P.VOCABULARY)
BPE = P.encoder(PATH)
REFERENCE = Tokenizer.from_file(PATH)


def plain_best_fit(sizes, capacity):
    opened, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(opened, s)
        if i == len(opened):
            n, left = n + 1, capacity
        else:
            left = opened.pop(i)
        if left > s:
            bisect.insort(opened, left - s)
    return n, opened


def test_plan_is_piece_by_piece_best_fit_decreasing():
    for seed in range(120):
        rnd = random.Random(seed)
        cap = rnd.choice([7, 50, 1024])
        sizes = [min(cap, 1 + int(rnd.expovariate(rnd.choice([2, 4, 10]) / cap))) for _ in range(rnd.choice([1, 50, 900]))]
        fill = defaultdict(int)
        for size, a, b, first, each, offset in P.best_fit_plan(Counter(sizes), cap):
            for k in range(a, b):
                assert fill[first + (k - a) // each] == offset + (k - a) % each * size
                fill[first + (k - a) // each] += size
        assert (len(fill), sorted(cap - v for v in fill.values() if v < cap)) == plain_best_fit(sizes, cap)


def test_tightest_open_bin():
    bins = P.OpenBins(20)
    for r in (3, 8, 20):
        bins.put(r, r, 1)
    assert [bins.tightest(s) for s in (1, 3, 4, 8, 9, 20)] == [3, 3, 8, 8, 20, 20]
    bins.take(20)
    assert bins.tightest(9) is None


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizers_library(text):
    assert P.token_ids(BPE, text).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts():
    for t in ["", "  a", "it's 12\n\n x", "<|endoftext|> a", "\x00\x1f\x85", "a" * 2000, "👍🏽 é́"]:
        assert P.token_ids(BPE, t).tolist() == REFERENCE.encode(t, add_special_tokens=False).ids


def test_pieces_cover_a_document():
    assert P.piece_bounds(5, 4) == [(0, 1), (1, 4)] and P.piece_bounds(8, 4) == [(0, 4), (4, 4)]
    assert P.piece_bounds(4, 4) == [(0, 4)] and P.piece_bounds(1, 4) == [(0, 1)]


def test_packing_round_trip(spark, docs, tmp_path):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["one", "zwei", "trois", "cuatro"]) for _ in range(rnd.choice([0, 3, 40, 400])))) for i in range(120)]
    rows += [(200, None), (201, "long " * 9000), (None, "no id"), (5, "again"), (5, "again")] + [(300 + i, "same text here") for i in range(200)]
    d = docs(rows, tmp_path).selectExpr("*", "'x' AS piece")
    got = P.pack_documents(d, sequence=64, keep_ids=True).collect()
    assert all(r["length"] == len(r["ids"]) <= 64 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for i in (201, 17, 200):
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum((r["ids"] for r in own), []) == REFERENCE.encode(dict(rows)[i] or "").ids + [2]
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert len(by_sequence) == plain_best_fit([r["length"] for r in got], 64)[0]
    assert sum(len(own) for own in by_doc.values()) >= len({r[0] for r in rows})


def test_sequences_and_empty_table(spark, docs, tmp_path):
    d = docs([(1, "a b"), (2, "c")], tmp_path)
    ids = [r["ids"] for r in P.sequences(P.pack_documents(d, keep_ids=True)).collect()]
    assert ids == [REFERENCE.encode("a b").ids + [2] + REFERENCE.encode("c").ids + [2]]
    assert P.pack_documents(d.limit(0)).count() == 0
