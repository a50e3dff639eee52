import hashlib
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from transitlens.llm import boosting
from transitlens.llm import pii as P


def plain(text):
    """The strict patterns, written out a second time."""
    out = []
    for rank, kind in enumerate(P.KINDS):
        for m in re.finditer(P.PATTERNS[kind], text):
            s = m.group()
            d = [int(c) for c in s if c in "0123456789"]
            check = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
            ok = {"email": True, "phone": 10 <= len(d) <= 15, "card": 14 <= len(d) <= 19 and check % 10 == 0,
                  "ip": kind == "ip" and all(int(p) <= 255 for p in s.split("."))}[kind]
            if ok:
                out.append((m.start(), rank, m.end()))
    return [(a, b, P.KINDS[r]) for a, r, b in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet="0123456789.+-() @aZé\n", max_size=60), st.text(alphabet="a@.-_%1+ é", max_size=40),
                 st.text(alphabet="12.5 a", max_size=40)))
def test_strict_spans_of_any_text(text):
    assert P.strict_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    n = 1_000_000
    for text in ["1" * n, "a" * n, "a" * n + "@", "a@" * (n // 2), "1." * (n // 2), "a." * (n // 2) + "@b", "@" + "a." * (n // 2), "+1" + " " * n,
                 "a at " * (n // 5), "(at)" * (n // 4), "1 " * (n // 2), "x@y" + ".z" * (n // 2)]:
        t = time.process_time()
        P.strict_spans(text)
        assert time.process_time() - t < 1.5, text[:12]
    long = "n" * 300 + "@" + "d" * 200 + ".x" * 9
    assert P.strict_spans(long) == [(0, len(long), "email")]
    spelled = "write to " + "n" * 100 + " (at) " + " (dot) ".join(["d" * 70] * 7)
    assert (9, len(spelled), "email") in P.candidates(spelled)


def test_strict_spans():
    t = "Mail a.b@c-d.org, 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111, 4111111111111112, +1 (017) 555-7713."
    assert [k for _, _, k in P.strict_spans(t)] == ["email", "ip", "card", "phone"] and P.strict_spans(t) == plain(t)
    assert P.strict_spans("1.2.3.4.5.6.7.8") == [(0, 7, "ip"), (8, 15, "ip")]


def test_trees_learn_a_rule_and_are_calibrated():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 20, (3000, 4))
    y = ((x[:, 0] > 9) ^ (x[:, 2] > 14)).astype(int)
    y[rnd.random(3000) < 0.05] ^= 1
    model = boosting.fit(x, y)
    p = boosting.probability(model, x)
    assert ((p > 0.5) == y).mean() > 0.93
    assert abs(p[p > 0.8].mean() - y[p > 0.8].mean()) < 0.03
    bound = boosting.threshold_for(model, x, y, 0.9)
    assert y[p >= bound].mean() > 0.88
    assert boosting.threshold_for(model, x, np.zeros(3000, int), 0.9) == 1.1


def test_added_spans_and_clean_texts(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = P.train(d)
    eager = model | {"thresholds": [0.5] * 4}
    strict, spans = P.all_spans("write to joe (at) example (dot) com today", eager)
    assert not strict and [k for _, _, k in spans] == ["email"]
    for clean in ["Version 12 of 2021, 300 pages, GPL version 3.", "order 4363361756619573 of 12", "", "1.2.3 and 4.5.6"]:
        assert P.all_spans(clean, model)[1] == []
    got = P.find_pii(d.select("doc_id", "text"), model, redact=True).collect()
    for r in got:
        base = plain(r["text"])
        assert r["base_sha256"] == hashlib.sha256(P.listed(base).encode()).hexdigest()
        assert sum(r[f"n_{k}"] for k in P.KINDS) == len(base)
        assert set(filter(None, P.listed(base).split(","))) <= set(r["spans"].split(","))
        assert not plain(r["redacted"]) and (r["redacted"] == r["text"]) == (r["spans"] == "")


def test_redaction_of_overlaps():
    t = "x +14111111111111111 y"
    spans = [(2, 20, "phone"), (3, 20, "card")]
    assert P.redacted(t, spans) == "x <phone> y"


def test_odd_rows(spark, docs, tmp_path):
    long = "lorem " * 60000 + "a@b.cd"
    d = docs([(1, None), (2, ""), (None, "a@b.cd a@b.cd"), (3, long), (3, long)], tmp_path).selectExpr("*", "5 AS N_IP", "6 AS _p")
    model = P.train(d)
    got = {r["doc_id"]: r for r in P.find_pii(d, model).collect()}
    assert got[1]["spans"] == "" and got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() == got[2]["base_sha256"]
    assert got[None]["n_email"] == 2 and got[None]["n_ip"] == 0 and got[1]["_p"] == 6 and got[3]["spans"] == "email:360000:360006"
    assert P.find_pii(d.limit(0), P.train(d.limit(0))).count() == 0


def test_numbers_in_long_runs_are_proposed():
    rows = "2024 05 17 10 22 33 "
    card = "4111 1111 1111 1111"
    for before in (rows, rows * 3, "1 2 3 4 5 6 7 8 9 ", "1.5/2.5/3.5/4.5/"):
        t = before + card
        assert (len(before), len(t), "card") in P.candidates(t)
    spread = ".".join("4111111111111111")
    assert (0, len(spread), "card") in P.candidates(spread)
    many = "12 345 " * 500
    assert all(len(re.sub("[^0-9]", "", many[a:b])) <= P.MAX_DIGITS for a, b, _ in P.candidates(many))


def test_production_thresholds_add_planted_spans_and_none_in_clean_texts(spark):
    model = P.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    planted = [("write to ", "joe (at) example (dot) com", " today", "email"), ("please write to ", "anna.li[at]mail[dot]org", ".", "email"),
               ("call ", "(415) 555-0132", " now", "phone"), ("our number is ", "415.555.0132", " here", "phone"),
               ("paid with ", "4111.1111.1111.1111", " yesterday", "card"), ("the host ", "10[.]0[.]0[.]7", " is down", "ip"),
               ("2024 05 17 10 22 33 ", "4111 1111 1111 1111", "", "card")]
    for before, value, after, kind in planted:
        strict, spans = P.all_spans(before + value + after, model)
        assert not strict and spans == [(len(before), len(before) + len(value), kind)], (value, spans)
    for clean in ["It was on 2021-05-17 10 of them.", "see you (at) noon. Then we go", "order 123456789012 was sent",
                  "ISBN 978-3-16-148410-0 is a book", "sizes 12.50 13.75 14.20 15.10", "card 4111.1111.1111.1112 fails"]:
        assert P.all_spans(clean, model)[1] == [], clean


def test_labelled_rows_fit_bytes():
    """The sample reaches the driver as bytes; a feature beyond the trees' bins would not do."""
    texts = ["", "call +1 415 555 0100 or 4111 1111 1111 1111 now", "mail me (at) home [dot] example . com, 10.0.0.1 or 1[.]2[.]3[.]4 " * 9,
             "1 " * 400, "9" * 500 + ".1.2.3 " + "a@" + "b" * 90 + ".com"]
    rows = [r for t in texts for r in P.labelled(t)]
    assert len(rows) > 50 and all(0 <= v < boosting.BINS for r in rows for v in r)
    assert [list(bytes(r)) for r in rows] == rows
