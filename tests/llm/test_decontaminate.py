import hashlib
import random
import re
from collections import defaultdict

from transitlens.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    windows, sizes = defaultdict(set), set()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in items:
        w = WORD.findall((t or "").translate(lower))
        if w:
            n = min(10, len(w))
            sizes.add(n)
            for k in range(len(w) - n + 1):
                windows[tuple(w[k:k + n])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = WORD.findall((t or "").translate(lower))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(spark, docs_df, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(docs_df.select("doc_id", "text"), bench).drop("text")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force_with_few_words_and_short_items(spark, docs, tmp_path):
    rnd = random.Random(5)
    vocabulary = ["a", "b", "É", "7", "zz"]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "A", "\n"]) for _ in range(n))

    items = [(k, text(rnd.choice([0, 1, 4, 7, 9, 10, 11, 30]))) for k in range(12)] + [(5, None), (None, text(12))]
    rows = [(i, text(rnd.choice([0, 3, 9, 10, 25, 120]))) for i in range(60)]
    rows += [(100 + i, "x y " + (items[i % 12][1] or "") + " tail") for i in range(24)]
    rows += [(None, None), (1, ""), (1, rows[5][1]), (2, "a " * 5000)]
    assert result(spark, docs(rows, tmp_path), items) == brute(rows, items)


def test_spans_at_edges_and_copies(spark, docs, tmp_path):
    passage = " ".join(f"w{i}" for i in range(25))
    items = [(1, passage), (2, "short one"), (3, passage)]
    rows = [(i, passage) for i in range(40)] + [(50, "w24 " + " ".join(f"w{i}" for i in range(9))),
            (51, "SHORT, one"), (52, " ".join(f"w{i}" for i in range(15, 25)) + " " + " ".join(f"w{i}" for i in range(9, 19)))]
    assert result(spark, docs(rows, tmp_path), items) == brute(rows, items)


def test_empty_tables(spark, docs, tmp_path):
    d = docs([(1, "a b"), (2, None)], tmp_path)
    assert [r[1:4] for r in result(spark, d, [])] == [(2, 0, 0), (0, 0, 0)]
    assert result(spark, d.limit(0), [(1, "a")]) == []


def test_extra_columns_stay_and_clashing_names_are_replaced(spark, docs, tmp_path):
    d = docs([(1, "a b c")], tmp_path).selectExpr("*", "'x' AS N_HIT", "'y' AS _words", "'z' AS _key")
    got = decontaminate(d, spark.createDataFrame([(1, "b c")], "item_id long, text string")).first()
    assert got["n_hit"] == 2 and got["_words"] == "y" and got["_key"] == "z" and got["text"] == "a b c"
