import random

import xxhash

from transitlens.llm import components as C
from transitlens.llm import simhash as S
from transitlens.llm.components import roots


def plain(text, n):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_bitwise_majority():
    for t in [None, "", " \t\n", "one", "One TWO three", "a b c d", "a b c d e f", "É é x A", "x " * 500, "a\x0bb\x0cc\rd e"]:
        assert S.fingerprint_of(t.encode() if t is not None else None, 4) % 2 ** 64 == plain(t, 4)


def test_every_pair_within_the_distance_meets_in_a_segment():
    for bits in range(7):
        for segments in (1, 2, 3, 4, 5):
            plan = S.segment_plan(segments, bits)
            shares = [next((r for s, _, r in plan if s == at), -1) for at in
                      [sum(64 // segments + (i < 64 % segments) for i in range(k)) for k in range(segments)]]
            # the fewest differing bits that escape every table
            assert sum(r + 1 for r in shares) > bits


def brute(prints, bits):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_links_connect_as_all_pairs_do(spark):
    rnd = random.Random(3)
    prints = set()
    for _ in range(25):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 5, 20])):
            flips = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4)))
            prints.add(base ^ flips)
            base = rnd.choice([base, base ^ flips])
    prints = sorted(prints)
    nodes = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    for bits, dense in ((4, 256), (4, 2), (3, 2), (5, 256)):
        expected = brute(prints, bits)
        named = {r["node"] % 2 ** 64: r["root"] for r in roots(S.links(nodes, bits, dense=dense)).collect()}
        mine = [named.get(p, p - (p >> 63 << 64)) for p in prints]
        assert len(set(zip(expected, mine))) == len(set(expected)) == len(set(mine)), (bits, dense)


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in roots(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_groups_of_rows(spark, docs, tmp_path):
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(9, "x y z"), (4, "X y Z"), (7, None), (3, " "), (None, "x y z"), (5, long), (6, long + " more"), (5, long),
            (8, "quite another text with other words in it")]
    d = docs(rows, tmp_path).selectExpr("*", "1 AS fp", "2 AS root", "3 AS _row")
    got = S.near_duplicates(d, 4, 4).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == sorted(
        [("9", 4), ("4", 4), ("None", 4), ("7", 3), ("3", 3), ("5", 5), ("6", 5), ("5", 5), ("8", 8)])
    kept = S.one_of_each_group(d, 4, 4).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 4, 5, 8] and kept[0]["fp"] == 1 and kept[0]["_row"] == 3
    assert S.near_duplicates(d.limit(0), 4, 4).count() == 0


def test_the_same_rows_stay_however_files_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """Executors may come and go between two readings of the documents."""
    rows = [(i % 7, "one two three four five six seven", f"s{i}") for i in range(60)] + [(None, "other words here entirely", "x"), (99, None, "y")]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(12).write.parquet(path)
    real, seen = S.written, []

    def dealt(df, name):
        out = real(df, name)
        seen.append(name)
        spark.conf.set("spark.sql.files.minPartitionNum", "2" if len(seen) % 2 else "12")
        return out

    try:
        monkeypatch.setattr(S, "written", dealt)
        got = sorted((tuple(r) for r in S.one_of_each_group(spark.read.parquet(path), 4, 4).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(got) == 3 and [r[0] for r in got] == [0, 99, None] and got[0][2] in {f"s{i}" for i in range(0, 60, 7)}


def test_a_star_is_planned_once_in_a_round(spark, tmp_path):
    """The small star reads its edges twice; the large star before it must not be computed each time."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 3)], "u long, v long")
    assert {r["node"]: r["root"] for r in roots(edges).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    stored = tmp_path / "edges"
    edges.write.parquet(str(stored))
    read = spark.read.parquet(str(stored))
    for star, at_most in ((C._large_star, 3), (C._small_star, 4)):
        plan = star(read)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= at_most, plan


def test_rows_that_stay_take_few_jobs(spark, docs, tmp_path):
    """Each job and stage costs the driver memory: only the first row of a fingerprint goes on to its group."""
    near = " ".join(f"word{i}" for i in range(400))
    rows = [(i, f"{near} end{i % 4}") for i in range(12)] + [(20 + i, f"text {i} of its own {i * 7} words {i * 11}") for i in range(6)]
    d = docs([*rows, (None, near), (30, None), (31, " ")], tmp_path)
    spark.sparkContext.setJobGroup("stay", "rows that stay")
    try:
        kept = sorted((r["doc_id"] for r in S.one_of_each_group(d, 4, 4).collect()))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("stay"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    smallest = {}
    for r in S.near_duplicates(d, 4, 4).collect():
        smallest[r["component_id"]] = smallest.get(r["component_id"], 0) + 1
    assert kept == sorted(smallest) and sum(smallest.values()) == 21 and len(kept) < 21
    assert jobs <= 30, jobs  # 37 with a join of all rows and counts of stored tables


def test_the_last_round_is_one_large_star(spark, monkeypatch):
    """Stars are known from the round's grouped minima; a whole round more to see no change costs its jobs again."""
    real, stored = C.written, []
    monkeypatch.setattr(C, "written", lambda df, name: stored.append(name) or real(df, name))

    def starred(pairs):
        stored.clear()
        return sorted(tuple(r) for r in C.stars(spark.createDataFrame(pairs, "u long, v long")).collect())

    assert starred([(1, 4), (4, 1), (1, 9), (1, 4), (2, 3), (5, 5)]) == [(3, 2), (4, 1), (9, 1)]
    assert stored == ["larger"]
    assert starred([(3, 1), (3, 2)]) == [(2, 1), (3, 1)]  # its large star changes nothing, but it is none yet
    assert starred([(i, i + 1) for i in range(9)]) == [(i, 0) for i in range(1, 10)]
    assert stored[-1] == "larger" and stored[:-1] == ["larger", "edges"] * (len(stored) // 2)
    assert starred([(7, 7)]) == [] and stored == []


def test_groups_of_all_rows_take_few_jobs(spark, docs, tmp_path):
    """The smallest id of each group comes from one join of the fingerprints with their roots."""
    near = " ".join(f"word{i}" for i in range(400))
    rows = [(i, f"{near} end{i % 4}") for i in range(12)] + [(20 + i, f"text {i} of its own {i * 7} words {i * 11}") for i in range(6)]
    d = docs([*rows, (None, near), (None, "nothing like it at all"), (30, None), (31, " ")], tmp_path)
    spark.sparkContext.setJobGroup("groups", "groups of all rows")
    try:
        got = {(r["doc_id"], r["component_id"]) for r in S.near_duplicates(d, 4, 4).collect()}
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("groups"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {(i, 0) for i in [*range(12), None]} | {(20 + i, 20 + i) for i in range(6)} | {(None, None), (30, 30), (31, 30)}
    assert jobs <= 26, jobs  # 30 with a second join of the fingerprints and one round more


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ball_points_are_not_broadcast_by_the_size_of_their_fingerprints(spark, tmp_path):
    """400 stored fingerprints are a few KB for Spark's estimate; their 800,000 points are the driver's heap."""
    path = str(tmp_path / "members")
    spark.range(400).selectExpr("id * 7 AS fp").write.parquet(path)
    for bits in (3, 4):
        plan = plan_of(S._star_links(spark.read.parquet(path), bits))
        assert "Generate explode" in plan and "Broadcast" not in plan, plan


def test_many_edges_in_a_small_file_are_not_broadcast(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "edges")
    spark.range(1, 120_001).selectExpr("0L AS u", "id AS v").write.parquet(path)
    real, plans = C.written, []
    monkeypatch.setattr(C, "written", lambda df, name: plans.append(plan_of(df)) or real(df, name))
    found = C.stars(spark.read.parquet(path))
    assert found.selectExpr("count(*)", "min(u)", "max(u)", "max(v)").first() == (120_000, 1, 120_000, 0)
    assert len(plans) == 1 and "Broadcast" not in plans[0], plans


def test_dense_near_copies_stay_one_group(spark, tmp_path, monkeypatch):
    """A large group of near copies takes the path without pairs, whose points are dealt over tasks."""
    rnd = random.Random(5)
    prints = sorted({rnd.getrandbits(64) for _ in range(20)}
                    | {sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 2))) for _ in range(400)})
    path = str(tmp_path / "d")
    spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in enumerate(prints)], "doc_id long, text long").write.parquet(path)
    monkeypatch.setattr(S, "fingerprints", lambda text, shingle: text)
    monkeypatch.setattr(S, "BALLS", 50)
    expected = brute(prints, 4)
    smallest = {}
    for i, root in enumerate(expected):
        smallest.setdefault(root, i)
    d = spark.read.parquet(path)
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(d, 4, 4).collect()}
    assert got == {i: smallest[root] for i, root in enumerate(expected)}
    assert sorted(r["doc_id"] for r in S.one_of_each_group(d, 4, 4).collect()) == sorted(smallest.values())


def test_rows_with_few_fingerprints_are_not_broadcast(spark):
    """Many copies compress well; the side with one row per fingerprint is the one that may be broadcast."""
    docs = spark.range(120_000).selectExpr("id AS doc_id", "concat('text ', id % 5) AS text")
    got = S.near_duplicates(docs, 4, 4)
    plan = plan_of(got)
    join = next(line for line in plan.split("\n") if "Join" in line)
    assert "BuildLeft" not in join, plan
    assert {tuple(r) for r in got.selectExpr("doc_id % 5", "component_id").distinct().collect()} == {(i, i) for i in range(5)}
