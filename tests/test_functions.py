"""The rounding and distance helpers give bit-identical results in Spark and
in the reference SQL (DuckDB), including ties, negatives and tiny values."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from transitlens.functions.geo import haversine_distance
from transitlens.functions.numeric import round_half_away, round_sig
from transitlens.plans import oracle_sql as O

EDGE = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.125, 2.675, 1.005, -1.005, 0.045, 123456.785, -0.0004999,
        1e-12, -1e-12, 1e15, 3.14159, 99.995, -99.995, 0.3, 1 / 3]


def _values(n=1500, seed=11):
    rnd = random.Random(seed)
    vals = list(EDGE)
    for _ in range(n):
        k = rnd.random()
        if k < 0.3:
            vals.append(round(rnd.uniform(-1000, 1000), rnd.randint(0, 4)) + rnd.choice([0, 0.005, -0.005]))
        elif k < 0.6:
            vals.append(rnd.uniform(-1e6, 1e6))
        else:
            vals.append(rnd.gauss(0, 1) * 10 ** rnd.randint(-6, 8))
    return vals


def _duck(exprs, vals):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    cols = ", ".join(f"{e} AS c{j}" for j, e in enumerate(exprs))
    return {r[0]: r[1:] for r in con.execute(f"SELECT i, {cols} FROM t").fetchall()}


@pytest.mark.parametrize("digits", [0, 1, 2, 4, 6])
def test_round_half_away_matches_sql(spark, digits):
    vals = _values()
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    got = {r.i: r.v for r in df.select("i", round_half_away("x", digits).alias("v")).collect()}
    want = _duck([O.rnd("x", digits)], vals)
    for i in got:
        assert got[i] == want[i][0], (vals[i], got[i], want[i][0])
        assert not (got[i] == 0 and str(got[i]).startswith("-"))  # never -0.0


def test_round_sig_matches_sql(spark):
    vals = _values(seed=5)
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    got = {r.i: r.v for r in df.select("i", round_sig("x", 9).alias("v")).collect()}
    want = _duck([O.rsig("x", 9)], vals)
    assert all(got[i] == want[i][0] for i in got)


def test_rounded_haversine_matches_sql(spark):
    rnd = random.Random(3)
    pts = [(rnd.uniform(-80, 80), rnd.uniform(-180, 180), rnd.uniform(-80, 80), rnd.uniform(-180, 180))
           for _ in range(500)]
    pts += [(3.4 + rnd.random() / 100, -76.5 + rnd.random() / 100, 3.4 + rnd.random() / 100,
             -76.5 + rnd.random() / 100) for _ in range(1500)]
    rows = [(i, *p) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double")
    got = {r.i: r.v for r in df.select(
        "i", round_half_away(haversine_distance("a", "b", "c", "d"), 6).alias("v")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, LASTLATITUDE DOUBLE, LASTLONGITUDE DOUBLE, GPSY DOUBLE, GPSX DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    want = dict(con.execute(f"SELECT i, {O.rnd(O.HAV, 6)} FROM t").fetchall())
    diff = [i for i in got if got[i] != want[i]]
    assert len(diff) == 0, [(pts[i], got[i], want[i]) for i in diff[:3]]
    assert F is not None
