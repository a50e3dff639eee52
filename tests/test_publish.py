"""Versions appear whole or not at all, whatever moment a run dies at."""

import os

import pytest
from pyspark.sql import functions as F

from transitlens.sources import publish as P
from transitlens.sources.layers import materialize_layers


class Killed(BaseException):
    """The process is gone: no cleaning up."""


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _frames(spark, dates, mark):
    rows = [(d, i, mark) for d in dates for i in range(3)]
    dated = spark.createDataFrame(rows, "date string, i int, mark string").withColumn("date", F.col("date").cast("date"))
    return dated, spark.createDataFrame([(mark,)], "mark string")


def _publish(spark, root, dates, mark, replaced, applied=None):
    dated, whole = _frames(spark, dates, mark)
    run = P.Run(spark, root)
    run.write("pings", dated, "date")
    run.write("stops", whole)
    return run.publish(replaced, applied)


def _state(spark, root):
    return {n: _rows(P.read_layer(spark, root, n)) for n in P.manifest(spark, root).layers}


def test_dates_are_replaced_and_others_kept(spark, tmp_path):
    root = str(tmp_path / "out")
    assert P.manifest(spark, root) == P.Manifest() and P.versions(spark, root) == []
    _publish(spark, root, ["2024-01-01", "2024-01-02", None], "a", None, {"s": 3})
    m = _publish(spark, root, ["2024-01-02"], "b", ["2024-01-02", "2024-01-03"])
    assert m.version == 2 and m.applied == {"s": 3}
    got = {(str(r.date), r.mark) for r in P.read_layer(spark, root, "pings").collect()}
    assert got == {("2024-01-01", "a"), ("2024-01-02", "b"), ("None", "a")}
    assert [r.mark for r in P.read_layer(spark, root, "stops").collect()] == ["b"]
    assert P.read_layer(spark, root, "pings", dates=["2024-01-02", "2030-01-01"]).count() == 3
    assert P.read_layer(spark, root, "pings", dates=[None]).count() == 3
    assert P.read_layer(spark, root, "pings", dates=["2030-01-01"]).count() == 0
    assert {r.mark for r in P.read_layer(spark, root, "pings", version=1).collect()} == {"a"}
    _publish(spark, root, [], "c", ["2024-01-01"])  # a date without rows goes
    assert {str(r.date) for r in P.read_layer(spark, root, "pings").collect()} == {"2024-01-02", "None"}
    assert [(v, d) for v, d, _ in P.history(spark, root, "pings")] == [
        (1, "2024-01-01"), (1, "2024-01-02"), (1, P.NO_DATE), (2, "2024-01-02")]
    with pytest.raises(ValueError, match="2024-01-09"):
        _publish(spark, root, ["2024-01-09"], "d", ["2024-01-01"])
    with pytest.raises(ValueError, match="not published by date"):
        P.read_layer(spark, root, "stops", dates=["2024-01-01"])
    with pytest.raises(KeyError):
        P.read_layer(spark, root, "nothing")
    assert P.versions(spark, root) == [1, 2, 3]


STEPS = ["_children", "manifest", "write_text", "rename_new", "delete"]


def test_a_run_killed_between_any_two_steps_leaves_every_date_readable(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    _publish(spark, root, ["2024-01-01", "2024-01-02"], "old", None)
    old = _state(spark, root)
    held = P.read_layer(spark, root, "pings")
    state = {"left": None, "seen": 0}

    def counted(fn):
        def call(*a, **k):
            for _ in range(2):  # dies before the step, or after it
                state["seen"] += 1
                if state["left"] == state["seen"]:
                    raise Killed
                if _ == 0:
                    out = fn(*a, **k)
            return out
        return call

    for name in STEPS:
        monkeypatch.setattr(P, name, counted(getattr(P, name)))
    outcomes, n = [], 1
    while True:
        state.update(left=n, seen=0)
        try:
            _publish(spark, root, ["2024-01-02"], f"new{n}", ["2024-01-02"])
        except Killed:
            state.update(left=None)
            now = _state(spark, root)
            assert now["pings"][:3] == old["pings"][:3]  # the first date
            marks = {r[2] for r in now["pings"][3:]}
            assert len(marks) == 1 and marks == {now["stops"][0][0] if marks != {"old"} else "old"}
            outcomes.append(marks == {f"new{n}"})
            n += 1
            continue
        break
    assert n > 8 and outcomes == sorted(outcomes) and outcomes[-1]  # unseen up to the rename, whole from then on
    assert _rows(held) == old["pings"]  # a reader keeps the version that it has resolved


def test_a_failing_run_deletes_its_files_and_a_published_one_keeps_them(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    _publish(spark, root, ["2024-01-01"], "old", None)

    def work(run):
        run.write("stops", _frames(spark, [], "new")[1])
        return {}

    def refused(*a):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(P, "write_text", refused)
        with pytest.raises(OSError, match="disk full"):
            P.publishing(spark, root, work)
    assert len(os.listdir(os.path.join(root, "stops"))) == 1

    real = P.rename_new

    def lost_answer(*a):
        real(*a)
        raise OSError("connection lost")

    with monkeypatch.context() as m:
        m.setattr(P, "rename_new", lost_answer)
        with pytest.raises(OSError, match="connection lost"):
            P.publishing(spark, root, work)
    assert [r.mark for r in P.read_layer(spark, root, "stops").collect()] == ["new"]


def test_two_runs_at_once_keep_both_changes(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    _publish(spark, root, ["2024-01-01", "2024-01-02"], "old", None)
    real, other = P.rename_new, []

    def raced(s, source, target):
        if not other:
            other.append(1)
            _publish(spark, root, ["2024-01-01"], "other", ["2024-01-01"])
        return real(s, source, target)

    monkeypatch.setattr(P, "rename_new", raced)
    assert _publish(spark, root, ["2024-01-02"], "mine", ["2024-01-02"]).version == 3
    assert {(str(r.date), r.mark) for r in P.read_layer(spark, root, "pings").collect()} == {
        ("2024-01-01", "other"), ("2024-01-02", "mine")}


def test_old_versions_are_removed_by_an_explicit_call(spark, tmp_path):
    root = str(tmp_path / "out")
    for k in range(4):
        _publish(spark, root, ["2024-01-01", "2024-01-02"] if k < 2 else ["2024-01-02"], f"r{k}", None if k < 2 else ["2024-01-02"])
    orphan = P.Run(spark, root)
    orphan.write("stops", _frames(spark, [], "orphan")[1])
    now = _state(spark, root)
    assert P.remove_old_versions(spark, root, keep=1) == []  # young folders may belong to a running job
    assert P.versions(spark, root) == [4]
    gone = P.remove_old_versions(spark, root, keep=1, min_age_hours=-1)
    assert len(gone) == 2 + 4 and _state(spark, root) == now  # runs 0 and 2 of pings; 0, 1, 2 and the orphan of stops
    assert P.remove_old_versions(spark, str(tmp_path / "none")) == []
    with pytest.raises(ValueError):
        P.remove_old_versions(spark, root, keep=0)


def test_layers_read_their_upstream_and_appear_together(spark, tmp_path):
    root = str(tmp_path / "out")
    dated, _ = _frames(spark, ["2024-01-01", "2024-01-02"], "a")
    layers = [("one", lambda read: dated), ("two", lambda read: read("one").groupBy("date").count())]
    out = materialize_layers(spark, layers, root, by={"one": "date", "two": "date"})
    assert out["two"].agg(F.sum("count")).first()[0] == 6
    with pytest.raises(ZeroDivisionError):
        materialize_layers(spark, [layers[0], ("two", lambda read: 1 / 0)], root)
    assert P.versions(spark, root) == [1] and out["one"].count() == 6
    only = dated.filter("date = '2024-01-02'").filter("i = 0")
    again = materialize_layers(spark, [("one", lambda read: only), layers[1]], root, by={"one": "date", "two": "date"}, dates=["2024-01-02"])
    assert again["one"].count() == 4 and {str(r[0]): r[1] for r in again["two"].collect()} == {"2024-01-01": 3, "2024-01-02": 1}
