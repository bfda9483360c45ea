"""A history of runs: what broke, since when, and how the pass rate moves."""

from __future__ import annotations

import pytest

from caremeld.plans import trend as T


def report(spark, violations):
    rows = [(name, "t", "c", "conformance" if name < "c" else "completeness", "error", n, "PASS" if n == 0 else "ERROR") for name, n in violations.items()]
    return spark.createDataFrame(rows, T.REPORT)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("history"))
    runs = [{"a": 0, "b": 3, "c": 0}, {"a": 2, "b": 3, "c": 0}, {"a": 5, "b": 0, "c": 0}, {"a": 1, "b": 4, "c": 0, "d": 1}, {"a": 0, "b": 4, "d": 1}]
    for n, run in enumerate(runs, 1):
        T.record(report(spark, run), folder, n * 10)
    T.record(report(spark, runs[-1]), folder, 50)  # recorded again
    return folder


def test_checks(spark, kept):
    got = {(r.check_name, r.run): r for r in T.check_trend(T.history(spark, kept)).collect()}
    assert len(got) == 3 * 3 + 4 + 3
    a = [got["a", n] for n in (10, 20, 30, 40, 50)]
    assert [r.event for r in a] == [None, "broke", "worse", "better", "fixed"]
    assert [r.change for r in a] == [None, 2, 3, -4, -1]
    assert [r.failing_since for r in a] == [None, 20, 20, 20, None] and [r.runs_failing for r in a] == [0, 1, 2, 3, 0]
    b = [got["b", n] for n in (10, 20, 30, 40, 50)]
    assert [r.event for r in b] == ["first failure", None, "fixed", "broke", None]
    assert [r.failing_since for r in b] == [10, 10, None, 40, 40] and [r.runs_failing for r in b] == [1, 2, 0, 1, 2]
    assert got["d", 40].event == "first failure" and got["d", 50].runs_failing == 2
    assert {got["c", n].event for n in (10, 20, 30, 40)} == {None}


def test_pass_rates(spark, kept):
    got = {(r.category, r.run): r for r in T.pass_rates(T.history(spark, kept)).collect()}
    assert [got["conformance", n].pass_rate for n in (10, 20, 30, 40, 50)] == [0.5, 0.0, 0.5, 0.0, 0.5]
    assert [got["conformance", n].drifted for n in (10, 20, 30, 40, 50)] == [False, True, False, True, False]
    assert got["conformance", 20].change == -0.5 and got["conformance", 10].change is None
    assert got["completeness", 40].n_checks == 2 and got["completeness", 50].pass_rate == 0.0


def test_no_run(spark, tmp_path):
    nothing = T.history(spark, str(tmp_path / "none"))
    assert T.check_trend(nothing).count() == 0 and T.pass_rates(nothing).count() == 0
