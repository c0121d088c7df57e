"""A manifest as a log of runs: repeated, failed, concurrent and compacted."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from surveyspark.sources.runlog import RunConflict, RunLog


def rows(spark, *lines):
    return spark.createDataFrame([(f"{i:03d}", 0, x) for i, x in enumerate(lines)], "ord string, part int, line string")


def lines(log):
    return [(r.run, r.line) for r in log.read().orderBy("run", "ord", "part").collect()]


@pytest.fixture(params=["local", "hadoop"])
def log(spark, tmp_path, request, monkeypatch):
    if request.param == "hadoop":
        monkeypatch.setattr(RunLog, "_local", lambda self: None)
    return RunLog(spark, f"file://{tmp_path}/manifest")


def test_runs_append_and_repeat(spark, log):
    assert lines(log) == []
    assert log.commit("a", rows(spark, "a1", " ", "a2")) == 0
    assert log.commit("b", rows(spark, "b1")) == 1
    before = lines(log)
    assert log.commit("a", rows(spark, "a1", " ", "a2")) == 0
    assert lines(log) == before == [(0, "a1"), (0, "a2"), (1, "b1")]
    with pytest.raises(RunConflict):
        log.commit("b", rows(spark, "other"))
    assert lines(log) == before


def test_compaction_keeps_what_comes_after(spark, log):
    assert log.compact() == -1
    log.commit("a", rows(spark, "a1"))
    log.commit("b", rows(spark, "b1"))
    assert log.compact() == 1
    log.commit("c", rows(spark, "c1"))
    log.commit("a", rows(spark, "a1"))
    assert lines(log) == [(0, "a1"), (1, "b1"), (2, "c1")]
    assert log.compact() == 2 == log.compact()
    assert lines(log) == [(0, "a1"), (1, "b1"), (2, "c1")]


def test_writers_at_once_keep_all(spark, tmp_path):
    log = RunLog(spark, f"file://{tmp_path}/manifest")  # Hadoop's local file system can't create exclusively
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda k: log.commit(f"run{k % 3}", rows(spark, f"line{k % 3}")), range(4)))
    assert len(set(numbers)) == 3 and numbers[0] == numbers[3]
    assert sorted(x for _, x in lines(log)) == ["line0", "line1", "line2"]


def test_a_job_that_fails_leaves_nothing(spark, log):
    log.commit("a", rows(spark, "a1"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        log.commit("b", rows(spark, "b1").selectExpr("ord", "part", "CAST(1 div part AS STRING) AS line"))
    assert lines(log) == [(0, "a1")]


def test_a_number_without_text_is_no_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RunLog, "_local", lambda self: None)
    log = RunLog(spark, f"file://{tmp_path}/manifest")
    log.commit("a", rows(spark, "a1"))
    (tmp_path / "manifest" / "claims" / "000000001").touch()
    assert log.commit("b", rows(spark, "b1")) == 2
    assert lines(log) == [(0, "a1"), (2, "b1")]


def test_export_in_order(spark, log, tmp_path):
    log.commit("b", rows(spark, *[f"b{i:03d}" for i in range(50)]))
    log.commit("a", rows(spark, "a"))
    log.export(str(tmp_path / "out"))
    text = "".join((tmp_path / "out" / n).read_text() for n in sorted(os.listdir(tmp_path / "out")) if n.startswith("part-"))
    assert text.splitlines() == [*(f"b{i:03d}" for i in range(50)), "a"]
