"""Appends that are there once or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from grainmill.sources.log import Log

SCHEMA = "key long, value string"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def held(log):
    return sorted((r.key, r.value) for r in log.read().collect())


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, f"file://{tmp_path}/table", SCHEMA)


def test_what_dies_before_its_record_is_not_there_and_runs_again(spark, log, monkeypatch):
    assert held(log) == []
    log.append(rows(spark, (1, "a")), "one")
    with monkeypatch.context() as m:
        m.setattr(Log, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("the driver dies")))
        with pytest.raises(RuntimeError):
            log.append(rows(spark, (2, "b")), "two")
    assert held(log) == [(1, "a")]
    assert log.append(rows(spark, (2, "b")), "two") and held(log) == [(1, "a"), (2, "b")]


def test_what_dies_after_its_record_is_not_added_again(spark, log):
    assert log.append(rows(spark, (1, "a")), "one")
    assert not log.append(rows(spark, (1, "a")), "one")  # the caller never heard of the first
    assert held(log) == [(1, "a")]


def test_a_failing_task_leaves_nothing(spark, log):
    bad = rows(spark, (1, "a")).withColumn("value", F.raise_error(F.lit("the task dies")).cast("string"))
    with pytest.raises(Exception, match="the task dies"):
        log.append(bad)
    assert held(log) == []


def test_two_writers_take_two_numbers(spark, log, monkeypatch):
    other = Log(spark, log.path, SCHEMA)
    records = Log.records
    calls = []

    def late(self):  # between this writer's look and its record, the other one appends
        found = records(self)
        if self is log and not calls:
            calls.append(1)
            other.append(rows(spark, (9, "other")))
        return found

    monkeypatch.setattr(Log, "records", late)
    log.append(rows(spark, (1, "mine")))
    assert held(log) == [(1, "mine"), (9, "other")]


def test_upserts_and_compaction(spark, log):
    log.append(rows(spark, (1, "a"), (2, "a"), (None, "n")), "t1")
    log.append(rows(spark, (2, "b"), (3, None)), "t2")
    want = {1: "a", 2: "b", 3: None, None: "n"}
    assert {r.key: r.value for r in log.latest("key").collect()} == want
    log.compact("key")
    assert {r.key: r.value for r in log.read().collect()} == want and len(log.records()) == 1
    assert not log.append(rows(spark, (7, "x")), "t1")
    log.append(rows(spark, (1, "z")))
    assert {r.key: r.value for r in log.latest("key").collect()} == want | {1: "z"}


def test_once_for_each_key(spark, log):
    assert log.append_once(rows(spark, (1, "a"), (1, "a"), (2, "b")), "key").count() == 2
    assert {r.key for r in log.append_once(rows(spark, (2, "c"), (3, "d")), "key").collect()} == {3}
    assert held(log) == [(1, "a"), (2, "b"), (3, "d")]


def test_a_batch_that_runs_again(spark, log):
    for number, key in ((0, 1), (1, 2), (1, 2), (0, 1)):
        log.sink(rows(spark, (key, "x")), number)
    assert held(log) == [(1, "x"), (2, "x")]
