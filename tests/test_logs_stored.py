"""Queries that read the logs again and again read them from a stored copy."""

import pytest
from pyspark.sql import functions as F
from school import SCHEMAS, day, tables

from coursetrail.operators import completion, incremental
from coursetrail.registry import queries

LOG = SCHEMAS["learning_activities"].replace("lesson_id string", "lesson_id int")


def numbered(spark):
    """The school with logs that come out of a join, on lessons 1 to 400, some rows twice or without a time."""
    rows = [("learner", i, float(i), None, i, i % 2, None if i % 50 == 0 else day(1 + i % 28)) for i in range(1, 401)]
    rows += rows[:3] + [(None, 100, None, None, None, 1, day(2))]
    log = spark.createDataFrame(rows, LOG)
    joined = log.join(log.select("user_id", "lesson_id").distinct().hint("merge"), ["user_id", "lesson_id"], "left").select(*log.columns)
    return tables(spark).with_tables(learning_activities=joined, facilitator_learning_activities=joined.filter("lesson_id < 9"))


def test_stored_logs_are_the_logs(spark):
    t = numbered(spark)
    held = queries.with_logs_stored(t)
    for name in completion.LOGS.values():
        assert held[name].schema.simpleString() == t[name].schema.simpleString()
        assert sorted(map(str, held[name].collect())) == sorted(map(str, t[name].collect()))
        plan = held[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["completion_late_days", "completion_store_default", "mapping_refresh", "lesson_level_from_store"])
def test_logs_read_often_are_computed_once(spark, monkeypatch, name):
    class Stored(Exception):
        pass

    built = []

    def stored(t, build=None):
        built.append(build)
        raise Stored

    monkeypatch.setattr(queries, "with_logs_stored", stored)
    with pytest.raises(Stored):
        queries._registered[name](tables(spark))
    assert (built[0] is not None) == (name == "lesson_level_from_store")


def test_late_days_of_joined_logs(spark):
    found = queries.completion_late_days(numbered(spark)).collect()
    # Of the lessons taken out, one attempt is finished: that without a user.
    assert [(r["day"], r["source"]) for r in found] == [(day(2).date(), "learner")]


def test_any_number_of_days_is_few_comparisons_a_row(spark):
    """Single days far apart: the scan is told few stretches, and no day between them gets through."""
    rows = [("learner", "l1", float(i), None, None, 1, day(1).replace(year=1900 + i)) for i in range(120)]
    t = tables(spark, learning_activities=[*rows, ("learner", "l1", None, None, None, 1, None)])
    days = [r[6].date() for r in rows[::2]]
    read = incremental.attempts_of(t, "learner", days)
    assert sorted(r["score"] for r in read.collect()) == [float(i) for i in range(0, 120, 2)]
    assert read._jdf.queryExecution().optimizedPlan().toString().count(" >= ") <= 20
    assert incremental.attempts_of(t, "learner", [*days, None]).filter(F.col("score").isNull()).count() == 1
    assert incremental.attempts_of(t, "learner", []).count() == 0
