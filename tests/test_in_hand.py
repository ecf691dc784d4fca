"""Scopes: who is in them, and that only their attempts are grouped."""

import pytest
from school import tables

from coursetrail.operators import users
from coursetrail.plans import outputs
from coursetrail.scope import Scope
from coursetrail.sources.tables import Tables


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def ids(frame, column="user_id"):
    return {r[0] for r in frame.select(column).distinct().collect()}


@pytest.mark.parametrize("scope", [Scope(batch_id="b1"), Scope(trade_id="t1"), Scope(batch_id="b1", trade_id="t1"), Scope(centre_id="c2")])
def test_staff_is_in_a_scope_only_by_its_profile(spark, scope):
    t = tables(spark)
    full = ids(outputs.lesson_level_full(t, scope))
    assert full == ids(users.active(t, scope))
    assert ids(outputs.lesson_level(t, scope)) <= full
    assert ids(outputs.subject_level(t, scope)) <= full


def test_scoped_rows_are_those_of_everyone(spark):
    t = tables(spark)
    chosen = spark.createDataFrame([("learner",), ("facil",), ("idle",)], "user_id string")
    everyone = outputs.lesson_level_full(t)
    for scope in (Scope(user_ids=chosen), Scope(user_ids=["learner", "facil", "idle"])):
        rows = outputs.lesson_level_full(t, scope)
        expected = everyone.filter("user_id IN ('learner', 'facil', 'idle')")
        assert rows.exceptAll(expected).isEmpty() and expected.exceptAll(rows).isEmpty()
    one = outputs.lesson_level_full(t, Scope(user_id="learner"))
    assert one.exceptAll(everyone.filter("user_id = 'learner'")).isEmpty()


def test_attempts_of_others_go_before_they_are_grouped(spark):
    t = tables(spark)
    frame = spark.createDataFrame([("learner",)], "user_id string")
    for scope in (Scope(user_ids=frame), Scope(centre_id="c1"), Scope(batch_id="b1")):
        plan = plan_of(outputs.lesson_level_full(t, scope))
        groups = [part for part in plan.split("Aggregate [user_id")[1:] if "max(score" in part.split("\n")[0]]
        assert len(groups) == 2
        assert all("LeftSemi" in part for part in groups), plan


def test_at_most_one_job_measures(spark):
    t = tables(spark)
    spark.sparkContext.setJobGroup("measuring", "")
    try:
        outputs.lesson_level_full(t)
        outputs.lesson_level_full(t.with_tables(users=t.users.limit(3)))
        # Under adaptive execution one query may show as several jobs; no more than its exchange and its result.
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("measuring")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_logs_of_a_database_are_not_read_by_one_task(spark):
    t = Tables.from_jdbc(spark, "jdbc:none", {})
    with pytest.raises(ValueError, match="partitioning"):
        t.learning_activities
