from collections import Counter

import pytest
from school import GONE, attempt, day, lesson, profile, school, subject, tables, user

from coursetrail.operators import allocation, completion, rollup
from coursetrail.operators import users as users_op
from coursetrail.plans import outputs
from coursetrail.scope import Scope


def subjects_of(spark, t, name):
    rows = allocation.combined(t, Scope(user_id=name)).select("subject_id").distinct().collect()
    return {r[0] for r in rows}


def lessons_of(t, name):
    return {r[0] for r in allocation.combined(t, Scope(user_id=name)).select("lesson_id").collect()}


# Centre only, centre and batch, centre and trade, all three; the year rule needs a trade.
@pytest.mark.parametrize("name, expected", [
    ("learner", {"s1", "s2", "s3", "s_year3"}), ("batched", {"s1", "s2"}), ("traded", {"s2", "s3"}), ("both", {"s2"}),
    ("twice", {"s1", "s2", "s3"}), ("alumnus", {"s1", "s2", "s3", "s_year3"}), ("ple", {"s_ple"}), ("ple_no_path", set()),
    ("ple_gone_path", set()), ("no_centre", set()), ("inactive", set()), ("deleted", set()), ("visitor", set()),
    ("pdf_only", {"s_pdf"})])
def test_subjects(spark, name, expected):
    assert subjects_of(spark, tables(spark), name) == expected


@pytest.mark.parametrize("name, expected", [
    ("batched", {"l1", "l2", "l3", "l4", "l5"}), ("admin", {"l1", "l2", "l3", "l4", "l5", "l6", "l7", "l8", "l9"}),
    ("facil", {"l1", "l6"}), ("master", {"l2"}), ("ple", {"l8"})])
def test_lessons(spark, name, expected):
    assert lessons_of(tables(spark), name) == expected


def test_raw_path_keeps_duplicates_and_combined_does_not(spark):
    t = tables(spark)
    raw = Counter((r.user_id, r.lesson_id) for r in allocation.non_ple(t, Scope(user_id="twice")).collect())
    # s1: twice in the centre, twice in the batch, two profile rows with that batch.
    assert raw["twice", "l1"] == 8 and raw["twice", "l7"] == 1
    rows = allocation.combined(t, Scope(user_id="twice")).collect()
    assert Counter(r.lesson_id for r in rows).most_common(1)[0][1] == 1
    kept = next(r for r in rows if r.lesson_id == "l5")
    assert (kept.batch_id, kept.trade_id) == ("b1", None)
    assert next(r for r in rows if r.lesson_id == "l1").subject_order == 1


def test_path_columns(spark):
    t = tables(spark)
    ple = allocation.ple(t).first()
    assert (ple.batch_id, ple.trade_id, ple.career_path_id, ple.trade_duration) == ("b1", None, "k1", 2)
    staff = allocation.staff(t, Scope(user_id="facil")).first()
    assert (staff.batch_id, staff.trade_id, staff.trade_duration, staff.career_path_id) == (None, None, None, None)


def test_ways_to_the_allocation_agree(spark):
    t = tables(spark)
    combined = allocation.combined(t)
    raw = allocation.non_ple(t).unionByName(allocation.ple(t)).unionByName(allocation.staff(t))
    for other in (allocation.one_per_lesson(raw),
                  allocation.expand(t, allocation.subject_map(t)).select(*combined.columns)):
        assert combined.exceptAll(other).isEmpty() and other.exceptAll(combined).isEmpty()


def test_scope(spark):
    t = tables(spark)
    ids = lambda df: {r[0] for r in df.select("user_id").distinct().collect()}
    staff = {"admin", "facil", "master"}
    assert ids(allocation.combined(t, Scope(batch_id="b1"))) == {"batched", "both", "twice", "idle", "ple"} | staff
    assert ids(allocation.combined(t, Scope(batch_id="b1", trade_id="t1"))) == {"both", "ple"} | staff
    assert ids(allocation.combined(t, Scope(user_ids=["ple", "both"]))) == {"ple", "both"}
    assert ids(allocation.combined(t, Scope(subject_id="s_ple"))) == {"ple", "admin"}
    assert ids(allocation.combined(t, paths=("ple",))) == {"ple"}
    assert ids(users_op.active(t, Scope(batch_id="b1"))) == {
        "batched", "both", "twice", "idle", "ple", "facil", "no_centre"}
    frame = spark.createDataFrame([("both",), ("nobody",)], "user_id string")
    assert ids(allocation.combined(t, Scope(user_ids=frame))) == {"both"}


def test_lesson_level_of_one_learner(spark):
    t = tables(spark)
    rows = {r.lesson_id: r for r in outputs.lesson_level(t, Scope(user_id="learner")).collect()}
    assert set(rows) == {"l1", "l2", "l5"}
    one = rows["l1"]
    assert (one.score, one.rating, one.duration, one.completed) == (80.0, 3.0, 90, 1)
    # s1: l1, l2, l4 without the pdf; s2: l5; s3: l7; s_year3: l9.
    assert (one.total_allocated, one.total_assessments_allocated, one.total_completed) == (6, 2, 3)
    assert (one.total_lessons_completed, one.total_assessments_completed, one.completion_pct) == (2, 1, 50.0)
    assert (one.subj_total_allocated, one.subj_assessments_allocated, one.subj_total_completed) == (3, 2, 2)
    assert rows["l2"].duration is None and one.data_from is None


def test_all_types_counts_the_pdf(spark):
    row = outputs.lesson_level(tables(spark), Scope(user_id="learner"), all_types=True).filter("lesson_id = 'l3'").first()
    assert (row.score, row.total_allocated, row.total_completed) == (10.0, 7, 4)


def test_routing_and_attempts(spark):
    t = tables(spark)
    score = lambda name, lesson_id, **o: [
        (r.score, r.duration) for r in outputs.lesson_level(t, Scope(user_id=name), **o).collect() if r.lesson_id == lesson_id]
    assert score("facil", "l1") == [(60.0, 5)]
    assert score("learner", "l1", routing="union") == [(95.0, None)]
    assert score("learner", "l4") == [] and score("learner", "l4", routing="union") == [(15.0, None)]
    assert score("learner", "l1", attempts="latest") == [(80.0, 30)]
    with pytest.raises(ValueError):
        completion.results(t, routing="other")
    with pytest.raises(ValueError):
        completion.lesson_results(t, "learner", attempts="first")


def test_stubs(spark):
    t = tables(spark)
    rows = outputs.lesson_level_full(t).collect()
    zero = [r for r in rows if r.user_id == "idle"]
    assert {r.subject_id for r in zero} == {"s1", "s2"} and all(r.lesson_id is None and r.completed == 0 for r in zero)
    assert all(r.total_completed == 0 and r.subj_total_completed == 0 and r.total_allocated == 4 for r in zero)
    # A completed lesson that is not allocated leaves a user with stubs only.
    assert {r.lesson_id for r in rows if r.user_id == "batched"} == {None}
    none = Counter(r.user_id for r in rows if r.subject_id is None)
    assert none == {"ple_no_path": 1, "ple_gone_path": 1, "pdf_only": 1, "no_centre": 2}
    stub = next(r for r in rows if r.user_id == "no_centre")
    assert (stub.batch_id, stub.total_allocated, stub.completion_pct, stub.subj_total_allocated) == ("b1", 0, 0.0, None)
    assert {r.user_id for r in rows} == {r.user_id for r in users_op.active(t).collect()}
    left = outputs.no_allocation_users(outputs.lesson_level_full(t))
    assert sorted(r.user_id for r in left.collect()) == ["no_centre", "pdf_only", "ple_gone_path", "ple_no_path"]


def test_identical_profile_rows_give_one_stub_each(spark):
    details = school()["student_details"] + [profile("no_centre", None, "t2")]
    rows = outputs.lesson_level_full(tables(spark, student_details=details), Scope(user_id="no_centre")).collect()
    assert Counter((r.batch_id, r.trade_id) for r in rows) == {("b1", None): 2, (None, "t2"): 1}


def test_untouched_subjects_on_request(spark):
    t = tables(spark)
    of = lambda **o: {r.subject_id for r in outputs.subject_level(t, Scope(user_id="learner"), **o).collect()}
    assert of() == {"s1", "s2"} and of(include_untouched=True) == {"s1", "s2", "s3", "s_year3"}


def test_counted_and_exploded_agree(spark):
    t = tables(spark)
    for options in ({}, {"all_types": True}, {"routing": "union"}, {"attempts": "latest"}):
        a, b = completion.merge(t, **options), completion.merge_exploded(t, **options)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), options


def test_invariants(spark):
    rows = outputs.lesson_level_full(tables(spark))
    assert rows.filter("total_completed > total_allocated OR total_lessons_allocated + total_assessments_allocated "
                       "<> total_allocated OR total_lessons_completed + total_assessments_completed <> total_completed").isEmpty()
    done = rows.filter("lesson_id IS NOT NULL")
    assert done.groupBy("user_id", "lesson_id").count().filter("count > 1").isEmpty()
    untouched = outputs.lesson_level(tables(spark), include_untouched=True)
    subjects = rollup.subject_counts(untouched, ["subj_total_allocated", "subj_total_completed"])
    sums = subjects.groupBy("user_id").sum("subj_total_allocated", "subj_total_completed")
    totals = rollup.user_totals(untouched).join(sums, "user_id")
    assert totals.filter("total_allocated <> `sum(subj_total_allocated)` OR "
                         "total_completed <> `sum(subj_total_completed)`").isEmpty()


def test_subject_level(spark):
    row = outputs.subject_level(tables(spark), Scope(user_id="learner")).filter("subject_id = 's1'").first()
    assert (row.avg_score, row.avg_rating, row.avg_duration, row.total_duration) == (80.0, 3.0, 90.0, 90)
    idle = outputs.subject_level(tables(spark), Scope(user_id="idle")).first()
    assert (idle.avg_score, idle.total_duration, idle.completion_pct) == (None, 0, 0.0)


def test_an_empty_school(spark):
    t = tables(spark, **{name: [] for name in school()})
    assert outputs.lesson_level_full(t).isEmpty() and outputs.subject_level(t).isEmpty() and outputs.user_json(t).isEmpty()
    assert rollup.run_summary(outputs.lesson_level_full(t)).first().users == 0


def test_mapping_tables_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    from coursetrail.sources import tables as module
    expected = sorted(map(str, outputs.lesson_level_full(tables(spark)).collect()))
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = outputs.lesson_level_full(tables(spark))
        assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, plan.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
