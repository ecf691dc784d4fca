import datetime as dt

import pytest
from pyspark.sql import functions as F
from school import attempt, day, frame, school, tables, user

from coursetrail.operators import completion, deltas, fingerprint, incremental, rollup
from coursetrail.plans import outputs
from coursetrail.scope import Scope
from coursetrail.sinks.snapshot import Change, Snapshots
from coursetrail.sinks.user_table import UserTable, write_csv


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_changed_users(spark):
    t = tables(spark)
    assert {r[0] for r in incremental.changed_users(t, "2024-01-03").collect()} == {"learner"}
    assert incremental.changed_users(t, "2024-02-01").isEmpty()


def test_rebuild_keeps_open_lessons_and_rows_without_lesson(spark):
    rows = {(r.user_id, r.lesson_id): r for r in incremental.rebuild(tables(spark), "learner").collect()}
    assert ("learner", "l_off") not in rows and ("learner", None) in rows and ("learner", "l7") not in rows
    assert ("facil", "l1") not in rows
    assert rows["learner", "l1"].score == 80.0


def test_upsert_needs_no_order(spark):
    columns = completion.ATTEMPT
    make = lambda rows: spark.createDataFrame([(u, l, s, r, d, at) for u, l, s, r, d, _, at in rows],
                                              "user_id string, lesson_id string, score double, rating double, "
                                              "duration bigint, completed_at timestamp_ntz").select(*columns)
    old = make([attempt("a", "x", 1.0, at=2), attempt("a", "y", 1.0, at=2)])
    new = make([attempt("a", "x", 2.0, at=3), attempt("b", "x", 5.0, at=1)])
    late = make([attempt("a", "x", 9.0, at=1), attempt("a", "z", 9.0, at=1)])
    one = incremental.upsert(incremental.upsert(old, new), late)
    other = incremental.upsert(incremental.upsert(incremental.upsert(late, new), old), new)
    assert same(one, other)
    assert {(r.user_id, r.lesson_id, r.score) for r in one.collect()} == {
        ("a", "x", 2.0), ("a", "y", 1.0), ("a", "z", 9.0), ("b", "x", 5.0)}


def test_user_table(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "user_id string, v int")
    table = UserTable(spark, str(tmp_path / "t"), buckets=4)
    assert not table.exists()
    table.replace_users(make([("a", 1), ("b", 2), ("c", 3), ("d", 4)]), make([("a", 0), ("b", 0), ("c", 0)]))
    again = UserTable(spark, str(tmp_path / "t"))
    assert again.buckets == 4
    with pytest.raises(ValueError):
        UserTable(spark, str(tmp_path / "t"), buckets=7)
    users = make([("a", 0), ("c", 0), ("new", 0)])
    again.replace_users(make([("a", 10), ("a", 11), ("new", 12), ("stranger", 13)]), users)
    assert sorted(tuple(r) for r in again.read().collect()) == [("a", 10), ("a", 11), ("b", 2), ("new", 12)]
    again.append(make([("b", 20)]))
    assert sorted(tuple(r) for r in again.read_users(make([("b", 0)])).collect()) == [("b", 2), ("b", 20)]
    again.delete_users(make([(u, 0) for u in ("a", "b", "new")]))
    assert again.read().isEmpty()
    again.overwrite(make([("z", 1)]))
    assert again.read().count() == 1


def test_refresh(spark, tmp_path):
    rows = school()
    before = {**rows, "learning_activities": [r for r in rows["learning_activities"] if r[6] <= day(2)]}
    later = rows["learning_activities"] + [attempt("idle", "l5", 77.0, at=6)]
    old = tables(spark, learning_activities=before["learning_activities"])
    new = tables(spark, learning_activities=later)
    at = lambda name: UserTable(spark, str(tmp_path / name), buckets=8)
    targets = outputs.Targets(at("lesson"), at("subject"), at("all"), UserTable(spark, str(tmp_path / "json"), 8, "tlo_users_id"))
    first = outputs.refresh(old, targets).first()
    assert first.users == targets.lesson.read().select("user_id").distinct().count()
    assert same(targets.lesson.read(), outputs.lesson_level_full(old))

    summary = outputs.refresh(new, targets, since="2024-01-03").first()
    assert summary.users == 2
    assert same(targets.lesson.read(), outputs.lesson_level_full(new))
    assert same(targets.subject.read(), outputs.subject_level(new))
    assert same(targets.json.read(), outputs.user_json(new))
    assert same(targets.subject_all_types.read(), outputs.subject_level(new, all_types=True))

    # A scope replaces only its own users, and a dry run replaces nothing.
    outputs.refresh(old, targets, Scope(user_id="learner"))
    scores = {(r.user_id, r.lesson_id): r.score for r in targets.lesson.read().collect()}
    assert scores["learner", "l1"] == 50.0 and scores["idle", "l5"] == 77.0
    outputs.refresh(old, targets, dry_run=True).collect()
    assert {(r.user_id, r.lesson_id): r.score for r in targets.lesson.read().collect()} == scores
    with pytest.raises(ValueError):
        outputs.refresh(old, targets, Scope(subject_id="s1"))


def test_choice_of_outputs(spark, tmp_path):
    lesson, subject = UserTable(spark, str(tmp_path / "l")), UserTable(spark, str(tmp_path / "s"))
    outputs.refresh(tables(spark), outputs.outputs_of(["subject"], lesson, subject))
    assert not lesson.exists() and subject.exists()
    with pytest.raises(ValueError):
        outputs.outputs_of(["lessn"], lesson, subject)


def test_csv(spark, tmp_path):
    write_csv(outputs.no_allocation_users(outputs.lesson_level_full(tables(spark))), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["user_id"] + outputs.NO_ALLOCATION_COLUMNS[1:] and back.count() == 4


def test_fingerprint(spark, tmp_path):
    t = tables(spark)
    path = str(tmp_path / "snapshot")
    assert fingerprint.allocation_changed(t, path)
    fingerprint.save_snapshot(t, path)
    assert not fingerprint.allocation_changed(t, path)
    turned = tables(spark, users=list(reversed(school()["users"])))
    assert not fingerprint.allocation_changed(turned, path)
    moved = [user("learner", centre="c2")] + school()["users"][1:]
    changed = tables(spark, users=moved)
    assert fingerprint.allocation_changed(changed, path)
    assert not fingerprint.allocation_changed(changed, path, strategy="row_count")
    names = fingerprint.changed_tables(fingerprint.table_fingerprint(changed), spark.read.parquet(path)).filter("changed")
    assert [r.table_name for r in names.collect()] == ["users"]


def test_stored_allocation(spark, tmp_path):
    from coursetrail.operators import allocation
    t = tables(spark)
    store = UserTable(spark, str(tmp_path / "allocation"), buckets=4)
    store.overwrite(allocation.combined(t))
    users = spark.createDataFrame([("batched",), ("ple",)], "user_id string")
    assert same(store.read_users(users), allocation.combined(t, Scope(user_ids=["batched", "ple"])))


def test_run_summary(spark):
    row = rollup.run_summary(outputs.lesson_level_full(tables(spark))).first().asDict()
    assert row["users"] == 15 and row["no_allocation_users"] == 4 and row["ple_users"] == 1 and row["staff_users"] == 3


def test_stored_completion(spark, tmp_path):
    rows = school()["learning_activities"]
    old = tables(spark, learning_activities=[r for r in rows if r[6] <= day(2)])
    new = tables(spark, learning_activities=rows + [attempt("idle", "l5", 7.0, at=8)])
    store = UserTable(spark, str(tmp_path / "done"), buckets=4)
    incremental.update_store(old, "learner", store)
    assert same(store.read(), incremental.rebuild(old, "learner"))
    incremental.update_store(new, "learner", store)
    assert same(store.read(), incremental.rebuild(new, "learner"))
    incremental.update_store(old, "learner", store, full=True)
    assert same(store.read(), incremental.rebuild(old, "learner"))


def test_stored_completion_takes_late_equal_and_timeless_attempts(spark, tmp_path):
    rows = [attempt("learner", "l1", 1.0, at=5)]
    late = [attempt("idle", "l5", 2.0, at=4), attempt("idle", "l1", 3.0, at=5), attempt("batched", "l1", 4.0)[:6] + (None,)]
    store = UserTable(spark, str(tmp_path / "done"), buckets=4)
    incremental.update_store(tables(spark, learning_activities=rows), "learner", store)
    new = tables(spark, learning_activities=rows + late)
    incremental.update_store(new, "learner", store)
    assert same(store.read(), incremental.rebuild(new, "learner"))
    # Earlier than the overlap: left out by an update that looks at later days only, and taken by the next one without it.
    very_late = tables(spark, learning_activities=rows + late + [attempt("idle", "l2", 5.0, at=1), attempt("idle", "l7", 6.0, at=6)])
    incremental.update_store(very_late, "learner", store, overlap=dt.timedelta(days=1))
    found = {(r.user_id, r.lesson_id) for r in store.read().collect()}
    assert ("idle", "l7") in found and ("idle", "l2") not in found
    incremental.update_store(very_late, "learner", store)
    assert same(store.read(), incremental.rebuild(very_late, "learner"))


def test_default_update_takes_attempts_a_year_late_and_reads_their_days_only(spark, tmp_path, monkeypatch):
    rows = school()["learning_activities"] + [attempt("idle", "l5", 1.0)[:6] + (day(3) + dt.timedelta(days=400 + i),) for i in range(30)]
    late = [attempt("both", "l5", 9.0)[:6] + (day(3) - dt.timedelta(days=400),), attempt("learner", "l7", 8.0)[:6] + (day(3) + dt.timedelta(days=410),)]
    path = str(tmp_path / "log")
    log = lambda extra: tables(spark, learning_activities=rows + extra).learning_activities
    log([]).write.parquet(path)
    store = UserTable(spark, str(tmp_path / "done"), buckets=4)
    opened = lambda: tables(spark).with_tables(learning_activities=spark.read.parquet(path))
    incremental.update_store(opened(), "learner", store)
    log(late).exceptAll(log([])).write.mode("append").parquet(path)
    asked, attempts_of = [], incremental.attempts_of
    monkeypatch.setattr(incremental, "attempts_of", lambda t, name, days: asked.append(attempts_of(t, name, days)) or asked[-1])
    t = opened()
    incremental.update_store(t, "learner", store)
    assert same(store.read(), incremental.rebuild(t, "learner"))
    read = {r.completed_at.date() for r in asked[0].collect()}
    assert read == {r[6].date() for r in late}
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert "Or(And(GreaterThanOrEqual(completed_at,2022-11-29" in plan, plan
    incremental.update_store(t, "learner", store)
    assert len(asked) == 1


def test_stretches_of_days(monkeypatch):
    at = lambda *numbers: [dt.date(2024, 1, n) for n in numbers]
    assert incremental.stretches([]) == []
    assert incremental.stretches(at(5, 3, 4, 9)) == [(at(3)[0], at(6)[0]), (at(9)[0], at(10)[0])]
    monkeypatch.setattr(incremental, "RANGES", 2)
    assert incremental.stretches(at(1, 3, 9, 20)) == [(at(1)[0], at(10)[0]), (at(20)[0], at(21)[0])]


def test_a_failed_measure_is_no_measure(spark):
    t = tables(spark)
    broken = t.subjects.filter(F.raise_error(F.lit("lost")).isNull())
    known = t.with_tables(subjects=broken)
    with pytest.raises(Exception, match="lost"):
        known.is_small("lessons")
    assert known._measured == {}
    known._loaded["subjects"] = t.subjects
    assert known.is_small("lessons") and known._measured["lessons"][0] == 15


def test_upsert_of_a_source_that_changes_between_jobs_loses_nothing(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "user_id string, v int")
    table = UserTable(spark, str(tmp_path / "t"), buckets=64)
    table.overwrite(make([(f"u{i}", i) for i in range(40)]))
    source = str(tmp_path / "source")
    make([("u1", 100)]).write.parquet(source)
    growing = spark.read.parquet(source)

    def combine(rows):
        # While the table is being changed, the source grows.
        make([(f"u{i}", 200 + i) for i in range(5, 10)]).write.mode("append").parquet(source)
        return rows

    table.upsert(growing, combine)
    found = sorted(tuple(r) for r in table.read().collect())
    assert found == sorted([(f"u{i}", i) for i in range(40)] + [("u1", 100)])


def test_intermediate_tables_go_after_success(spark, tmp_path):
    from coursetrail.session import kept
    with kept(spark.range(3), "gone-later") as rows:
        files = rows.inputFiles()
        assert rows.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(files[0].rpartition("/")[0])


def moved_mappings(spark):
    """The school with changes in every kind of mapping, and the users whom they concern at least."""
    rows = school()
    replaced = {
        "centre_subject": rows["centre_subject"][1:] + [("11", "c2", "s1", 4)],
        "batch_subject": rows["batch_subject"][:2] + [("9", "b1", "s3")],
        "subject_trade": rows["subject_trade"][1:],
        "subject_ple_career_path": rows["subject_ple_career_path"] + [("7", "k1", "s2")],
        "trades": [("t1", 5), ("t2", None)],
        "ple_career_paths": [("k1", "Chef", None), *rows["ple_career_paths"][1:]],
        "subjects": [("s1", "Renamed", 0, None, None, 1, None), *rows["subjects"][1:]],
        "lessons": rows["lessons"][:4] + rows["lessons"][5:],
        "lesson_types": [("video", "mp4"), ("pdf", " PDF ")],
        "users": [user("learner", centre="c2"), user("new", centre="c1"), user("idle", status=0), *[u for u in rows["users"] if u[0] not in ("learner", "idle")]],
        "student_details": rows["student_details"][1:],
        "ple_career_path_user": rows["ple_career_path_user"][1:],
    }
    return rows, replaced


CONCERNED = {  # users that must be found, and some that must not
    "centre_subject": ({"learner", "pdf_only", "admin"}, {"no_centre"}),
    "batch_subject": ({"batched", "both", "twice", "idle", "ple"}, {"learner", "traded", "admin", "pdf_only"}),
    "subject_trade": ({"traded", "both", "twice", "ple"}, {"learner", "batched", "admin", "pdf_only"}),
    "subject_ple_career_path": ({"ple"}, {"learner", "admin"}),
    "trades": ({"traded", "both", "ple"}, {"learner", "batched"}),
    "ple_career_paths": ({"ple"}, {"learner", "admin"}),
    "subjects": ({"learner", "admin", "ple"}, {"pdf_only", "no_centre"}),
    "lessons": ({"learner", "admin"}, {"pdf_only"}),
    "lesson_types": ({"learner", "admin"}, set()),
    "users": ({"learner", "new", "idle"}, {"batched", "admin"}),
    "student_details": ({"batched"}, {"learner", "both"}),
    "ple_career_path_user": ({"ple"}, {"learner", "ple_gone_path"}),
}


@pytest.mark.parametrize("name", CONCERNED)
def test_changes_of_a_mapping_concern_its_users(spark, name):
    rows, replaced = moved_mappings(spark)
    new, columns = tables(spark, **{name: replaced[name]}), fingerprint.WATCHED[name]
    then, now = frame(spark, name, rows[name]), frame(spark, name, replaced[name])
    if name == "centre_subject":
        then, now = (df.withColumnRenamed("order", "subject_order") for df in (then, now))
    then, now = then.select(*columns), now.select(*columns)
    changes = {name: now.exceptAll(then).withColumn("change", F.lit(1)).unionByName(then.exceptAll(now).withColumn("change", F.lit(-1)))}
    before = {t: tables(spark)[t] for t in ("centre_subject", "lessons")}
    found = {r.user_id for r in deltas.concerned_users(new, before, changes).collect()}
    wanted, others = CONCERNED[name]
    assert wanted <= found and not others & found


def test_refresh_after_mapping_changes_recomputes_the_users_concerned(spark, tmp_path, monkeypatch):
    _, replaced = moved_mappings(spark)
    path = str(tmp_path / "states")
    targets = outputs.Targets(UserTable(spark, str(tmp_path / "lesson"), buckets=4), summary=str(tmp_path / "summary"))
    outputs.refresh(tables(spark), targets, snapshot=path)
    asked, inner = [], outputs._written
    monkeypatch.setattr(outputs, "_written", lambda a, b, c, ids, *d: asked.append(None if ids is None else {r.user_id for r in ids.collect()}) or inner(a, b, c, ids, *d))
    moved = tables(spark, batch_subject=replaced["batch_subject"], users=replaced["users"], trades=replaced["trades"],
                   ple_career_path_user=replaced["ple_career_path_user"])
    summary = outputs.refresh(moved, targets, since="2024-02-01", snapshot=path).first()
    whole = outputs.lesson_level_full(moved)
    assert same(targets.lesson.read(), whole)
    assert {"learner", "new", "idle", "batched", "ple", "traded"} <= asked[0] and "admin" not in asked[0]
    # The figures that were kept are those of the whole table.
    assert summary == rollup.run_summary(targets.lesson.read()).first()


def test_states_share_copies_of_tables_that_did_not_change(spark, tmp_path):
    states = Snapshots(spark, str(tmp_path / "states"))
    assert states.latest() is None
    states.save(first := states.take(tables(spark)))
    again = states.take(tables(spark, users=list(reversed(school()["users"]))))
    assert again.tree_path == first.tree_path
    second = states.take(tables(spark, trades=[]))
    assert {n for n in second.copies if second.copies[n] != first.copies[n]} == {"trades"} and states.latest().copies == first.copies
    change = Change(second, first)
    assert {(r.id, r.change) for r in change.rows()["trades"].collect()} == {("t1", -1), ("t2", -1)}
    assert {r.level for r in change.nodes.collect()} == {0, 1, 2, 3}
    states.save(second)
    assert not UserTable(spark, "x").has(first.copies["trades"]) and UserTable(spark, "x").has(first.copies["users"])
