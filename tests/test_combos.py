import datetime as dt
import json

import pytest
from school import tables

from coursetrail.operators import combos
from coursetrail.plans import outputs
from coursetrail.schema import USER_JSON_TARGET
from coursetrail.scope import Scope
from coursetrail.sinks import schema_check


def test_user_json(spark):
    t = tables(spark)
    frame = outputs.user_json(t)
    assert frame.columns == list(USER_JSON_TARGET)
    rows = {r.tlo_users_id: r for r in frame.collect()}
    assert set(rows) == {"learner", "batched", "no_centre"}
    learner = rows["learner"]
    phases = json.loads(learner.project_phase_combos)
    assert phases == [
        {"pr": None, "pi": "p1", "pn": "One", "phi": None, "ph": None},
        {"pr": "Prog é", "pi": "p2", "pn": "Two", "phi": None, "ph": None}]
    assert "é" in learner.project_phase_combos and " :" not in learner.project_phase_combos
    assert (learner.ple_enabled, learner.batch_status) == ("PLE Centres", "Not in Batch")
    assert (learner.created_at, learner.first_login) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    subjects = json.loads(learner.subject_combos)
    assert [s["i"] for s in subjects] == ["s1", "s2"]
    assert subjects[0] == {"i": "s1", "s": 80.0, "r": 3.0, "c": 2, "a": 3, "aa": 2, "al": 1, "ca": 1, "cl": 1, "y": None}
    assert (learner.a_overa_less_asses_c, learner.c_overa_less_asses_c, learner.rounded_completion) == (6, 3, 50.0)
    assert json.loads(rows["batched"].project_phase_combos)[0]["ph"] == "Phase 1"
    empty = rows["no_centre"]
    assert empty.project_phase_combos is None and empty.subject_combos is None and empty.a_overa_lesson_c is None
    assert empty.ple_enabled == "Non-PLE Centres"


def test_stored_subject_table_and_scope(spark):
    t = tables(spark)
    stored = outputs.subject_level(t)
    scope = Scope(user_id="learner")
    assert outputs.user_json(t, scope, stored).collect() == outputs.user_json(t).filter("tlo_users_id = 'learner'").collect()


def test_readers(spark):
    t = tables(spark)
    rows = outputs.user_json(t)
    assert [r.tlo_users_id for r in combos.find_by_phase(rows, "One", "Phase 1").collect()] == ["batched"]
    assert combos.find_by_phase(rows, "Two", "Phase 1").isEmpty()
    assert sorted(r.tlo_users_id for r in combos.find_by_subject(rows, "s2").collect()) == ["batched", "learner"]


def test_schema(spark):
    rows = outputs.user_json(tables(spark))
    enforced = schema_check.enforce(rows)
    assert [f.dataType.simpleString() for f in enforced.schema] == [kind for kind, _ in USER_JSON_TARGET.values()]
    assert schema_check.too_long(rows).filter("violations > 0").isEmpty()
    wide = rows.selectExpr(*[("'12' AS is_ple" if c == "is_ple" else c) for c in rows.columns])
    assert {(r.column_name, r.violations) for r in schema_check.too_long(wide).filter("violations > 0").collect()} == {("is_ple", 3)}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="p_phase_id"):
        combos.project_phase(combos.user_project_phase(tables(spark)).drop("p_phase_id"))
    with pytest.raises(ValueError):
        combos.user_id_column(["name"])
    assert combos.user_id_column(["id", "user_id"]) == "user_id"


def test_payload(spark):
    t = tables(spark)
    rows = combos.subject(outputs.subject_level(t))
    stats, texts = combos.payload_stats(rows).first(), [r.subject_combos for r in rows.collect()]
    assert (stats.users, stats.total_length) == (len(texts), sum(map(len, texts)))
