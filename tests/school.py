"""A small hand-made school: every rule has a row that meets it and one that does not."""

from __future__ import annotations

import datetime as dt

from coursetrail.functions.constants import LESSON_CATEGORY
from coursetrail.sources.tables import Tables

SCHEMAS = {
    "users": "id string, name string, email string, mobile string, type int, is_master_trainer int, centre_id string, "
             "project_id string, organisation_id string, is_ple int, status int, created_at timestamp_ntz, deleted_at timestamp_ntz",
    "student_details": "user_id string, batch_id string, trade_id string, educational_qualification_id string, "
                       "placement_status_id string, active_year string, year_of_admission string",
    "subjects": "id string, name string, is_ple int, ple_career_path_id string, year_to_map int, status int, deleted_at timestamp_ntz",
    "lessons": "id string, name string, subject_id string, lesson_order int, lesson_type_id string, lesson_category_id string, "
               "is_assessment int, student_access int, facilitator_access int, mastertrainer_access int, status int, deleted_at timestamp_ntz",
    "lesson_types": "id string, name string",
    "trades": "id string, duration int",
    "centre_subject": "id string, centre_id string, subject_id string, order int",
    "batch_subject": "id string, batch_id string, subject_id string",
    "subject_trade": "id string, subject_id string, trade_id string",
    "ple_career_paths": "id string, name string, deleted_at timestamp_ntz",
    "subject_ple_career_path": "id string, ple_career_path_id string, subject_id string",
    "ple_career_path_user": "id string, user_id string, job_type_id string, status int, updated_at timestamp_ntz, deleted_at timestamp_ntz",
    "learning_activities": "user_id string, lesson_id string, score double, rating double, duration bigint, completed int, completed_at timestamp_ntz",
    "facilitator_learning_activities": "user_id string, lesson_id string, score double, rating double, duration bigint, completed int, completed_at timestamp_ntz",
    "login_logs": "user_id string, created_at timestamp_ntz",
    "main_users": "id string, name string, gender string, created_at timestamp_ntz, centre_name string, organisation_name string, "
                  "centre_state string, centre_district string, trade string, batch_name string, centre_type string, user_type string, "
                  "created_platform string, is_ple string, centre_id string, batch_id string",
    "main_centre_project": "centre_id string, project_id string, program_name string, project_name string, ple_enabled int",
    "main_phases": "p_user_id string, p_batch_id string, p_centre_id string, p_project_id string, p_phase_id string, phase_name string",
}
GONE = dt.datetime(2020, 1, 1)


def day(number: int) -> dt.datetime:
    return dt.datetime(2024, 1, number)


def user(name, kind=3, *, mt=None, centre="c1", ple=None, status=1, deleted=None):
    return (name, name.upper(), None, None, kind, mt, centre, "p1", "o1", ple, status, day(1), deleted)


def profile(name, batch=None, trade=None, qualification=None):
    return (name, batch, trade, qualification, None, None, None)


def subject(name, is_ple=0, year=None, status=1, deleted=None):
    return (name, name.upper(), is_ple, None, year, status, deleted)


def lesson(name, subject_id, order=1, kind="video", *, category=LESSON_CATEGORY, graded=0, title=None, student=1,
           facilitator=0, master=0, status=1, deleted=None):
    return (name, title or name, subject_id, order, kind, category, graded, student, facilitator, master, status, deleted)


def attempt(user_id, lesson_id, score=None, rating=None, duration=None, done=1, at=2):
    return (user_id, lesson_id, score, rating, duration, done, day(at))


def school() -> dict[str, list[tuple]]:
    return {
        "users": [
            user("learner"), user("batched"), user("traded"), user("both"), user("twice"), user("idle"),
            user("ple", ple=1), user("ple_no_path", ple=1), user("ple_gone_path", ple=1),
            user("admin", 1), user("facil", 2), user("master", 2, mt=1), user("alumnus", 4, ple=0),
            user("pdf_only", centre="c2"), user("no_centre", centre=None),
            user("inactive", status=0), user("deleted", deleted=GONE), user("visitor", 5),
        ],
        "student_details": [
            profile("batched", "b1"), profile("traded", None, "t1"), profile("both", "b1", "t1"),
            profile("twice", "b1"), profile("twice", "b1", qualification="q"), profile("twice", None, "t1"),
            profile("idle", "b1"), profile("ple", "b1", "t1"), profile("facil", "b1", "t1"),
            profile("no_centre", "b1"), profile("no_centre", "b1"),
        ],
        "subjects": [
            subject("s1"), subject("s2", 2), subject("s3"), subject("s_ple", 1), subject("s_null", None),
            subject("s_off", status=0), subject("s_del", deleted=GONE), subject("s_year3", year=3), subject("s_pdf"),
        ],
        "lessons": [
            lesson("l1", "s1", 1, student=1, facilitator=1), lesson("l2", "s1", 2, graded=1, master=1),
            lesson("l3", "s1", 3, kind="pdf"), lesson("l4", "s1", 4, kind=None, title="Mid assessment"),
            lesson("l5", "s2", 1), lesson("l6", "s3", 1, student=0, facilitator=1), lesson("l7", "s3", 2),
            lesson("l8", "s_ple", 1), lesson("l9", "s_year3", 1), lesson("l10", "s_pdf", 1, kind="pdf"),
            lesson("l_cat", "s1", category="other"), lesson("l_off", "s1", status=0),
            lesson("l_del", "s1", deleted=GONE), lesson("l_null", "s_null"), lesson("l_soff", "s_off"),
        ],
        "lesson_types": [("video", "Video"), ("pdf", " PDF ")],
        "trades": [("t1", 2), ("t2", None)],
        "centre_subject": [
            ("1", "c1", "s1", 1), ("2", "c1", "s2", 2), ("3", "c1", "s3", 3), ("4", "c1", "s_ple", 4),
            ("5", "c1", "s_null", 5), ("6", "c1", "s_off", 6), ("7", "c1", "s_del", 7), ("8", "c1", "s_year3", 8),
            ("9", "c2", "s_pdf", 1), ("10", "c1", "s1", 9),
        ],
        "batch_subject": [("1", "b1", "s1"), ("2", "b1", "s2"), ("3", "b1", "s_ple"), ("4", "b1", "s1")],
        "subject_trade": [("1", "s2", "t1"), ("2", "s3", "t1"), ("3", "s_year3", "t1")],
        "ple_career_paths": [("k1", "Cook", None), ("k2", "Driver", None), ("k_gone", "Gone", GONE)],
        "subject_ple_career_path": [("1", "k1", "s_ple"), ("2", "k2", "s2"), ("3", "k2", "s_ple")],
        "ple_career_path_user": [
            ("1", "ple", "k2", 1, day(2), None), ("2", "ple", "k1", 1, day(3), None), ("3", "ple", "k2", 0, day(9), None),
            ("4", "ple", "k2", 1, day(8), GONE), ("5", "ple_gone_path", "k1", 1, day(2), None),
            ("6", "ple_gone_path", "k_gone", 1, day(5), None),
        ],
        "learning_activities": [
            attempt("learner", "l1", 50.0, 3.0, 60), attempt("learner", "l1", 80.0, None, 30, at=4),
            attempt("learner", "l2", None, None, None), attempt("learner", "l3", 10.0), attempt("learner", "l5", 33.335),
            attempt("learner", "l7", 99.0, done=0), attempt("learner", "l_off", 5.0), attempt("learner", None, 7.0),
            attempt("ple", "l8", 70.0, 4.0, 10), attempt("facil", "l1", 20.0), attempt("batched", "l7", 1.0),
        ],
        "facilitator_learning_activities": [
            attempt("facil", "l1", 60.0, 5.0, 5), attempt("admin", "l6", 40.0, 2.0, 7), attempt("learner", "l1", 95.0),
            attempt("learner", "l4", 15.0), attempt("master", "l1", 12.0),
        ],
        "login_logs": [("learner", day(5)), ("learner", day(3)), (None, day(1))],
        "main_users": [
            ("learner", "LEARNER", "F", day(1), "Centre", "Org", "S", "D", "T", None, "Type", "Learner", "web", "0", "c1", None),
            ("batched", "BATCHED", "M", day(1), "Centre", "Org", "S", "D", "T", "Batch", "Type", "Learner", "web", "0", "c1", "b1"),
            ("no_centre", "NO", "M", day(1), None, "Org", "S", "D", "T", None, "Type", "Learner", "web", "0", None, None),
        ],
        "main_centre_project": [("c1", "p2", "Prog é", "Two", 0), ("c1", "p1", None, "One", 1), ("c1", "p1", None, "One", 1)],
        "main_phases": [("batched", "b1", "c1", "p1", "h1", "Phase 1")],
    }


_frames: dict = {}


def frame(spark, name: str, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMAS[name])


def tables(spark, **changed: list[tuple]) -> Tables:
    """The school as tables; single tables may be given other rows."""
    if not _frames:
        _frames.update({name: frame(spark, name, rows) for name, rows in school().items()})
    other = {name: frame(spark, name, rows) for name, rows in changed.items()}
    return Tables.from_frames(spark, {**_frames, **other})
