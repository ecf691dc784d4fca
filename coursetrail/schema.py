"""Fixed column lists and types of the outputs, and value types of the inputs.

Identifier columns keep the type of the source (text in production, integers in the
test mapping), so they are marked with ``ID`` and never cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID = "id"

# Value types per source table; columns that are not listed pass through untouched.
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "users": {"type": "int", "is_master_trainer": "int", "is_ple": "int", "status": "int",
              "created_at": "timestamp_ntz", "deleted_at": "timestamp_ntz"},
    "student_details": {},
    "subjects": {"is_ple": "int", "year_to_map": "int", "status": "int", "deleted_at": "timestamp_ntz"},
    "lessons": {"lesson_order": "int", "is_assessment": "int", "student_access": "int", "facilitator_access": "int",
                "mastertrainer_access": "int", "status": "int", "deleted_at": "timestamp_ntz"},
    "lesson_types": {},
    "trades": {"duration": "int"},
    "centre_subject": {"subject_order": "int"},
    "batch_subject": {},
    "subject_trade": {},
    "ple_career_paths": {"deleted_at": "timestamp_ntz"},
    "subject_ple_career_path": {},
    "ple_career_path_user": {"status": "int", "updated_at": "timestamp_ntz", "deleted_at": "timestamp_ntz"},
    "learning_activities": {"score": "double", "rating": "double", "duration": "bigint", "completed": "int",
                            "completed_at": "timestamp_ntz"},
    "facilitator_learning_activities": {"score": "double", "rating": "double", "duration": "bigint",
                                        "completed": "int", "completed_at": "timestamp_ntz"},
    "login_logs": {"created_at": "timestamp_ntz"},
    "main_users": {"created_at": "timestamp_ntz"},
    "main_centre_project": {"ple_enabled": "int"},
    "main_phases": {},
}

USER_TOTALS = [
    "total_allocated", "total_lessons_allocated", "total_assessments_allocated",
    "total_completed", "total_lessons_completed", "total_assessments_completed",
]
SUBJECT_ALLOCATED = ["subj_total_allocated", "subj_lessons_allocated", "subj_assessments_allocated"]
SUBJECT_COMPLETED = ["subj_total_completed", "subj_lessons_completed", "subj_assessments_completed"]

PERSON = {"user_id": ID, "user_name": "string", "user_type": "int", "centre_id": ID, "project_id": ID,
          "batch_id": ID, "trade_id": ID}
CAREER = {"career_path_id": ID, "career_path_name": "string"}
SUBJECT = {"subject_id": ID, "subject_name": "string", "subject_is_ple": "int", "ple_career_path_id": ID,
           "year_to_map": "int", "subject_order": "int"}
LESSON = {"lesson_id": ID, "lesson_name": "string", "lesson_order": "int", "lesson_type": "string",
          "is_assessment": "int", "toolkit_type": "string"}
PATH = {"trade_duration": "int", "allocation_path": "string", "allocation_basis": "string"}
RESULT = {"score": "double", "rating": "double", "data_from": "string", "duration": "bigint", "completed": "int"}

SUBJECT_MAP_OUTPUT = {**PERSON, "is_master_trainer": "int", **CAREER, "career_path_updated_at": "timestamp_ntz",
                      **SUBJECT, **PATH}
ALLOCATION_OUTPUT = {**PERSON, **CAREER, **SUBJECT, **LESSON, **PATH}
PATH_ALLOCATION_OUTPUT = {**PERSON, **CAREER, "career_path_updated_at": "timestamp_ntz", **SUBJECT, **LESSON, **PATH}
LESSON_LEVEL_OUTPUT = {
    **PERSON, **CAREER, **SUBJECT, **LESSON, **PATH, **RESULT,
    **{c: "bigint" for c in USER_TOTALS}, "completion_pct": "double",
    **{c: "bigint" for c in SUBJECT_ALLOCATED + SUBJECT_COMPLETED},
}
LESSON_LEVEL_FULL_OUTPUT = {**LESSON_LEVEL_OUTPUT, "is_master_trainer": "int", "is_ple": "int"}
SUBJECT_LEVEL_OUTPUT = {
    **PERSON, **CAREER,
    "subject_id": ID, "subject_name": "string", "subject_is_ple": "int", "year_to_map": "int",
    "allocation_basis": "string",
    **{c: "bigint" for c in USER_TOTALS}, "completion_pct": "double",
    **{c: "bigint" for c in SUBJECT_ALLOCATED + SUBJECT_COMPLETED},
    "avg_score": "double", "avg_rating": "double", "avg_duration": "double", "total_duration": "bigint",
}

# The declared target types of the one-row-per-user table. A number in
# brackets is the longest text the column may hold.
USER_JSON_TARGET: dict[str, tuple[str, int | None]] = {
    "tlo_users_id": ("string", 36),
    "user_name": ("string", 250),
    "gender": ("string", 12),
    "created_at": ("date", None),
    "centre_name": ("string", 100),
    "org_name": ("string", 70),
    "state_name": ("string", 25),
    "district_name": ("string", 35),
    "trade": ("string", 60),
    "batch_name": ("string", 90),
    "batch_status": ("string", 12),
    "centre_type": ("string", 35),
    "user_type": ("string", 15),
    "platform": ("string", 20),
    "is_ple": ("string", 1),
    "ple_enabled": ("string", 15),
    "project_phase_combos": ("string", 65535),
    "subject_combos": ("string", 16777215),
    "a_overa_less_asses_c": ("int", None),
    "a_overa_assess_c": ("int", None),
    "a_overa_lesson_c": ("int", None),
    "c_overa_less_asses_c": ("int", None),
    "c_overa_asse_c": ("int", None),
    "c_overa_less_c": ("int", None),
    "rounded_completion": ("decimal(10,2)", None),
    "first_login": ("date", None),
}


def shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select exactly ``columns``, cast; a column the frame lacks becomes a typed NULL."""
    have = set(df.columns)

    def one(name: str, kind: str) -> Column:
        if name not in have:
            return F.lit(None).cast("string" if kind == ID else kind).alias(name)
        return (F.col(name) if kind == ID else F.col(name).cast(kind)).alias(name)

    return df.select(*[one(name, kind) for name, kind in columns.items()])


def require(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
