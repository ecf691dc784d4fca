"""Conditions and derived columns, all as built-in column expressions.

Every condition spells out its NULL branch, so none depends on three-valued logic
falling the right way.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from coursetrail.functions.constants import (
    ADMIN, ALL_TYPES, EXCLUDED_LESSON_TYPES, FACILITATOR, PLATFORMS, STAFF_TYPES,
)

WHITESPACE = " \t\n\r\x0b\x0c"


def is_active(status: Column, deleted_at: Column) -> Column:
    return (status == 1) & deleted_at.isNull()


def is_active_user(prefix: str = "") -> Column:
    return F.col(prefix + "type").isin(*ALL_TYPES) & is_active(F.col(prefix + "status"), F.col(prefix + "deleted_at"))


def allocation_path(user_type: Column, is_ple: Column) -> Column:
    """Staff by type, otherwise by the PLE flag, where a missing flag means no."""
    return (F.when(user_type.isin(*STAFF_TYPES), "staff")
            .when(F.coalesce(is_ple, F.lit(0)) == 1, "ple")
            .otherwise("non_ple"))


def platform_allows(path: Column, subject_is_ple: Column) -> Column:
    """Subjects without a platform flag belong to no path."""
    return reduce(or_, [(path == name) & subject_is_ple.isin(*flags) for name, flags in PLATFORMS.items()])


def year_allows(year_to_map: Column, duration: Column) -> Column:
    return year_to_map.isNull() | (year_to_map == 0) | duration.isNull() | (year_to_map <= duration)


def is_master(is_master_trainer: Column) -> Column:
    return F.coalesce(is_master_trainer, F.lit(0)) == 1


def access_role(user_type: Column, is_master_trainer: Column) -> Column:
    """Which of the four lesson views a user has."""
    return (F.when(user_type == ADMIN, "admin")
            .when((user_type == FACILITATOR) & is_master(is_master_trainer), "master")
            .when(user_type == FACILITATOR, "facilitator")
            .otherwise("learner"))


def role_sees(role: Column, student: Column, facilitator: Column, master: Column) -> Column:
    """Whether a lesson with these access flags is open to a role."""
    return F.coalesce(
        (role == "admin") | ((role == "learner") & (student == 1))
        | ((role == "facilitator") & (facilitator == 1)) | ((role == "master") & (master == 1)),
        F.lit(False))


def assessment_flag(is_assessment: Column, name: Column) -> Column:
    return F.when((is_assessment == 1) | F.upper(name).contains("ASSESSMENT"), 1).otherwise(0)


def toolkit_type(student: Column, facilitator: Column, master: Column) -> Column:
    return F.when(student == 1, "student").when(facilitator == 1, "facilitator").when(master == 1, "master")


def is_excluded_type(lesson_type: Column) -> Column:
    """Case and outer whitespace are ignored; a lesson without a type is kept."""
    plain = F.lower(F.btrim(F.coalesce(lesson_type, F.lit("")), F.lit(WHITESPACE)))
    return plain.isin(*EXCLUDED_LESSON_TYPES)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled double to the nearest integer, ties to even, and scale back."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale
