"""One row per user with JSON arrays of projects, phases and subjects."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetrail.functions.constants import PHASE_KEYS, SUBJECT_KEYS
from coursetrail.functions.predicates import round_half_even
from coursetrail.operators import users
from coursetrail.schema import USER_JSON_TARGET, require
from coursetrail.scope import EVERYONE, Scope
from coursetrail.sources.tables import Tables

# Column names and short JSON keys of the output.
USER_COLUMNS = ["tlo_users_id", "user_name", "gender", "created_at", "centre_name", "org_name", "state_name",
                "district_name", "trade", "batch_name", "batch_status", "centre_type", "user_type", "platform",
                "is_ple", "ple_enabled"]
USER_ID_NAMES = ("tlo_users_id", "tlo_user_id", "user_id", "id")

OVERALL = {
    "a_overa_less_asses_c": "total_allocated",
    "a_overa_assess_c": "total_assessments_allocated",
    "a_overa_lesson_c": "total_lessons_allocated",
    "c_overa_less_asses_c": "total_completed",
    "c_overa_asse_c": "total_assessments_completed",
    "c_overa_less_c": "total_lessons_completed",
    "rounded_completion": "completion_pct",
}
_SUBJECT_SOURCE = {
    "sub_id": "subject_id", "avg_score_a": "avg_score", "avg_rating_a": "avg_rating",
    "c_sub_w_less_asse_c": "subj_total_completed", "a_sub_w_less_asse_c": "subj_total_allocated",
    "a_sub_w_assess_c": "subj_assessments_allocated", "a_sub_w_lesson_c": "subj_lessons_allocated",
    "c_sub_w_assess_c": "subj_assessments_completed", "c_sub_w_less_c": "subj_lessons_completed",
    "year_category": "year_to_map",
}


def user_id_column(columns: list[str]) -> str:
    """The first of the known user id names that a frame has."""
    for name in USER_ID_NAMES:
        if name in columns:
            return name
    raise ValueError(f"none of {USER_ID_NAMES} among {columns}")


def batch_status(batch_name: Column) -> Column:
    return F.when(batch_name.isNotNull(), "In Batch").otherwise("Not in Batch")


def ple_label(ple_enabled: Column) -> Column:
    return F.when(ple_enabled == 1, "PLE Centres").otherwise("Non-PLE Centres")


def user_project_phase(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """Users with every project of their centre and the phase they are in there, if any."""
    people = scope.profile(scope.users(tables.main_users, user_id="id"))
    people = people.select(
        F.col("id").alias("tlo_users_id"), F.col("name").alias("user_name"), "gender", "created_at", "centre_name",
        F.col("organisation_name").alias("org_name"), F.col("centre_state").alias("state_name"),
        F.col("centre_district").alias("district_name"), "trade", "batch_name",
        batch_status(F.col("batch_name")).alias("batch_status"), "centre_type", "user_type",
        F.col("created_platform").alias("platform"), "is_ple", "centre_id", "batch_id")
    projects = tables.main_centre_project.select(
        "centre_id", "project_id", F.col("program_name").alias("prog_name"), F.col("project_name").alias("proj_name"),
        "ple_enabled")
    phases = tables.main_phases.select(
        F.col("p_user_id").alias("tlo_users_id"), F.col("p_batch_id").alias("batch_id"),
        F.col("p_centre_id").alias("centre_id"), F.col("p_project_id").alias("project_id"), "p_phase_id",
        F.col("phase_name").alias("phase"))
    rows = people.join(projects, "centre_id", "left").join(
        phases, ["tlo_users_id", "batch_id", "centre_id", "project_id"], "left")
    return rows.select(
        *[c for c in USER_COLUMNS if c != "ple_enabled"], ple_label(F.col("ple_enabled")).alias("ple_enabled"),
        "prog_name", "project_id", "proj_name", "p_phase_id", "phase")


def _json_array(record: Column) -> Column:
    """Distinct records of a group as compact JSON, in the order of their fields; none gives NULL."""
    records = F.sort_array(F.collect_set(record))
    return F.when(F.size(records) > 0, F.to_json(records, {"ignoreNullFields": "false"}))


def _record(keys: dict[str, str]) -> Column:
    """A struct with short names; NULL if all its values are NULL, so that it is not collected."""
    present = reduce(or_, [F.col(name).isNotNull() for name in keys])
    return F.when(present, F.struct(*[F.col(name).alias(short) for name, short in keys.items()]))


def project_phase(rows: DataFrame) -> DataFrame:
    """One row per user: the user columns of the smallest project id, and all combinations as JSON."""
    require(rows, list(PHASE_KEYS), "project and phase rows")
    user = user_id_column(rows.columns)
    columns = [c for c in USER_COLUMNS if c in rows.columns and c != user]
    first = F.min(F.struct("project_id", *columns))
    grouped = rows.groupBy(user).agg(first.alias("first"), _json_array(_record(PHASE_KEYS)).alias("project_phase_combos"))
    return grouped.select(user, *[F.col(f"first.{c}").alias(c) for c in columns], "project_phase_combos")


def subject(subject_rows: DataFrame) -> DataFrame:
    """One row per user: subjects as JSON, and the totals, which are equal on all rows of a user."""
    require(subject_rows, ["user_id", *_SUBJECT_SOURCE.values(), *OVERALL.values()], "subject rows")
    averages = ("avg_score_a", "avg_rating_a")
    rows = subject_rows.select(
        F.col("user_id").alias("tlo_users_id"),
        *[(round_half_even(F.col(source), 4) if name in averages else F.col(source)).alias(name)
          for name, source in _SUBJECT_SOURCE.items()],
        *[F.col(source).alias(name) for name, source in OVERALL.items()])
    return rows.groupBy("tlo_users_id").agg(
        _json_array(_record(SUBJECT_KEYS)).alias("subject_combos"), *[F.max(c).alias(c) for c in OVERALL])


def first_login(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """Earliest login per user in the scope."""
    # The users of the JSON table are those of the reporting view, so batch and trade are looked up there.
    logs = tables.login_logs
    if scope.names_users:
        logs = users.restrict(logs, scope.profile(scope.users(tables.main_users, user_id="id")).select(F.col("id").alias("user_id")))
    return logs.filter(F.col("user_id").isNotNull()).groupBy(
        F.col("user_id").alias("tlo_users_id")).agg(F.min("created_at").alias("first_login"))


def user_json(tables: Tables, subject_rows: DataFrame, scope: Scope = EVERYONE) -> DataFrame:
    """One row per user: profile, both JSON arrays, totals and first login."""
    people = project_phase(user_project_phase(tables, scope))
    rows = people.join(subject(subject_rows), "tlo_users_id", "left").join(first_login(tables, scope), "tlo_users_id", "left")
    counts = [c for c in OVERALL if c != "rounded_completion"]
    return rows.withColumns({
        "created_at": F.to_date("created_at"), "first_login": F.to_date("first_login"),
        "rounded_completion": round_half_even(F.col("rounded_completion"), 2),
        **{c: F.col(c).cast("bigint") for c in counts},
    }).select(*USER_JSON_TARGET)


def payload_stats(rows: DataFrame, column: str = "subject_combos") -> DataFrame:
    """Mean and total length of the JSON texts."""
    length = F.length(column)
    return rows.filter(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("users"), round_half_even(F.avg(length), 2).alias("avg_length"),
        F.sum(length).alias("total_length"))


PHASE_RECORDS = "array<struct<pr:string,pi:string,pn:string,phi:string,ph:string>>"
SUBJECT_RECORDS = ("array<struct<i:string,s:double,r:double,c:bigint,a:bigint,aa:bigint,al:bigint,"
                   "ca:bigint,cl:bigint,y:int>>")


def find_by_phase(rows: DataFrame, project_name: str, phase: str) -> DataFrame:
    """Users with a JSON record of this project and phase."""
    records = F.from_json("project_phase_combos", PHASE_RECORDS)
    return rows.filter(F.exists(records, lambda r: (r["pn"] == project_name) & (r["ph"] == phase)))


def find_by_subject(rows: DataFrame, subject_id: str) -> DataFrame:
    """Users with a JSON record of this subject."""
    records = F.from_json("subject_combos", SUBJECT_RECORDS)
    return rows.filter(F.exists(records, lambda r: r["i"] == str(subject_id)))


def as_variant(rows: DataFrame, column: str, records: str) -> DataFrame:
    """The JSON column as VARIANT: read from text once, by whoever stores it, and not by each query."""
    return rows.withColumn(column, F.to_variant_object(F.from_json(column, records)))


def find_in_variant(rows: DataFrame, column: str, **values: str) -> DataFrame:
    """Users with a record of these values in a VARIANT column; no text is parsed."""
    fields = ", ".join(f"{field} string" for field in values)
    records = F.try_variant_get(column, "$", f"array<struct<{fields.replace(' string', ':string')}>>")
    return rows.filter(F.exists(records, lambda r: reduce(and_, [r[field] == str(value) for field, value in values.items()])))


def records_of(rows: DataFrame, column: str, key: str = "tlo_users_id") -> DataFrame:
    """(key, position, record) of every record in a VARIANT column."""
    exploded = rows.sparkSession.tvf.variant_explode(F.col(column).outer())
    return rows.select(key, column).lateralJoin(exploded).select(key, F.col("pos").alias("position"), F.col("value").alias("record"))
