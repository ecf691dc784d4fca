"""SQL checks of the registered queries, for DuckDB over the same test tables.

They compute everything the long way, with every user x lesson row, so they share no
shortcut with the Spark plans. Only the table mapping is common to both.
"""

from __future__ import annotations

from coursetrail.functions.constants import ALLOCATION_BASIS
from coursetrail.operators.completion import LOGS
from coursetrail.operators.deltas import DEPTH, FAN, key_of
from coursetrail.operators.fingerprint import WATCHED
from coursetrail.registry.queries import BATCH, CENTRE, SCOPE, SINCE
from coursetrail.schema import (
    ALLOCATION_OUTPUT, LESSON_LEVEL_FULL_OUTPUT, LESSON_LEVEL_OUTPUT, PATH_ALLOCATION_OUTPUT, SOURCE_TYPES,
    SUBJECT_LEVEL_OUTPUT, SUBJECT_MAP_OUTPUT, USER_JSON_TARGET,
)
from coursetrail.sources.testmap import VIEWS, with_clause

_BASIS = "CASE allocation_path " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALLOCATION_BASIS.items()) + " END"
_NO_CAREER = ("CAST(NULL AS bigint) AS career_path_id, CAST(NULL AS string) AS career_path_name, "
              "CAST(NULL AS timestamp) AS career_path_updated_at")
_SUBJECT = "s.id AS subject_id, s.name AS subject_name, s.is_ple AS subject_is_ple, s.ple_career_path_id, s.year_to_map"
_PERSON = "p.id AS user_id, p.name AS user_name, p.type AS user_type, p.centre_id, p.project_id"
_YEAR_OK = "(s.year_to_map IS NULL OR s.year_to_map = 0 OR p.duration IS NULL OR s.year_to_map <= p.duration)"
_BATCH_OK = "(p.batch_id IS NULL OR b.id IS NOT NULL)"
_TIES = "subject_order NULLS LAST, batch_id NULLS LAST, trade_id NULLS LAST, trade_duration NULLS LAST"

_LIBRARY: dict[str, str] = {
    "live_users": "SELECT * FROM users WHERE type BETWEEN 1 AND 4 AND status = 1 AND deleted_at IS NULL",
    "profiled_users": """
SELECT u.id AS user_id, u.name AS user_name, email, mobile, u.type AS user_type, is_master_trainer, centre_id, project_id,
  organisation_id, is_ple, created_at, batch_id, trade_id, educational_qualification_id, placement_status_id, active_year,
  year_of_admission
FROM live_users u LEFT JOIN student_details d ON d.user_id = u.id""",
    "learners": """
SELECT u.*, d.batch_id, d.trade_id, t.duration FROM live_users u
LEFT JOIN student_details d ON d.user_id = u.id LEFT JOIN trades t ON t.id = d.trade_id WHERE u.type IN (3, 4)""",
    "live_subjects": "SELECT * FROM subjects WHERE status = 1 AND deleted_at IS NULL",
    "live_lessons": """
SELECT l.id AS lesson_id, l.subject_id, l.name AS lesson_name, l.lesson_order, y.name AS lesson_type,
  CASE WHEN l.is_assessment = 1 OR upper(l.name) LIKE '%ASSESSMENT%' THEN 1 ELSE 0 END AS is_assessment,
  CASE WHEN student_access = 1 THEN 'student' WHEN facilitator_access = 1 THEN 'facilitator'
       WHEN mastertrainer_access = 1 THEN 'master' END AS toolkit_type,
  student_access, facilitator_access, mastertrainer_access
FROM lessons l LEFT JOIN lesson_types y ON y.id = l.lesson_type_id
WHERE l.status = 1 AND l.deleted_at IS NULL AND l.lesson_category_id = 1""",
    "kept_lessons": """
SELECT * FROM live_lessons WHERE lesson_type IS NULL OR lower(trim(lesson_type)) NOT IN ('pdf', 'mp4', 'pdf web')""",
    "enrolments": """
SELECT user_id, job_type_id AS career_path_id, updated_at AS career_path_updated_at FROM ple_career_path_user
WHERE status = 1 AND deleted_at IS NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC NULLS LAST, id DESC) = 1""",
    "subject_paths": f"""
SELECT {_PERSON}, p.batch_id, p.trade_id, p.is_master_trainer, {_NO_CAREER}, {_SUBJECT}, c.subject_order,
  p.duration AS trade_duration, p.trade_id AS own_trade, 'non_ple' AS allocation_path
FROM learners p JOIN centre_subject c ON c.centre_id = p.centre_id JOIN live_subjects s ON s.id = c.subject_id
LEFT JOIN batch_subject b ON b.batch_id = p.batch_id AND b.subject_id = s.id
LEFT JOIN subject_trade t ON t.trade_id = p.trade_id AND t.subject_id = s.id
WHERE coalesce(p.is_ple, 0) <> 1 AND s.is_ple IN (0, 2) AND {_BATCH_OK}
  AND (p.trade_id IS NULL OR t.id IS NOT NULL) AND {_YEAR_OK}
UNION ALL
SELECT {_PERSON}, p.batch_id, NULL, p.is_master_trainer, k.id, k.name, e.career_path_updated_at, {_SUBJECT}, c.subject_order,
  p.duration, p.trade_id, 'ple'
FROM learners p JOIN enrolments e ON e.user_id = p.id
JOIN ple_career_paths k ON k.id = e.career_path_id AND k.deleted_at IS NULL
JOIN centre_subject c ON c.centre_id = p.centre_id JOIN live_subjects s ON s.id = c.subject_id
JOIN subject_ple_career_path m ON m.ple_career_path_id = k.id AND m.subject_id = s.id
LEFT JOIN batch_subject b ON b.batch_id = p.batch_id AND b.subject_id = s.id
WHERE p.is_ple = 1 AND s.is_ple IN (1, 2) AND {_BATCH_OK} AND {_YEAR_OK}
UNION ALL
SELECT {_PERSON}, NULL, NULL, p.is_master_trainer, {_NO_CAREER}, {_SUBJECT}, c.subject_order, NULL, NULL, 'staff'
FROM live_users p JOIN centre_subject c ON c.centre_id = p.centre_id JOIN live_subjects s ON s.id = c.subject_id
WHERE p.type IN (1, 2) AND s.is_ple IN (0, 1, 2)""",
    "path_lessons": f"""
SELECT p.*, l.* EXCLUDE (subject_id), {_BASIS} AS allocation_basis
FROM subject_paths p JOIN live_lessons l ON l.subject_id = p.subject_id
WHERE CASE WHEN user_type >= 3 THEN student_access = 1 WHEN user_type = 1 THEN true
  WHEN is_master_trainer = 1 THEN mastertrainer_access = 1 ELSE facilitator_access = 1 END""",
    "allocated": f"""
SELECT * FROM path_lessons QUALIFY row_number() OVER (PARTITION BY user_id, lesson_id
  ORDER BY career_path_updated_at DESC NULLS LAST, lesson_order NULLS LAST, {_TIES}) = 1""",
    "kept_allocated": "SELECT * FROM allocated SEMI JOIN kept_lessons USING (lesson_id)",
    "attempts": " UNION ALL ".join(
        f"SELECT user_id, lesson_id, score, rating, duration, completed_at, '{log}' AS source "
        f"FROM {table} WHERE completed = 1" for log, table in LOGS.items()),
    "newest_attempts": """
SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY source, user_id, lesson_id
  ORDER BY completed_at DESC NULLS LAST, score DESC NULLS LAST, rating DESC NULLS LAST, duration DESC NULLS LAST) = 1""",
    "done_all": """
SELECT user_id, lesson_id, max(score) AS score, max(rating) AS rating, CAST(sum(duration) AS bigint) AS duration, source
FROM attempts GROUP BY source, user_id, lesson_id""",
    "done_latest": "SELECT user_id, lesson_id, score, rating, duration, source FROM newest_attempts",
    "done_best": """
SELECT * FROM done_all QUALIFY row_number() OVER (PARTITION BY user_id, lesson_id ORDER BY score DESC NULLS LAST, source) = 1""",
    "offered_lessons": """
SELECT DISTINCT l.id AS lesson_id FROM lessons l JOIN live_subjects s ON s.id = l.subject_id
JOIN centre_subject c ON c.subject_id = s.id WHERE l.status = 1 AND l.deleted_at IS NULL""",
}


def _merged(alloc: str, done: str, match: str) -> str:
    return f"""
SELECT a.*, d.score, d.rating, d.duration, CASE WHEN d.user_id IS NULL THEN 0 ELSE 1 END AS completed
FROM {alloc} a LEFT JOIN {done} d ON d.user_id = a.user_id AND d.lesson_id = a.lesson_id{match}"""


def _totals(merged: str) -> str:
    columns = []
    for over, name, short in (("user_id", "total", "total"), ("user_id, subject_id", "subj_total", "subj")):
        for kind, value in (("allocated", "1"), ("completed", "completed")):
            window = f"OVER (PARTITION BY {over})"
            columns += [
                f"CAST(sum({value}) {window} AS bigint) AS {name}_{kind}",
                f"CAST(sum({value} * (1 - is_assessment)) {window} AS bigint) AS {short}_lessons_{kind}",
                f"CAST(sum({value} * is_assessment) {window} AS bigint) AS {short}_assessments_{kind}"]
    return f"""
SELECT *, CAST(NULL AS string) AS data_from,
  round_even(CAST(total_completed AS double) / total_allocated * 100 * 100, 0) / 100 AS completion_pct
FROM (SELECT *, {', '.join(columns)} FROM {merged})"""


_BLANK = ["lesson_id", "lesson_name", "lesson_order", "lesson_type", "is_assessment", "toolkit_type", "score", "rating",
          "duration"]


def _rows(totals: str, untouched: bool = False) -> str:
    """Completed lessons, and one stub per subject where nothing was completed."""
    names = list(LESSON_LEVEL_OUTPUT)
    stub = ", ".join(f"NULL AS {n}" if n in _BLANK else n for n in names)
    scope = "subj_total_completed = 0" if untouched else "total_completed = 0"
    return f"""
SELECT {', '.join(names)} FROM {totals} WHERE completed = 1
UNION ALL
SELECT {stub} FROM (SELECT * FROM {totals} WHERE {scope}
  QUALIFY row_number() OVER (PARTITION BY user_id, subject_id ORDER BY lesson_id) = 1)"""


def _full(rows: str) -> str:
    """Adds the stubs of users without allocation."""
    given = ["user_id", "user_name", "user_type", "centre_id", "project_id", "batch_id", "trade_id", "is_master_trainer",
             "is_ple"]
    zero = [c for c in LESSON_LEVEL_FULL_OUTPUT if c.startswith("total_") or c in ("completion_pct", "completed")]
    stub = ", ".join(n if n in given else f"0 AS {n}" if n in zero else f"NULL AS {n}" for n in LESSON_LEVEL_FULL_OUTPUT)
    return f"""
SELECT *, NULL AS is_master_trainer, NULL AS is_ple FROM {rows}
UNION ALL BY NAME
SELECT {stub} FROM profiled_users WHERE user_id NOT IN (SELECT user_id FROM {rows})"""


def _variant(prefix: str, alloc: str = "kept_allocated", done: str = "done_all", routed: bool = True) -> None:
    match = " AND (d.source = 'staff') = (a.allocation_path = 'staff')" if routed else ""
    _LIBRARY[f"{prefix}merged"] = _merged(alloc, done, match)
    _LIBRARY[f"{prefix}totals"] = _totals(f"{prefix}merged")
    _LIBRARY[f"{prefix}rows"] = _rows(f"{prefix}totals")


_variant("main_")
_variant("best_", done="done_best", routed=False)
_variant("last_", done="done_latest")
_variant("every_", alloc="allocated")
_LIBRARY["untouched_rows"] = _rows("main_totals", untouched=True)
_LIBRARY["full_rows"] = _full("main_rows")
_LIBRARY["old_attempts"] = f"SELECT * FROM attempts WHERE completed_at <= TIMESTAMP '{SINCE}'"
_LIBRARY["done_old"] = _LIBRARY["done_all"].replace("FROM attempts", "FROM old_attempts")
_variant("old_", done="done_old")
_LIBRARY["old_full_rows"] = _full("old_rows")
for _name, _users, _own in (("batch", f"batch_id = {BATCH.batch_id}", f"batch_id = {BATCH.batch_id}"),
                            ("trade", f"trade_id = '{SCOPE.trade_id}'", f"own_trade = '{SCOPE.trade_id}'")):
    _LIBRARY[f"{_name}_lessons"] = f"""
SELECT * FROM path_lessons WHERE user_id IN (SELECT user_id FROM profiled_users WHERE {_users})
  AND (allocation_path = 'staff' OR {_own})"""
    _LIBRARY[f"{_name}_allocated"] = _LIBRARY["allocated"].replace("path_lessons", f"{_name}_lessons")
    _LIBRARY[f"{_name}_kept"] = f"SELECT * FROM {_name}_allocated SEMI JOIN kept_lessons USING (lesson_id)"
    _variant(f"{_name}_", alloc=f"{_name}_kept")


def _subject_level(rows: str) -> str:
    averages = {"avg_score": "score", "avg_rating": "rating", "avg_duration": "duration"}
    columns = []
    for name in SUBJECT_LEVEL_OUTPUT:
        if name in averages:
            columns.append(f"round_even(avg({averages[name]}) * 100, 0) / 100 AS {name}")
        elif name == "total_duration":
            columns.append("CAST(coalesce(sum(duration), 0) AS bigint) AS total_duration")
        elif name in ("user_id", "subject_id"):
            columns.append(name)
        else:
            columns.append(f"max({name}) AS {name}")
    return f"SELECT {', '.join(columns)} FROM {rows} WHERE subject_id IS NOT NULL GROUP BY user_id, subject_id"


_LIBRARY["subject_level"] = _subject_level("main_rows")
_LIBRARY["phase_rows"] = """
SELECT u.id AS tlo_users_id, u.name AS user_name, gender, created_at, centre_name, organisation_name AS org_name,
  centre_state AS state_name, centre_district AS district_name, trade, batch_name,
  CASE WHEN batch_name IS NULL THEN 'Not in Batch' ELSE 'In Batch' END AS batch_status, centre_type, user_type,
  created_platform AS platform, is_ple, CASE WHEN c.ple_enabled = 1 THEN 'PLE Centres' ELSE 'Non-PLE Centres' END AS ple_enabled,
  c.program_name AS prog_name, c.project_id, c.project_name AS proj_name, h.p_phase_id, h.phase_name AS phase
FROM main_users u LEFT JOIN main_centre_project c ON c.centre_id = u.centre_id
LEFT JOIN main_phases h ON h.p_batch_id = u.batch_id AND h.p_centre_id = u.centre_id AND h.p_project_id = c.project_id
  AND h.p_user_id = u.id"""
_LIBRARY["first_rows"] = """
SELECT * EXCLUDE (prog_name, project_id, proj_name, p_phase_id, phase) FROM phase_rows
QUALIFY row_number() OVER (PARTITION BY tlo_users_id ORDER BY project_id) = 1"""
_LIBRARY["phase_json"] = """
SELECT tlo_users_id, CAST(to_json(list({'pr': prog_name, 'pi': project_id, 'pn': proj_name, 'phi': p_phase_id, 'ph': phase}
  ORDER BY prog_name NULLS FIRST, project_id NULLS FIRST, proj_name NULLS FIRST, p_phase_id NULLS FIRST, phase NULLS FIRST)
  FILTER (coalesce(prog_name, proj_name, phase) IS NOT NULL OR coalesce(project_id, p_phase_id) IS NOT NULL)) AS string)
  AS project_phase_combos
FROM (SELECT DISTINCT tlo_users_id, prog_name, project_id, proj_name, p_phase_id, phase FROM phase_rows) GROUP BY tlo_users_id"""
_LIBRARY["subject_json"] = """
SELECT user_id AS tlo_users_id, CAST(to_json(list({'i': subject_id, 's': avg_score, 'r': avg_rating, 'c': subj_total_completed,
  'a': subj_total_allocated, 'aa': subj_assessments_allocated, 'al': subj_lessons_allocated,
  'ca': subj_assessments_completed, 'cl': subj_lessons_completed, 'y': year_to_map} ORDER BY subject_id)) AS string)
  AS subject_combos,
  max(total_allocated) AS a_overa_less_asses_c, max(total_assessments_allocated) AS a_overa_assess_c,
  max(total_lessons_allocated) AS a_overa_lesson_c, max(total_completed) AS c_overa_less_asses_c,
  max(total_assessments_completed) AS c_overa_asse_c, max(total_lessons_completed) AS c_overa_less_c,
  max(completion_pct) AS rounded_completion
FROM subject_level GROUP BY user_id"""
_LIBRARY["logins"] = """
SELECT user_id AS tlo_users_id, min(created_at) AS first_login FROM login_logs WHERE user_id IS NOT NULL GROUP BY user_id"""
_LIBRARY["user_rows"] = f"""
SELECT {', '.join('CAST(' + c + ' AS date) AS ' + c if c in ('created_at', 'first_login') else c for c in USER_JSON_TARGET)}
FROM first_rows LEFT JOIN phase_json USING (tlo_users_id) LEFT JOIN subject_json USING (tlo_users_id)
LEFT JOIN logins USING (tlo_users_id)"""
_LIBRARY["changed"] = f"SELECT DISTINCT user_id FROM attempts WHERE completed_at > TIMESTAMP '{SINCE}'"
_LIBRARY["dump"] = """
SELECT id, CASE WHEN status = 0 THEN '0000-00-00 00:00:00' WHEN deleted_at IS NOT NULL THEN '0001-01-01 00:00:00'
  ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at, CAST(job_type_id AS decimal(12, 2)) AS amount,
  CASE WHEN job_type_id = 3 THEN 'n/a' ELSE CAST(job_type_id AS string) END AS score
FROM ple_career_path_user"""
_LOG_USERS = "SELECT id FROM users WHERE status = 1 AND deleted_at IS NULL AND (source = 'staff') = (type IN (1, 2)) AND type BETWEEN 1 AND 4"
_ATTEMPT = "user_id, lesson_id, score, rating, duration, completed_at, source"
_LIBRARY["stored_completion"] = f"""
SELECT {_ATTEMPT} FROM newest_attempts WHERE user_id IN ({_LOG_USERS}) AND lesson_id IN (SELECT lesson_id FROM offered_lessons)"""


def _names(columns: dict[str, str]) -> str:
    return ", ".join(columns)


def _fingerprint(name: str, source: str | None = None) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS string), '')" for c in WATCHED[name])
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 15) AS bigint)), 0) AS string) AS content_sum "
            f"FROM {source or name}")


_FINGERPRINTS = " UNION ALL ".join(_fingerprint(name) for name in sorted(WATCHED))


def _changed(value: str) -> str:
    before = " UNION ALL ".join(
        _fingerprint(name, "(SELECT * FROM ple_career_path_user WHERE updated_at <= TIMESTAMP '1998-01-01')"
                     if name == "ple_career_path_user" else None)
        for name in sorted(WATCHED) if name != "lesson_types")
    return (f"SELECT n.table_name, o.{value} IS NULL OR o.{value} <> n.{value} AS changed FROM ({_FINGERPRINTS}) n "
            f"LEFT JOIN ({before}) o ON o.table_name = n.table_name")


# The watched tables before the mapping changes of the registered queries.
_BEFORE = {
    "centre_subject": "SELECT * FROM centre_subject WHERE centre_id <> 3 OR subject_order > 2",
    "batch_subject": "SELECT * FROM batch_subject WHERE batch_id <> 7 OR id % 2 = 0",
    "subject_trade": "SELECT * FROM subject_trade WHERE trade_id <> 'MACHINERY' OR id % 3 > 0",
    "subject_ple_career_path": "SELECT * FROM subject_ple_career_path WHERE ple_career_path_id <> 2 OR id % 2 = 0",
    "subjects": "SELECT * REPLACE (CASE WHEN id = 'Brand#23' THEN 1 ELSE status END AS status) FROM subjects",
    "users": "SELECT * REPLACE (CASE WHEN id % 211 = 0 THEN 4 ELSE centre_id END AS centre_id) FROM users",
}


def _row_numbers(name: str, source: str) -> str:
    """Key, bucket and number of every row."""
    text = " || '|' || ".join(f"coalesce(CAST({c} AS string), '')" for c in WATCHED[name])
    key = f"CAST({key_of(name)} AS string)"
    return (f"SELECT '{name}' AS table_name, {key} AS row_key, CAST('0x' || substr(md5(coalesce({key}, '')), 13, 3) AS int) AS leaf, "
            f"CAST('0x' || substr(md5({text}), 1, 15) AS bigint) AS number, {text} AS row_text FROM ({source})")


_NUMBERED = {
    "numbered_now": " UNION ALL ".join(_row_numbers(name, f"SELECT * FROM {name}") for name in sorted(WATCHED)),
    "numbered_before": " UNION ALL ".join(_row_numbers(name, _BEFORE.get(name, f"SELECT * FROM {name}")) for name in sorted(WATCHED)),
}
for _side in ("now", "before"):
    _LIBRARY[f"numbered_{_side}"] = _NUMBERED[f"numbered_{_side}"]
    _LIBRARY[f"tree_{_side}"] = f"""
SELECT table_name, CAST(level AS int) AS level, leaf // CAST(power({FAN}, {DEPTH} - level) AS int) AS node, count(*) AS n, sum(number) AS total
FROM numbered_{_side}, range({DEPTH + 1}) AS t(level) GROUP BY 1, 2, 3"""

_FULL = _names(LESSON_LEVEL_FULL_OUTPUT)
_LENGTHS = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {size} AS max_length, "
    f"count(*) FILTER (length(CAST({name} AS string)) > {size}) AS violations FROM user_rows"
    for name, (_, size) in USER_JSON_TARGET.items() if size)

_QUERIES: dict[str, str] = {
    "users_active": "SELECT * FROM profiled_users",
    "completion_since": f"SELECT {_ATTEMPT} FROM attempts WHERE completed_at > TIMESTAMP '{SINCE}' AND user_id IN ({_LOG_USERS})",
    "sanitize_types": """
SELECT id, CASE WHEN year(TRY_CAST(updated_at AS timestamp)) > 1 THEN TRY_CAST(updated_at AS timestamp) END AS updated_at,
  CAST(amount AS double) AS amount, TRY_CAST(score AS double) AS score FROM dump""",
    "date_cleanup": """
SELECT id, CASE WHEN year(TRY_CAST(updated_at AS timestamp)) > 1 THEN CAST(TRY_CAST(updated_at AS timestamp) AS date) END AS day
FROM dump""",
    "source_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in sorted(SOURCE_TYPES)),
    "allocation_for_users": f"SELECT {_names(ALLOCATION_OUTPUT)} FROM allocated WHERE user_id IN (SELECT user_id FROM changed)",
    "allocation_scoped": f"""
SELECT {_names(ALLOCATION_OUTPUT)} FROM (SELECT * FROM path_lessons
  WHERE allocation_path = 'staff' OR own_trade = '{SCOPE.trade_id}')
QUALIFY row_number() OVER (PARTITION BY user_id, lesson_id
  ORDER BY career_path_updated_at DESC NULLS LAST, lesson_order NULLS LAST, {_TIES}) = 1""",
    "users_by_path": """
SELECT id AS user_id, type AS user_type, is_ple, CASE WHEN type <= 2 THEN 'staff' WHEN is_ple = 1 THEN 'ple' ELSE 'non_ple' END
  AS allocation_path FROM live_users""",
    "optional_intersection": """
SELECT DISTINCT user_id, batch_id, trade_id, subject_id FROM subject_paths WHERE allocation_path = 'non_ple'""",
    "year_to_map_filter": """
SELECT DISTINCT m.trade_id, s.id AS subject_id, s.year_to_map, t.duration FROM subject_trade m
JOIN live_subjects s ON s.id = m.subject_id LEFT JOIN trades t ON t.id = m.trade_id
WHERE coalesce(s.year_to_map, 0) = 0 OR t.duration IS NULL OR s.year_to_map <= t.duration""",
    "lesson_type_filter": "SELECT lesson_id, lesson_type FROM kept_lessons",
    "assessment_flag": """
SELECT id AS lesson_id, name AS lesson_name,
  CASE WHEN is_assessment = 1 OR upper(name) LIKE '%ASSESSMENT%' THEN 1 ELSE 0 END AS is_assessment FROM lessons""",
    "toolkit_type": """
SELECT id AS lesson_id, CASE WHEN student_access = 1 THEN 'student' WHEN facilitator_access = 1 THEN 'facilitator'
  WHEN mastertrainer_access = 1 THEN 'master' END AS toolkit_type FROM lessons""",
    "user_labels": "SELECT DISTINCT tlo_users_id, project_id, batch_status, ple_enabled FROM phase_rows",
    "centre_subjects_per_user": """
SELECT u.id AS user_id, u.centre_id, c.subject_id, c.subject_order FROM live_users u
JOIN centre_subject c ON c.centre_id = u.centre_id""",
    "latest_career_path": "SELECT * FROM enrolments",
    "lesson_dim": """
SELECT l.*, s.name AS subject_name, s.is_ple AS subject_is_ple, s.ple_career_path_id, s.year_to_map
FROM live_lessons l JOIN live_subjects s ON s.id = l.subject_id""",
    **{f"alloc_{path}": f"SELECT {_names(PATH_ALLOCATION_OUTPUT)} FROM path_lessons WHERE allocation_path = '{path}'"
       for path in ALLOCATION_BASIS},
    **{name: f"SELECT {_names(ALLOCATION_OUTPUT)} FROM allocated"
       for name in ("alloc_combined", "allocation_two_stage", "allocation_dedup")},
    "user_subject_map": f"""
SELECT {_names({k: v for k, v in SUBJECT_MAP_OUTPUT.items() if k not in ('is_master_trainer', 'allocation_basis')})},
  CASE WHEN allocation_path = 'staff' THEN is_master_trainer END AS is_master_trainer, {_BASIS} AS allocation_basis
FROM subject_paths QUALIFY row_number() OVER (PARTITION BY user_id, subject_id ORDER BY {_TIES}) = 1""",
    "allocation_ordered": """
SELECT user_id, subject_order, lesson_order, lesson_id FROM allocated ORDER BY user_id, subject_order, lesson_order, lesson_id""",
    "subject_alloc_counts": """
SELECT user_id, subject_id, count(*) AS subj_total_allocated, count(*) FILTER (is_assessment = 0) AS subj_lessons_allocated,
  count(*) FILTER (is_assessment = 1) AS subj_assessments_allocated FROM kept_allocated GROUP BY user_id, subject_id""",
    "completion_by_lesson": "SELECT * FROM done_all",
    "completion_all_users": "SELECT * FROM done_best",
    "completion_cross_table": """
SELECT * FROM done_latest QUALIFY row_number() OVER (PARTITION BY user_id, lesson_id ORDER BY score DESC NULLS LAST, source) = 1""",
    "completion_routed": """
SELECT d.user_id, d.lesson_id, d.score, d.rating, CAST(NULL AS string) AS data_from, d.duration
FROM done_all d JOIN live_users u ON u.id = d.user_id AND (u.type <= 2) = (d.source = 'staff')""",
    "active_lesson_activities": f"""
SELECT {_ATTEMPT} FROM attempts WHERE lesson_id IS NULL OR lesson_id IN (SELECT lesson_id FROM offered_lessons)""",
    "latest_attempt": f"SELECT {_ATTEMPT} FROM newest_attempts",
    "duplicate_attempts": """
SELECT CASE source WHEN 'staff' THEN 'facilitator_learning_activities' ELSE 'learning_activities' END AS table_name,
  count(*) AS attempts, count(DISTINCT (user_id, lesson_id)) AS pairs,
  count(*) - count(DISTINCT (user_id, lesson_id)) AS duplicates FROM attempts GROUP BY source""",
    "allocation_completion": """
SELECT user_id, lesson_id, score, rating, CAST(NULL AS string) AS data_from, duration, completed FROM main_merged""",
    "lesson_level": "SELECT * FROM main_rows",
    "lesson_level_exploded": "SELECT * FROM main_rows",
    "lesson_level_both_logs": "SELECT * FROM best_rows",
    "lesson_level_latest_attempt": "SELECT * FROM last_rows",
    "lesson_level_full": f"SELECT {_FULL} FROM full_rows",
    "zero_completion_stubs": "SELECT * FROM main_rows WHERE lesson_id IS NULL",
    "zero_completion_users": "SELECT DISTINCT user_id FROM main_totals WHERE total_completed = 0",
    "no_allocation_stubs": f"SELECT {_FULL} FROM full_rows WHERE subject_id IS NULL",
    "no_allocation_users": """
SELECT user_id, user_name, user_type, is_master_trainer, centre_id, project_id, is_ple, batch_id, trade_id FROM profiled_users
WHERE user_id NOT IN (SELECT user_id FROM kept_allocated)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch_id NULLS FIRST, trade_id NULLS FIRST) = 1""",
    "lesson_level_from_store": "SELECT * FROM last_rows",
    "lesson_level_batch_scope": "SELECT * FROM batch_rows",
    "subject_rollup_trade_scope": _subject_level("trade_rows"),
    "user_totals": """
SELECT DISTINCT user_id, total_allocated, total_lessons_allocated, total_assessments_allocated, total_completed,
  total_lessons_completed, total_assessments_completed FROM main_totals""",
    "completion_pct": "SELECT DISTINCT user_id, completion_pct FROM main_totals",
    "subject_completion_counts": """
SELECT DISTINCT user_id, subject_id, subj_total_completed, subj_lessons_completed, subj_assessments_completed FROM main_totals""",
    "subject_rollup": "SELECT * FROM subject_level",
    "subject_rollup_all_types": _subject_level("every_rows"),
    "subject_rollup_untouched": _subject_level("untouched_rows"),
    "run_summary": """
SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (allocation_path = 'ple') AS ple_users,
  count(DISTINCT user_id) FILTER (allocation_path = 'non_ple') AS non_ple_users,
  count(DISTINCT user_id) FILTER (allocation_path = 'staff') AS staff_users,
  count(DISTINCT user_id) FILTER (allocation_path IS NULL) AS no_allocation_users,
  count(DISTINCT subject_id) AS subjects, count(DISTINCT lesson_id) AS lessons, count(*) AS row_count,
  (SELECT round_even(avg(pct) * 10, 0) / 10 FROM (SELECT user_id, max(completion_pct) AS pct FROM full_rows GROUP BY user_id))
    AS mean_completion_pct
FROM full_rows""",
    "user_project_phase": "SELECT * FROM phase_rows",
    "project_phase_combos": "SELECT * FROM phase_json",
    "user_first_row": "SELECT * FROM first_rows",
    "subject_combos": "SELECT * FROM subject_json",
    "json_payload_stats": """
SELECT count(*) AS users, round_even(avg(length(subject_combos)) * 100, 0) / 100 AS avg_length,
  CAST(sum(length(subject_combos)) AS bigint) AS total_length FROM subject_json WHERE subject_combos IS NOT NULL""",
    "first_login": "SELECT * FROM logins",
    "user_json": "SELECT * FROM user_rows",
    "find_users_by_phase": """
SELECT DISTINCT tlo_users_id, user_name, centre_name FROM phase_rows WHERE proj_name = 'Project 7' AND phase = 'Phase 1'""",
    "find_users_by_subject": """
SELECT DISTINCT tlo_users_id, centre_name FROM first_rows JOIN subject_level ON user_id = tlo_users_id
WHERE subject_id = 'Brand#12'""",
    "enforce_schema": "SELECT " + ", ".join(
        f"CAST({name} AS {kind}) AS {name}" for name, (kind, _) in USER_JSON_TARGET.items()) + " FROM user_rows",
    "schema_violations": _LENGTHS,
    "changed_users": "SELECT * FROM changed",
    "changed_users_semi": "SELECT * FROM profiled_users WHERE user_id IN (SELECT user_id FROM changed)",
    "completion_high_water_mark": """
SELECT CASE source WHEN 'staff' THEN 'facilitator_learning_activities' ELSE 'learning_activities' END AS table_name,
  max(completed_at) AS max_completed_at FROM attempts GROUP BY source""",
    "completion_rebuild": "SELECT * FROM stored_completion",
    "completion_upsert": "SELECT * FROM stored_completion",
    "completion_upsert_late": "SELECT * FROM stored_completion",
    "completion_store_default": "SELECT * FROM stored_completion",
    "completion_late_days": "SELECT DISTINCT CAST(completed_at AS date) AS day, source FROM attempts WHERE lesson_id % 100 = 0",
    "incremental_refresh": f"SELECT {_FULL} FROM full_rows",
    "scoped_refresh": f"""
SELECT {_FULL} FROM full_rows WHERE centre_id = {CENTRE.centre_id}
UNION ALL SELECT {_FULL} FROM old_full_rows WHERE centre_id <> {CENTRE.centre_id}""",
    "table_fingerprint": _FINGERPRINTS,
    "changed_tables": _changed("content_sum"),
    "changed_tables_by_count": _changed("row_count"),
    "changed_buckets": """
SELECT table_name, level, node FROM tree_now a FULL JOIN tree_before b USING (table_name, level, node)
WHERE (a.n, a.total) IS DISTINCT FROM (b.n, b.total)""",
    "changed_rows": """
SELECT table_name, row_key, CAST(sum(sign) AS bigint) AS change
FROM (SELECT table_name, row_key, row_text, 1 AS sign FROM numbered_now UNION ALL SELECT table_name, row_key, row_text, -1 FROM numbered_before)
GROUP BY table_name, row_key, row_text HAVING sum(sign) <> 0""",
    "mapping_refresh": f"SELECT {_FULL} FROM full_rows",
}


_QUERIES["find_users_by_phase_variant"] = _QUERIES["find_users_by_phase"]
_QUERIES["find_users_by_subject_variant"] = _QUERIES["find_users_by_subject"]
_QUERIES["phase_records_variant"] = """
SELECT DISTINCT tlo_users_id, prog_name, project_id, proj_name, p_phase_id, phase FROM phase_rows"""
_QUERIES["phase_records_variant"] = f"""
SELECT tlo_users_id, proj_name, phase FROM ({_QUERIES["phase_records_variant"]})
WHERE coalesce(prog_name, proj_name, phase) IS NOT NULL OR coalesce(project_id, p_phase_id) IS NOT NULL"""
_QUERIES["run_summary_kept"] = _QUERIES["run_summary"]
_QUERIES["rejected_values"] = """
SELECT 'updated_at' AS "column", updated_at AS value, 'no date' AS reason, count(*) AS n FROM dump
WHERE updated_at IN ('0000-00-00 00:00:00', '0001-01-01 00:00:00') GROUP BY updated_at
UNION ALL SELECT 'score', score, 'no double', count(*) FROM dump WHERE TRY_CAST(score AS double) IS NULL AND score IS NOT NULL GROUP BY score"""
_QUERIES["allocation_delta"] = _QUERIES["user_subject_map"]


def all_sql() -> dict[str, str]:
    definitions = {**VIEWS, **_LIBRARY}
    return {name: with_clause(body, definitions) + body.strip() for name, body in _QUERIES.items()}
