"""Every operator as a named query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetrail.functions.predicates import assessment_flag, toolkit_type, year_allows
from coursetrail.operators import allocation, combos, completion, deltas, fingerprint, incremental, rollup, users
from coursetrail.plans import outputs
from coursetrail.schema import ALLOCATION_OUTPUT, SOURCE_TYPES, SUBJECT_COMPLETED, shaped
from coursetrail.scope import Scope
from coursetrail.session import configure, durable_dir, stored
from coursetrail.sinks import schema_check
from coursetrail.sinks.snapshot import Change, Snapshots
from coursetrail.sinks.user_table import UserTable
from coursetrail.sources.sanitize import checked, clean_timestamp, rejected, sanitize
from coursetrail.sources.tables import Tables, source_profile

# The test mapping numbers its lesson categories; 1 is the one that counts.
CATEGORY = 1
# Moments and scopes of the incremental and scoped examples.
SINCE = "2001-10-01 00:00:00"
SCOPE = Scope(trade_id="BUILDING")
CENTRE = Scope(centre_id=3)
BATCH = Scope(batch_id=7)

_registered: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    name = function.__name__.removesuffix("_query")
    _registered[name] = function
    return function


_tables: dict[tuple[SparkSession, str], Tables] = {}


def tables_of(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, opened once per session: later queries list no files again."""
    if (spark, folder) not in _tables:
        _tables[spark, folder] = Tables.from_star_schema(spark, folder)
    return _tables[spark, folder]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tables_of(configure(spark), sf_dir))
        return run

    return {name: bind(function) for name, function in _registered.items()}


def as_of(t: Tables, moment: str) -> Tables:
    """The tables as they were at a moment: later attempts are not there yet."""
    return t.with_tables(**{
        name: t[name].filter(F.col("completed_at") <= F.lit(moment).cast("timestamp_ntz"))
        for name in completion.LOGS.values()})


def both(t: Tables, build: Callable[[str], DataFrame]) -> DataFrame:
    """The frames of both logs under each other, tagged."""
    frames = [build(log).withColumn("source", F.lit(log)) for log in completion.LOGS]
    return frames[0].unionByName(frames[1])


def with_logs_stored(t: Tables, build: Callable[[str], DataFrame] | None = None) -> Tables:
    """The tables with both logs, or what ``build`` makes of each, written down whole, for queries that read them again and again.

    The test mapping makes a log out of a join of two large tables, which every read would shuffle anew. Both logs come out of one
    plan, and share that shuffle. A file has rows of one log, so a read of the other skips it.
    """
    rows = stored(both(t, build or (lambda log: t[completion.LOGS[log]])), "logs")
    return t.with_tables(**{
        table: rows.filter(F.col("source") == log).drop("source") for log, table in completion.LOGS.items()})


def raw_text(t: Tables) -> DataFrame:
    """Enrolments as a database dump would hold them: dates and numbers as text, money as decimal."""
    moment = (F.when(F.col("status") == 0, "0000-00-00 00:00:00")
              .when(F.col("deleted_at").isNotNull(), "0001-01-01 00:00:00")
              .otherwise(F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")))
    return t.ple_career_path_user.select(
        "id", moment.alias("updated_at"), F.col("job_type_id").cast("decimal(12,2)").alias("amount"),
        F.when(F.col("job_type_id") == 3, "n/a").otherwise(F.col("job_type_id").cast("string")).alias("score"))


# ---------------------------------------------------------------- sources


@_query
def users_active(t):
    return users.active(t)


@_query
def completion_since(t):
    return both(t, lambda log: completion.completed_since(t, log, SINCE))


@_query
def sanitize_types(t):
    return sanitize(raw_text(t), {"updated_at": "timestamp_ntz", "score": "double"})


@_query
def rejected_values(t):
    rows = checked(raw_text(t), {"updated_at": "timestamp_ntz", "score": "double"})
    return rejected(rows).groupBy("column", "value", "reason").agg(F.count(F.lit(1)).alias("n"))


@_query
def date_cleanup(t):
    raw = raw_text(t)
    return raw.select("id", F.to_date(clean_timestamp(F.col("updated_at"), raw.schema["updated_at"].dataType)).alias("day"))


@_query
def source_profile_query(t):
    return source_profile(t, sorted(SOURCE_TYPES))


@_query
def allocation_for_users(t):
    return allocation.combined(t, Scope(user_ids=incremental.changed_users(t, SINCE)), category=CATEGORY)


@_query
def allocation_scoped(t):
    return allocation.combined(t, SCOPE, category=CATEGORY)


@_query
def users_by_path(t):
    return users.by_path(t)


@_query
def optional_intersection(t):
    rows = allocation.subject_rows(t, paths=("non_ple",), unique=False)
    return rows.select("user_id", "batch_id", "trade_id", "subject_id").distinct()


@_query
def year_to_map_filter(t):
    subjects = allocation.active_subjects(t).select("subject_id", "year_to_map")
    durations = t.trades.select(F.col("id").alias("trade_id"), "duration")
    pairs = t.subject_trade.select("trade_id", "subject_id").distinct()
    rows = pairs.join(subjects, "subject_id").join(durations, "trade_id", "left")
    return rows.filter(year_allows(F.col("year_to_map"), F.col("duration")))


@_query
def lesson_type_filter(t):
    return allocation.lessons(t, CATEGORY, all_types=False).select("lesson_id", "lesson_type")


@_query
def assessment_flag_query(t):
    return t.lessons.select(F.col("id").alias("lesson_id"), F.col("name").alias("lesson_name"),
                            assessment_flag(F.col("is_assessment"), F.col("name")).alias("is_assessment"))


@_query
def toolkit_type_query(t):
    flags = [F.col(c) for c in allocation.ACCESS]
    return t.lessons.select(F.col("id").alias("lesson_id"), toolkit_type(*flags).alias("toolkit_type"))


@_query
def user_labels(t):
    rows = combos.user_project_phase(t)
    return rows.select("tlo_users_id", "project_id", "batch_status", "ple_enabled").distinct()


# ---------------------------------------------------------------- allocation


@_query
def centre_subjects_per_user(t):
    ids = users.by_path(t).select("user_id").join(
        t.users.select(F.col("id").alias("user_id"), "centre_id"), "user_id")
    offered = t.centre_subject.select("centre_id", "subject_id", "subject_order")
    return ids.join(t.lookup(offered, "centre_subject"), "centre_id")


@_query
def latest_career_path(t):
    return allocation.latest_enrolment(t)


@_query
def lesson_dim(t):
    return allocation.lesson_dim(t, CATEGORY)


@_query
def alloc_non_ple(t):
    return allocation.non_ple(t, category=CATEGORY)


@_query
def alloc_ple(t):
    return allocation.ple(t, category=CATEGORY)


@_query
def alloc_staff(t):
    return allocation.staff(t, category=CATEGORY)


@_query
def alloc_combined(t):
    return allocation.combined(t, category=CATEGORY)


@_query
def user_subject_map(t):
    return allocation.subject_map(t)


@_query
def allocation_two_stage(t):
    rows = allocation.expand(t, allocation.subject_map(t), CATEGORY)
    return shaped(rows, ALLOCATION_OUTPUT)


@_query
def allocation_dedup(t):
    paths = (allocation.non_ple, allocation.ple, allocation.staff)
    rows = [path(t, category=CATEGORY, folded=True) for path in paths]
    return allocation.one_per_lesson(rows[0].unionByName(rows[1]).unionByName(rows[2]))


@_query
def allocation_ordered(t):
    rows = allocation.combined(t, category=CATEGORY)
    return rows.select("user_id", "subject_order", "lesson_order", "lesson_id").orderBy(
        "user_id", "subject_order", "lesson_order", "lesson_id")


@_query
def subject_alloc_counts(t):
    lessons = allocation.lessons(t, CATEGORY, all_types=False)
    rows = allocation.subject_rows(t, counts=allocation.subject_counts(lessons))
    return rows.select(
        "user_id", "subject_id", F.col("n_total").alias("subj_total_allocated"),
        (F.col("n_total") - F.col("n_assessments")).alias("subj_lessons_allocated"),
        F.col("n_assessments").alias("subj_assessments_allocated"))


# ---------------------------------------------------------------- completion


@_query
def completion_by_lesson(t):
    return completion.both_logs(t)


@_query
def completion_all_users(t):
    return completion.best_across_logs(completion.both_logs(t))


@_query
def completion_cross_table(t):
    return completion.best_across_logs(completion.both_logs(t, attempts="latest"))


@_query
def completion_routed(t):
    return completion.routed(t)


@_query
def active_lesson_activities(t):
    return both(t, lambda log: completion.on_open_lessons(t, completion.completed(t, log)))


@_query
def latest_attempt(t):
    return both(t, lambda log: completion.latest_attempt(completion.completed(t, log)))


@_query
def duplicate_attempts(t):
    return incremental.duplicate_attempts(t)


@_query
def allocation_completion(t):
    allocated = allocation.combined(t, category=CATEGORY, all_types=False, keep_slice=True, results=completion.to_meet(t),
                                    of_lesson=("lesson_id",))
    rows = completion.with_completion(allocated, t, category=CATEGORY)
    return rows.select("user_id", "lesson_id", "score", "rating", "data_from", "duration", "completed")


@_query
def lesson_level(t):
    return outputs.lesson_level(t, category=CATEGORY)


@_query
def lesson_level_exploded(t):
    return completion.merge_exploded(t, category=CATEGORY)


@_query
def lesson_level_both_logs(t):
    return outputs.lesson_level(t, category=CATEGORY, routing="union")


@_query
def lesson_level_latest_attempt(t):
    return outputs.lesson_level(t, category=CATEGORY, attempts="latest")


@_query
def lesson_level_full(t):
    return outputs.lesson_level_full(t, category=CATEGORY)


@_query
def zero_completion_stubs(t):
    return outputs.lesson_level(t, category=CATEGORY).filter(F.col("lesson_id").isNull())


@_query
def zero_completion_users(t):
    rows = outputs.lesson_level(t, category=CATEGORY)
    return rows.filter(F.col("lesson_id").isNull()).select("user_id").distinct()


@_query
def no_allocation_stubs(t):
    return outputs.lesson_level_full(t, category=CATEGORY).filter(F.col("subject_id").isNull())


@_query
def no_allocation_users(t):
    return outputs.no_allocation_users(outputs.lesson_level_full(t, category=CATEGORY))


@_query
def lesson_level_from_store(t):
    """From completion tables that are stored, so that no task sorts attempts and sums up their results at once."""
    return outputs.lesson_level(with_logs_stored(t, lambda log: incremental.rebuild(t, log)), category=CATEGORY)


@_query
def lesson_level_batch_scope(t):
    return outputs.lesson_level(t, BATCH, category=CATEGORY)


@_query
def subject_rollup_trade_scope(t):
    return outputs.subject_level(t, SCOPE, category=CATEGORY)


@_query
def user_totals(t):
    return rollup.user_totals(outputs.lesson_level(t, category=CATEGORY)).drop("completion_pct")


@_query
def completion_pct(t):
    return rollup.user_totals(outputs.lesson_level(t, category=CATEGORY)).select("user_id", "completion_pct")


@_query
def subject_completion_counts(t):
    rows = outputs.lesson_level(t, category=CATEGORY, include_untouched=True)
    return rollup.subject_counts(rows, SUBJECT_COMPLETED)


# ---------------------------------------------------------------- rollups


@_query
def subject_rollup(t):
    return outputs.subject_level(t, category=CATEGORY)


@_query
def subject_rollup_all_types(t):
    return outputs.subject_level(t, category=CATEGORY, all_types=True)


@_query
def subject_rollup_untouched(t):
    return outputs.subject_level(t, category=CATEGORY, include_untouched=True)


@_query
def run_summary(t):
    return rollup.run_summary(outputs.lesson_level_full(t, category=CATEGORY))


@_query
def user_project_phase(t):
    return combos.user_project_phase(t)


@_query
def project_phase_combos(t):
    return combos.project_phase(combos.user_project_phase(t)).select("tlo_users_id", "project_phase_combos")


@_query
def user_first_row(t):
    return combos.project_phase(combos.user_project_phase(t)).drop("project_phase_combos")


@_query
def subject_combos(t):
    return combos.subject(outputs.subject_level(t, category=CATEGORY))


@_query
def json_payload_stats(t):
    return combos.payload_stats(combos.subject(outputs.subject_level(t, category=CATEGORY)))


@_query
def first_login(t):
    return combos.first_login(t)


@_query
def user_json(t):
    return outputs.user_json(t, category=CATEGORY)


@_query
def find_users_by_phase(t):
    rows = combos.project_phase(combos.user_project_phase(t))
    return combos.find_by_phase(rows, "Project 7", "Phase 1").select("tlo_users_id", "user_name", "centre_name")


@_query
def find_users_by_subject(t):
    rows = outputs.user_json(t, category=CATEGORY)
    return combos.find_by_subject(rows, "Brand#12").select("tlo_users_id", "centre_name")


@_query
def find_users_by_phase_variant(t):
    rows = combos.as_variant(combos.project_phase(combos.user_project_phase(t)), "project_phase_combos", combos.PHASE_RECORDS)
    return combos.find_in_variant(rows, "project_phase_combos", pn="Project 7", ph="Phase 1").select("tlo_users_id", "user_name", "centre_name")


@_query
def find_users_by_subject_variant(t):
    rows = combos.as_variant(outputs.user_json(t, category=CATEGORY), "subject_combos", combos.SUBJECT_RECORDS)
    return combos.find_in_variant(rows, "subject_combos", i="Brand#12").select("tlo_users_id", "centre_name")


@_query
def phase_records_variant(t):
    rows = combos.as_variant(combos.project_phase(combos.user_project_phase(t)), "project_phase_combos", combos.PHASE_RECORDS)
    found = combos.records_of(rows, "project_phase_combos").filter("record IS NOT NULL")
    return found.select("tlo_users_id", F.try_variant_get("record", "$.pn", "string").alias("proj_name"), F.try_variant_get("record", "$.ph", "string").alias("phase"))


@_query
def enforce_schema(t):
    return schema_check.enforce(outputs.user_json(t, category=CATEGORY))


@_query
def schema_violations(t):
    return schema_check.too_long(outputs.user_json(t, category=CATEGORY))


# ---------------------------------------------------------------- incremental


@_query
def changed_users(t):
    return incremental.changed_users(t, SINCE)


@_query
def changed_users_semi(t):
    return users.restrict(users.active(t), incremental.changed_users(t, SINCE))


@_query
def completion_high_water_mark(t):
    return incremental.high_water_marks(t)


@_query
def completion_rebuild(t):
    return both(t, lambda log: incremental.rebuild(t, log))


@_query
def completion_upsert(t):
    before = as_of(t, SINCE)
    return both(t, lambda log: incremental.refreshed(t, log, incremental.rebuild(before, log), SINCE))


@_query
def completion_upsert_late(t):
    """Some attempts reach the log late: those of even lessons were not there when the table was built."""
    before = t.with_tables(**{table: t[table].filter(F.col("lesson_id") % 2 == 1) for table in completion.LOGS.values()})
    return both(t, lambda log: incremental.upsert(incremental.rebuild(before, log), _meant(t, log)))


def _meant(t: Tables, log: str) -> DataFrame:
    return incremental.attempts_of(t, log, [r["day"] for r in incremental.day_sums(t, log).select("day").collect()])


@_query
def completion_store_default(t):
    """A stored table, updated by default when attempts of some days came in, years late some of them."""
    t = with_logs_stored(t)
    late = (F.dayofmonth("completed_at") <= 3) & (F.col("lesson_id") % 2 == 0)
    before = t.with_tables(**{table: t[table].filter(~F.coalesce(late, F.lit(False))) for table in completion.LOGS.values()})

    def updated(log: str) -> DataFrame:
        store = UserTable(t.spark, durable_dir(t.spark, f"completion-{log}"), buckets=8)
        incremental.update_store(before, log, store)
        incremental.update_store(t, log, store)
        return store.read()

    return both(t, updated)


@_query
def completion_late_days(t):
    """The days an update reads again after attempts came late, per log."""
    t = with_logs_stored(t)

    def changed(log: str) -> DataFrame:
        now = incremental.day_sums(t, log)
        before = incremental.day_sums(t.with_tables(**{table: t[table].filter(F.col("lesson_id") % 100 != 0) for table in completion.LOGS.values()}), log)
        days = incremental.changed_days(now, before)
        return t.spark.createDataFrame([(d,) for d in days], "day date")

    return both(t, changed)


@_query
def incremental_refresh(t):
    old = outputs.lesson_level_full(as_of(t, SINCE), category=CATEGORY)
    ids = outputs.affected_users(t, Scope(), SINCE)
    new = outputs.lesson_level_full(t, Scope(user_ids=ids), category=CATEGORY)
    return outputs.merged_after(old, new, ids)


@_query
def scoped_refresh(t):
    old = outputs.lesson_level_full(as_of(t, SINCE), category=CATEGORY)
    ids = outputs.affected_users(t, CENTRE)
    new = outputs.lesson_level_full(t, CENTRE, category=CATEGORY)
    return outputs.merged_after(old, new, ids)


# ---------------------------------------------------------------- change detection


@_query
def table_fingerprint(t):
    return fingerprint.table_fingerprint(t)


def _earlier(t: Tables) -> DataFrame:
    """Fingerprints of an earlier state: fewer enrolments, and lesson types not yet watched."""
    enrolments = t.ple_career_path_user.filter(F.col("updated_at") <= F.lit("1998-01-01").cast("timestamp_ntz"))
    names = sorted(set(fingerprint.WATCHED) - {"lesson_types"})
    return fingerprint.table_fingerprint(t.with_tables(ple_career_path_user=enrolments), names)


@_query
def changed_tables(t):
    return fingerprint.changed_tables(fingerprint.table_fingerprint(t), _earlier(t))


@_query
def changed_tables_by_count(t):
    return fingerprint.changed_tables(fingerprint.table_fingerprint(t), _earlier(t), strategy="row_count")


def _before_mapping_changes(t: Tables) -> Tables:
    """The tables before rows of one centre, batch, trade and career path came in, a subject went and some users moved."""
    moved = F.when(F.col("id") % 211 == 0, 4).otherwise(F.col("centre_id"))
    return t.with_tables(
        centre_subject=t.centre_subject.filter("centre_id <> 3 OR subject_order > 2"),
        batch_subject=t.batch_subject.filter("batch_id <> 7 OR id % 2 = 0"),
        subject_trade=t.subject_trade.filter("trade_id <> 'MACHINERY' OR id % 3 > 0"),
        subject_ple_career_path=t.subject_ple_career_path.filter("ple_career_path_id <> 2 OR id % 2 = 0"),
        subjects=t.subjects.withColumn("status", F.when(F.col("id") == "Brand#23", 1).otherwise(F.col("status"))),
        users=t.users.withColumn("centre_id", moved.cast(t.users.schema["centre_id"].dataType)))


def _change(t: Tables) -> Change:
    """The states before and after the mapping changes."""
    states = Snapshots(t.spark, durable_dir(t.spark, "states"))
    states.save(before := states.take(_before_mapping_changes(t)))
    return Change(states.take(t), before)


@_query
def changed_buckets(t):
    return _change(t).nodes


@_query
def changed_rows(t):
    """Keys of the rows that came, went or changed, and how many more of each there are now."""
    key = {name: F.col(deltas.key_of(name)).cast("string").alias("row_key") for name in fingerprint.WATCHED}
    rows = [df.select(F.lit(name).alias("table_name"), key[name], "change") for name, df in _change(t).rows().items()]
    return reduce(DataFrame.unionByName, rows)


@_query
def allocation_delta(t):
    """The user-subject map after mapping changes, computed anew for the users concerned only."""
    ids = stored(outputs.users_of_change(t, _change(t)), "concerned-users")
    old = allocation.subject_map(_before_mapping_changes(t))
    return outputs.merged_after(old, allocation.subject_map(t, Scope(user_ids=ids)), ids)


@_query
def mapping_refresh(t):
    """The stored lesson table after a refresh that met new attempts and mapping changes at once."""
    t = with_logs_stored(t)
    path, before = durable_dir(t.spark, "refreshed"), as_of(_before_mapping_changes(t), SINCE)
    target = UserTable(t.spark, f"{path}/lesson", buckets=8)
    for tables, since in ((before, None), (t, SINCE)):
        outputs.refresh(tables, outputs.Targets(lesson=target), since=since, category=CATEGORY, snapshot=f"{path}/states")
    return target.read()


@_query
def run_summary_kept(t):
    """The summary after a full and a partial refresh, from the figures kept beside the table."""
    path = durable_dir(t.spark, "summarised")
    targets = outputs.Targets(lesson=UserTable(t.spark, f"{path}/lesson", buckets=8), summary=f"{path}/summary")
    outputs.refresh(as_of(t, SINCE), targets, category=CATEGORY)
    return outputs.refresh(t, targets, since=SINCE, category=CATEGORY)
