"""What users have completed, and its merge with what they are allocated."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.functions.constants import LEARNER_TYPES, LESSON_CATEGORY, PATHS, STAFF_TYPES
from coursetrail.functions.predicates import is_active, is_active_user, role_sees, round_half_even
from coursetrail.operators import allocation, users
from coursetrail.schema import LESSON, LESSON_LEVEL_FULL_OUTPUT, LESSON_LEVEL_OUTPUT, shaped
from coursetrail.scope import EVERYONE, Scope
from coursetrail.sources.tables import Tables

LOGS = {"learner": "learning_activities", "staff": "facilitator_learning_activities"}
KEYS = ["user_id", "lesson_id"]
ATTEMPT = ["user_id", "lesson_id", "score", "rating", "duration", "completed_at"]


# ---------------------------------------------------------------- activity logs


def completed(tables: Tables, log: str, scope: Scope = EVERYONE) -> DataFrame:
    """Finished attempts of one log; the filter and the columns reach the scan.

    With a scope, attempts of other users go before anything is grouped. A stored completion
    table may stand for a log: it has no flag, because all its attempts are finished.
    """
    rows = tables[LOGS[log]]
    if "completed" in rows.columns:
        rows = rows.filter(F.col("completed") == 1)
    return users.in_hand(rows.select(*ATTEMPT), tables, scope)


def completed_since(tables: Tables, log: str, since: Any) -> DataFrame:
    """Finished attempts newer than a moment, of active users the log is meant for."""
    types = LEARNER_TYPES if log == "learner" else STAFF_TYPES
    meant = tables.users.filter(is_active(F.col("status"), F.col("deleted_at")) & F.col("type").isin(*types))
    newer = completed(tables, log).filter(F.col("completed_at") > F.lit(since).cast("timestamp_ntz"))
    return newer.join(meant.select(F.col("id").alias("user_id")), "user_id", "left_semi")


def newest_first() -> list[Column]:
    """Order of attempts: latest first, then better values, so that no tie is left open."""
    return [F.col(c).desc_nulls_last() for c in ("completed_at", "score", "rating", "duration")]


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """The newest attempt per user and lesson; each task keeps one per key before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*KEYS).orderBy(*newest_first()))
    return attempts.withColumn("rn", rank).filter("rn = 1").drop("rn")


def by_lesson(attempts: DataFrame) -> DataFrame:
    """Best score, best rating and total duration per user and lesson."""
    return attempts.groupBy(*KEYS).agg(
        F.max("score").alias("score"), F.max("rating").alias("rating"), F.sum("duration").alias("duration"))


def lesson_results(tables: Tables, log: str, attempts: str = "all", scope: Scope = EVERYONE) -> DataFrame:
    if attempts not in ("all", "latest"):
        raise ValueError(f"attempts must be 'all' or 'latest', not {attempts!r}")
    rows = completed(tables, log, scope)
    return by_lesson(rows if attempts == "all" else latest_attempt(rows)).withColumn("source", F.lit(log))


def both_logs(tables: Tables, attempts: str = "all", scope: Scope = EVERYONE) -> DataFrame:
    return lesson_results(tables, "learner", attempts, scope).unionByName(lesson_results(tables, "staff", attempts, scope))


def best_across_logs(results: DataFrame) -> DataFrame:
    """One row per user and lesson over both logs: the better score, the learner log on a tie."""
    order = [F.col("score").desc_nulls_last(), F.col("source")]
    rank = F.row_number().over(W.partitionBy(*KEYS).orderBy(*order))
    return results.withColumn("rn", rank).filter("rn = 1").drop("rn")


def results(tables: Tables, routing: str = "by_type", attempts: str = "all", scope: Scope = EVERYONE) -> DataFrame:
    """Lesson results of everybody in the scope.

    ``by_type`` keeps the logs apart (column ``source``), to be matched with the kind of
    user later; ``union`` merges both logs for everyone (``source`` is NULL).
    """
    rows = both_logs(tables, attempts, scope)
    if routing == "by_type":
        return rows
    if routing == "union":
        return best_across_logs(rows).withColumn("source", F.lit(None).cast("string"))
    raise ValueError(f"routing must be 'by_type' or 'union', not {routing!r}")


def _from_own_log(path: Column, source: Column) -> Column:
    """Staff against the staff log, everyone else against the learner log; merged results fit all."""
    return source.isNull() | ((source == "staff") & (path == "staff")) | ((source == "learner") & (path != "staff"))


def routed(tables: Tables, routing: str = "by_type", attempts: str = "all", scope: Scope = EVERYONE) -> DataFrame:
    """Lesson results of active users, each from the log of their user type."""
    kinds = scope.users(tables.users.filter(is_active_user()), user_id="id").select(
        F.col("id").alias("user_id"), F.when(F.col("type").isin(*STAFF_TYPES), "staff").otherwise("learner").alias("kind"))
    rows = results(tables, routing, attempts, scope).join(kinds, "user_id")
    return rows.filter(F.col("source").isNull() | (F.col("source") == F.col("kind"))).select(
        *KEYS, "score", "rating", F.lit(None).cast("string").alias("data_from"), "duration")


def open_lessons(tables: Tables) -> DataFrame:
    """Ids of active lessons whose active subject some centre offers."""
    offered = tables.centre_subject.select("subject_id").distinct()
    subjects = allocation.active_subjects(tables).select("subject_id").join(offered, "subject_id", "left_semi")
    active = tables.lessons.filter(is_active(F.col("status"), F.col("deleted_at")))
    return active.join(subjects, "subject_id", "left_semi").select(F.col("id").alias("lesson_id")).distinct()


def on_open_lessons(tables: Tables, attempts: DataFrame) -> DataFrame:
    """Attempts on open lessons, and those that name no lesson (a NOT IN never removes them)."""
    known = tables.lookup(open_lessons(tables).withColumn("is_open", F.lit(True)), "lessons")
    marked = attempts.join(known, "lesson_id", "left")
    return marked.filter(F.col("is_open") | F.col("lesson_id").isNull()).select(*attempts.columns)


# ---------------------------------------------------------------- merge


def _share(done: Column, allocated: Column) -> Column:
    return F.when(allocated > 0, round_half_even(done / allocated * 100, 2)).otherwise(0.0)


def merge(tables: Tables, scope: Scope = EVERYONE, *, category: Any = LESSON_CATEGORY, all_types: bool = False,
          routing: str = "by_type", attempts: str = "all", keep_unallocated: bool = False,
          include_untouched: bool = False, paths=PATHS) -> DataFrame:
    """Completed lessons with totals, plus one stub per subject of users who completed none.

    Counts come before expansion: a user's allocated totals are sums of lessons per
    subject, so user x lesson rows are built for completed lessons only. The user x
    subject rows and the completed lessons meet once, hashed on ``user_id``, and all
    totals are windows over that one arrangement. What a window holds for a user is
    bounded by the catalogue: one row per subject and one per completed lesson.
    """
    if scope.batch_id is not None or scope.trade_id is not None:
        # Users come first: allocation alone lets staff pass whatever their batch and trade.
        scope = replace(scope, user_ids=users.chosen(tables, scope))
    lesson_rows = allocation.lessons(tables, category, all_types)
    rows = allocation.subject_rows(tables, scope, paths, counts=allocation.subject_counts(lesson_rows),
                                   keep_unallocated=keep_unallocated)
    user = W.partitionBy("user_id")
    total = F.coalesce(F.sum("n_total").over(user), F.lit(0))
    assessments = F.coalesce(F.sum("n_assessments").over(user), F.lit(0))
    rows = rows.select(
        "*", total.alias("total_allocated"), (total - assessments).alias("total_lessons_allocated"),
        assessments.alias("total_assessments_allocated"),
        F.col("n_total").alias("subj_total_allocated"),
        (F.col("n_total") - F.col("n_assessments")).alias("subj_lessons_allocated"),
        F.col("n_assessments").alias("subj_assessments_allocated"))
    if keep_unallocated:
        rows = rows.filter(F.col("subject_id").isNotNull() | (F.col("total_allocated") == 0))

    done = (results(tables, routing, attempts, scope).join(
        tables.lookup(lesson_rows, "lessons", "lesson_types"), "lesson_id")
            .withColumnsRenamed({"user_id": "done_by", "subject_id": "done_subject"}))
    matched = (
        (F.col("user_id") == F.col("done_by")) & (F.col("subject_id") == F.col("done_subject"))
        & role_sees(F.col("role"), *[F.col(c) for c in allocation.ACCESS])
        & _from_own_log(F.col("allocation_path"), F.col("source"))
    )
    merged = rows.join(done, matched, "left")

    subject = W.partitionBy("user_id", "subject_id")
    is_done = F.col("lesson_id").isNotNull()
    merged = merged.select(
        "*", is_done.cast("int").alias("completed"),
        F.count("lesson_id").over(subject).alias("subj_total_completed"),
        F.coalesce(F.sum("is_assessment").over(subject), F.lit(0)).alias("subj_assessments_completed"),
        F.count("lesson_id").over(user).alias("total_completed"),
        F.coalesce(F.sum("is_assessment").over(user), F.lit(0)).alias("total_assessments_completed"))
    keep = is_done | (F.col("total_completed") == 0)
    if include_untouched:
        keep = keep | (F.col("subj_total_completed") == 0)
    merged = merged.filter(keep)

    def of_subject(value: Column) -> Column:
        return F.when(F.col("subject_id").isNotNull(), value)

    merged = allocation.with_basis(merged).withColumns({
        "completion_pct": _share(F.col("total_completed"), F.col("total_allocated")),
        "total_lessons_completed": F.col("total_completed") - F.col("total_assessments_completed"),
        "subj_lessons_completed": of_subject(F.col("subj_total_completed") - F.col("subj_assessments_completed")),
        "subj_total_completed": of_subject(F.col("subj_total_completed")),
        "subj_assessments_completed": of_subject(F.col("subj_assessments_completed")),
        "data_from": F.lit(None).cast("string"),
    })
    if not keep_unallocated:
        return shaped(merged, LESSON_LEVEL_OUTPUT)
    unallocated = F.col("subject_id").isNull()
    # A user whose profile is stored twice gets two stubs, one per stored row.
    copies = F.when(unallocated, F.coalesce("profile_copies", F.lit(1))).otherwise(1)
    merged = merged.withColumns({
        "is_master_trainer": F.when(unallocated, F.col("is_master_trainer")),
        "is_ple": F.when(unallocated, F.col("is_ple")),
    }).select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return shaped(merged, LESSON_LEVEL_FULL_OUTPUT)


def merge_exploded(tables: Tables, scope: Scope = EVERYONE, *, category: Any = LESSON_CATEGORY,
                   all_types: bool = False, routing: str = "by_type", attempts: str = "all") -> DataFrame:
    """The same result by way of every user x lesson row; only to compare with ``merge``."""
    if scope.batch_id is not None or scope.trade_id is not None:
        scope = replace(scope, user_ids=users.chosen(tables, scope))
    rows = allocation.subject_rows(tables, scope)
    slim = rows.select("user_id", "subject_id", "role", "allocation_path")
    known = to_meet(tables, routing, attempts, scope)
    merged = with_completion(allocation.expand(tables, slim, category, all_types, known, ("lesson_id", "is_assessment")), tables)
    # Every user x lesson row is counted where it arises: a user's subject lies in one task, so none of them is shuffled or sorted.
    groups = ["user_id", "subject_id", *[c for c in merged.columns if c == allocation.SLICE]]
    sums = {f"{kind}{graded}": F.sum(value * F.col("is_assessment") if graded else value).alias(f"{kind}{graded}")
            for kind, value in (("allocated", F.lit(1)), ("completed", F.col("completed"))) for graded in ("", "_graded")}
    counts = merged.groupBy(*groups).agg(*sums.values())
    columns = {}
    for kind in ("allocated", "completed"):
        for total, short in (("subj_total", "subj"), ("total", "total")):
            every, graded = F.col(kind), F.col(f"{kind}_graded")
            if total == "total":
                every, graded = (F.sum(c).over(W.partitionBy("user_id")) for c in (every, graded))
            columns |= {f"{total}_{kind}": every, f"{short}_lessons_{kind}": every - graded,
                        f"{short}_assessments_{kind}": graded}
    counts = counts.withColumns(columns).withColumn(
        "completion_pct", _share(F.col("total_completed"), F.col("total_allocated"))).select("user_id", "subject_id", *columns, "completion_pct")

    # Lessons are only found in blocks that a result lies in.
    touched = allocation.expand(tables, slim, category, all_types, known, touched=True)
    found = with_completion(touched, tables, routing, attempts, scope, category).filter("completed = 1").select(
        "user_id", "subject_id", *LESSON, "score", "rating", "data_from", "duration", "completed")
    wide = allocation.with_basis(rows).join(counts, ["user_id", "subject_id"]).join(found, ["user_id", "subject_id"], "left")
    done = F.col("completed").isNotNull()
    return shaped(wide.filter(done | (F.col("total_completed") == 0)).withColumn("completed", done.cast("int")), LESSON_LEVEL_OUTPUT)


def to_meet(tables: Tables, routing: str = "by_type", attempts: str = "all", scope: Scope = EVERYONE) -> DataFrame:
    """Results as ``allocation.expand`` takes them: staff have those of the staff log, everyone else those of the learner log; merged results fit all."""
    rows = results(tables, routing, attempts, scope)
    return rows.withColumn("for_staff", F.col("source") == "staff") if routing == "by_type" else rows


def with_completion(allocated: DataFrame, tables: Tables, routing: str = "by_type", attempts: str = "all",
                    scope: Scope = EVERYONE, category: Any = LESSON_CATEGORY) -> DataFrame:
    """Left join of allocated lessons with their results; ``completed`` is 1 where one exists.

    The results of a task are held in a hash map and the allocated rows, which are far more, pass by it unsorted. They stay
    where ``expand`` made them: by user, or with the column `SLICE` by subject and slice.

    Rows that bring their block's results (column ``allocation.RESULTS``, from ``to_meet``) have met them already; the lesson's own is taken out.
    """
    nothing = F.lit(None).cast("string").alias("data_from")
    if allocation.RESULTS in allocated.columns:
        own = F.col(allocation.RESULTS)[F.col("lesson_id")]
        return allocated.select(
            *[c for c in allocated.columns if c != allocation.RESULTS], own["score"].alias("score"), own["rating"].alias("rating"),
            nothing, own["duration"].alias("duration"), F.when(own.isNotNull(), 1).otherwise(0).alias("completed"))
    done = allocation.beside_allocated(tables, allocated, results(tables, routing, attempts, scope), category)
    by = [c for c in done.columns if c in ("user_id", "lesson_id", "subject_id", allocation.SLICE)]
    done = done.withColumnsRenamed({c: f"done_{c}" for c in by})
    matched = reduce(and_, [F.col(c) == F.col(f"done_{c}") for c in by])
    matched = matched & _from_own_log(F.col("allocation_path"), F.col("source"))
    return allocated.join(done.hint("shuffle_hash"), matched, "left").select(
        *allocated.columns, "score", "rating", nothing, "duration",
        F.when(F.col("done_user_id").isNotNull(), 1).otherwise(0).alias("completed"))
