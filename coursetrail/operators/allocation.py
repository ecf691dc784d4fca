"""Which subjects and lessons each active user is allocated.

All three paths come out of one plan. Everything that concerns a user is joined before
the centre multiplies the rows, everything that concerns a subject is joined on the
mapping side, and the optional restrictions (batch, trade, career path) are looked up by
keys that are NULL where the path does not use them. A mapping side is broadcast where
its size is proven to be small (``Tables.lookup``); otherwise the join shuffles and hot
keys are split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.functions.constants import ALLOCATION_BASIS, LESSON_CATEGORY, PATHS
from coursetrail.functions.predicates import (
    access_role, allocation_path, assessment_flag, is_active, is_active_user, is_excluded_type, platform_allows,
    role_sees, toolkit_type, year_allows,
)
from coursetrail.operators import users
from coursetrail.schema import ALLOCATION_OUTPUT, ID, LESSON, PATH_ALLOCATION_OUTPUT, SUBJECT_MAP_OUTPUT, shaped
from coursetrail.scope import EVERYONE, Scope
from coursetrail.session import stored
from coursetrail.sources.tables import Tables

ROLES = ("learner", "admin", "facilitator", "master")
ACCESS = ("student_access", "facilitator_access", "mastertrainer_access")


# ---------------------------------------------------------------- dimensions


def active_subjects(tables: Tables) -> DataFrame:
    return tables.subjects.filter(is_active(F.col("status"), F.col("deleted_at"))).select(
        F.col("id").alias("subject_id"), F.col("name").alias("subject_name"),
        F.col("is_ple").alias("subject_is_ple"), "ple_career_path_id", "year_to_map")


def lessons(tables: Tables, category: Any = LESSON_CATEGORY, all_types: bool = True) -> DataFrame:
    """Active lessons of the category; ``all_types=False`` leaves the excluded types out."""
    names = tables.lesson_types.select(F.col("id").alias("lesson_type_id"), F.col("name").alias("lesson_type"))
    access = [F.col(c) for c in ACCESS]
    rows = (
        tables.lessons
        .filter(is_active(F.col("status"), F.col("deleted_at")) & (F.col("lesson_category_id") == category))
        .join(tables.lookup(names, "lesson_types"), "lesson_type_id", "left")
        .select(F.col("id").alias("lesson_id"), "subject_id", F.col("name").alias("lesson_name"), "lesson_order",
                "lesson_type", assessment_flag(F.col("is_assessment"), F.col("name")).alias("is_assessment"),
                toolkit_type(*access).alias("toolkit_type"), *ACCESS)
    )
    return rows if all_types else rows.filter(~is_excluded_type(F.col("lesson_type")))


def lesson_dim(tables: Tables, category: Any = LESSON_CATEGORY) -> DataFrame:
    """Active lessons joined with their active subject."""
    return active_subjects(tables).join(lessons(tables, category), "subject_id")


def subject_counts(lesson_rows: DataFrame) -> DataFrame:
    """Lessons and assessments per subject, one pair of columns per role."""
    counts = []
    for role in ROLES:
        open_to_role = role_sees(F.lit(role), *[F.col(c) for c in ACCESS])
        counts += [F.count(F.when(open_to_role, 1)).alias(f"{role}_total"),
                   F.count(F.when(open_to_role & (F.col("is_assessment") == 1), 1)).alias(f"{role}_assessments")]
    return lesson_rows.groupBy("subject_id").agg(*counts)


def latest_enrolment(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """The newest active career path enrolment of each user in the scope, the larger id on a tie."""
    newest = W.partitionBy("user_id").orderBy(F.col("updated_at").desc_nulls_last(), F.col("id").desc())
    return (
        users.in_hand(tables.ple_career_path_user, tables, scope)
        .filter(is_active(F.col("status"), F.col("deleted_at")))
        .withColumn("rn", F.row_number().over(newest)).filter("rn = 1")
        .select("user_id", F.col("job_type_id").alias("career_path_id"),
                F.col("updated_at").alias("career_path_updated_at"))
    )


def career_path(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """The enrolment that counts: the latest one, if its career path still exists."""
    paths = tables.ple_career_paths.filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("career_path_id"), F.col("name").alias("career_path_name"))
    return latest_enrolment(tables, scope).join(tables.lookup(paths, "ple_career_paths"), "career_path_id")


def _centre_subjects(tables: Tables, scope: Scope, unique: bool, counts: DataFrame | None) -> DataFrame:
    offered = tables.centre_subject.select("centre_id", "subject_id", "subject_order")
    if unique:
        offered = offered.groupBy("centre_id", "subject_id").agg(F.min("subject_order").alias("subject_order"))
    subjects = active_subjects(tables)
    if scope.subject_id is not None:
        subjects = subjects.filter(F.col("subject_id") == scope.subject_id)
    if counts is not None:
        subjects = subjects.join(counts, "subject_id")
    return offered.join(subjects, "subject_id")


# ---------------------------------------------------------------- user x subject


# The columns a user's subjects are looked up by.
PROFILE = ("allocation_path", "role", "centre_id", "batch_key", "trade_key", "career_path_id", "trade_duration")


def _pairs(tables: Tables, name: str, unique: bool, flag: str, **keys: str) -> DataFrame:
    pairs = tables[name].select(*[F.col(source).alias(target) for target, source in keys.items()], "subject_id")
    return tables.lookup((pairs.distinct() if unique else pairs).withColumn(flag, F.lit(True)), name)


def _people(tables: Tables, scope: Scope, paths: Sequence[str], profiles: str) -> DataFrame:
    """Active users with path, profile, career path and trade duration.

    ``profiles``: ``"each"`` keeps every profile row of a learner, ``"distinct"`` counts
    equal ones, ``"everyone"`` does the same and attaches them to staff too.
    """
    people = scope.users(tables.users.filter(is_active_user()), user_id="id").select(
        F.col("id").alias("user_id"), F.col("name").alias("user_name"), F.col("type").alias("user_type"),
        "is_master_trainer", "centre_id", "project_id", "is_ple",
        allocation_path(F.col("type"), F.col("is_ple")).alias("allocation_path"))
    if set(paths) != set(PATHS):
        people = people.filter(F.col("allocation_path").isin(*paths))

    # Staff have their place in the scope whatever their batch and trade; who is in hand goes by the rest of it.
    in_hand = replace(scope, batch_id=None, trade_id=None)
    details = users.in_hand(tables.student_details.select("user_id", "batch_id", "trade_id"), tables, in_hand)
    if profiles == "each":
        details = details.withColumn("profile_copies", F.lit(1))
    else:
        details = details.groupBy("user_id", "batch_id", "trade_id").agg(
            F.count(F.lit(1)).cast("int").alias("profile_copies"))
    matches = F.col("user_id") == F.col("profile_of")
    if profiles != "everyone":
        matches = matches & (F.col("allocation_path") != "staff")
    people = people.join(details.withColumnRenamed("user_id", "profile_of"), matches, "left").drop("profile_of")

    enrolled = career_path(tables, in_hand).withColumnRenamed("user_id", "enrolled_user")
    people = people.join(
        enrolled, (F.col("user_id") == F.col("enrolled_user")) & (F.col("allocation_path") == "ple"), "left",
    ).drop("enrolled_user")
    durations = tables.trades.select(F.col("id").alias("trade_id"), F.col("duration").alias("trade_duration"))
    staff = F.col("allocation_path") == "staff"
    # What a path does not look at is NULL in its key.
    return people.join(tables.lookup(durations, "trades"), "trade_id", "left").withColumns({
        "role": access_role(F.col("user_type"), F.col("is_master_trainer")),
        "batch_key": F.when(~staff, F.col("batch_id")),
        "trade_key": F.when(F.col("allocation_path") == "non_ple", F.col("trade_id")),
        "trade_duration": F.when(~staff, F.col("trade_duration")),
    })


def _with_subjects(tables: Tables, profiles: DataFrame, scope: Scope, unique: bool, counts: DataFrame | None,
                   keep_unallocated: bool) -> DataFrame:
    """Joins the subjects that the PROFILE columns of each row allow."""
    offered = _centre_subjects(tables, scope, unique, counts)
    if keep_unallocated:
        marks = tables.centre_subject.select("centre_id").distinct()
        offered = offered.unionByName(marks, allowMissingColumns=True)
    offered = tables.lookup(offered, "centre_subject", "subjects")
    batch = _pairs(tables, "batch_subject", unique, "in_batch", batch_key="batch_id")
    trade = _pairs(tables, "subject_trade", unique, "in_trade", trade_key="trade_id")
    career = _pairs(tables, "subject_ple_career_path", unique, "on_path", career_path_id="ple_career_path_id")
    rows = (profiles.join(offered, "centre_id", "left" if keep_unallocated else "inner")
            .join(career, ["career_path_id", "subject_id"], "left")
            .join(batch, ["batch_key", "subject_id"], "left")
            .join(trade, ["trade_key", "subject_id"], "left"))

    allowed = (
        platform_allows(F.col("allocation_path"), F.col("subject_is_ple"))
        & ((F.col("allocation_path") != "ple") | F.col("on_path").isNotNull())
        & (F.col("batch_key").isNull() | F.col("in_batch").isNotNull())
        & (F.col("trade_key").isNull() | F.col("in_trade").isNotNull())
        & year_allows(F.col("year_to_map"), F.col("trade_duration"))
    )
    if counts is not None:
        rows = rows.select("*", _for_role("total").alias("n_total"), _for_role("assessments").alias("n_assessments"))
        allowed = allowed & (F.col("n_total") > 0)
    return rows.filter(F.col("subject_id").isNull() | allowed if keep_unallocated else allowed)


def subject_rows(tables: Tables, scope: Scope = EVERYONE, paths: Sequence[str] = PATHS, *,
                 unique: bool = True, counts: DataFrame | None = None,
                 keep_unallocated: bool = False) -> DataFrame:
    """User x subject rows before lessons come in.

    ``unique`` leaves one row per user and subject. ``counts`` (see ``subject_counts``)
    adds ``n_total`` and ``n_assessments`` for the user's role and drops subjects that
    hold nothing for it. ``keep_unallocated`` adds, for every profile row of every user,
    one row whose ``subject_id`` is NULL.

    Subjects are looked up for the distinct profiles, and the users are joined to the outcome:
    with large mapping tables, each of them would else shuffle all user x subject rows.
    """
    profiles = "everyone" if keep_unallocated else "distinct" if unique else "each"
    people = _people(tables, scope, paths, profiles)
    people = scope.profile(people, exempt=None if keep_unallocated else F.col("allocation_path") == "staff")
    outcome = _with_subjects(tables, people.select(*PROFILE).distinct(), scope, unique, counts, keep_unallocated)
    outcome = outcome.withColumnsRenamed({c: f"profile_{c}" for c in PROFILE})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"profile_{c}")) for c in PROFILE])
    rows = people.join(outcome, same)
    unallocated = F.col("subject_id").isNull()

    if unique:
        # The career path is the same on all rows of a user, so the order starts below it.
        # Comparing with the row before keeps all windows on user_id: one exchange.
        # It sorts by user and subject the way a merge join on both does, so that sort is shared.
        order = ["subject_order", "batch_key", "trade_key", "trade_duration"]
        before = W.partitionBy("user_id").orderBy("subject_id", *[F.col(c).asc_nulls_last() for c in order])
        rows = rows.withColumn("subject_before", F.lag("subject_id").over(before))
        first = F.col("subject_before").isNull() | (F.col("subject_before") != F.col("subject_id"))
        rows = rows.filter(first | unallocated if keep_unallocated else first)

    def allocated_only(value: Column) -> Column:
        return F.when(~unallocated, value)

    extra = ["is_ple", "profile_copies"] + (["n_total", "n_assessments"] if counts is not None else [])
    return rows.select(
        "user_id", "user_name", "user_type", "is_master_trainer", "role", "centre_id", "project_id",
        F.when(unallocated, F.col("batch_id")).otherwise(F.col("batch_key")).alias("batch_id"),
        F.when(unallocated, F.col("trade_id")).otherwise(F.col("trade_key")).alias("trade_id"),
        *[allocated_only(F.col(c)).alias(c) for c in ("career_path_id", "career_path_name", "career_path_updated_at")],
        "subject_id", "subject_name", "subject_is_ple", "ple_career_path_id", "year_to_map", "subject_order",
        allocated_only(F.col("trade_duration")).alias("trade_duration"),
        allocated_only(F.col("allocation_path")).alias("allocation_path"), *extra)


def _for_role(what: str) -> Column:
    chosen = F.lit(None).cast("bigint")
    for role in ROLES:
        chosen = F.when(F.col("role") == role, F.col(f"{role}_{what}")).otherwise(chosen)
    return chosen


def with_basis(df: DataFrame) -> DataFrame:
    basis = F.lit(None).cast("string")
    for path, text in ALLOCATION_BASIS.items():
        basis = F.when(F.col("allocation_path") == path, text).otherwise(basis)
    return df.withColumn("allocation_basis", basis)


def subject_map(tables: Tables, scope: Scope = EVERYONE, paths: Sequence[str] = PATHS) -> DataFrame:
    """One row per user and allocated subject, without lessons."""
    rows = with_basis(subject_rows(tables, scope, paths))
    learner = F.col("allocation_path") != "staff"
    rows = rows.withColumn("is_master_trainer", F.when(~learner, F.col("is_master_trainer")))
    return shaped(rows, SUBJECT_MAP_OUTPUT)


# ---------------------------------------------------------------- user x lesson


ROWS_PER_TASK = 1_000_000  # user x lesson rows, so that a task's share of a small executor holds them for a sort
BLOCK = 256  # lessons that lie in one row, about
COPIES = 8  # of the lessons, that a few users may be spread by
SLICE = "slice_of_subject"  # of the users of a subject, where lessons are too many for a broadcast
RESULTS = "results_in_block"  # of the user, by lesson: what is known of the lessons that lie in one row
FOLDED = "lesson_rows"  # the lessons that lie in one row
SHARED = "shared_lessons"  # whether the lessons of a row may come to the user by another row too


def _loads(tables: Tables, category: Any) -> DataFrame:
    """Per subject: its lessons, and the active users of the centres that offer it. Users are counted per centre, and meet one row per centre."""
    sizes = lessons(tables, category).groupBy("subject_id").agg(F.count(F.lit(1)).alias("lessons"))
    people = tables.users.filter(is_active_user()).groupBy("centre_id").agg(F.count(F.lit(1)).alias("people"))
    offers = tables.centre_subject.select("centre_id", "subject_id").distinct().join(people, "centre_id")
    return offers.groupBy("subject_id").agg(F.sum("people").alias("people")).join(sizes, "subject_id")


def _spread(tables: Tables, category: Any) -> int:
    """Tasks for the user x lesson rows: at least the shuffle partitions, and enough for what all profiles are allocated, repeated rows included.

    Asked once of a set of tables.
    """
    def predict() -> int:
        people = _people(tables, EVERYONE, PATHS, "each").groupBy(*PROFILE).agg(F.count(F.lit(1)).alias("people"))
        counts = subject_counts(lessons(tables, category))
        outcome = _with_subjects(tables, people, EVERYONE, False, counts, False)
        return outcome.agg(F.sum(F.col("people") * F.col("n_total"))).first()[0] or 0

    return max(_least(tables), -(-tables.known(f"user x lesson rows of {category}", predict) // ROWS_PER_TASK))


def _least(tables: Tables) -> int:
    return max(int(tables.spark.conf.get("spark.sql.shuffle.partitions")), tables.spark.sparkContext.defaultParallelism)


def _slices(tables: Tables, category: Any) -> tuple[DataFrame, int]:
    """(subject_id, slices), and tasks enough for all slices.

    A slice has the users of a subject that `ROWS_PER_TASK` rows allow, but there are not more slices than make the copies of
    its lessons as many as its users, or `COPIES` of them: what is shuffled grows with both tables and not with their product.
    """
    def find() -> tuple[DataFrame, int]:
        copies = F.least(F.ceil(F.col("people") * F.col("lessons") / ROWS_PER_TASK),
                         F.greatest(F.ceil(F.col("people") / F.col("lessons")), F.lit(COPIES)))
        found = stored(_loads(tables, category).select("subject_id", copies.cast("int").alias("slices")), "slices")
        return found, found.agg(F.sum("slices")).first()[0] or 0

    found, total = tables.known(f"slices of {category}", find)
    return found, max(_least(tables), 2 * total)


def _sliced(tables: Tables, rows: DataFrame, category: Any) -> DataFrame:
    """Rows of users and subjects, dealt over tasks by subject and slice."""
    slices, tasks = _slices(tables, category)
    which = F.pmod(F.xxhash64("user_id"), F.coalesce(F.col("slices"), F.lit(1))).cast("int")
    return rows.join(tables.lookup(slices, "subjects"), "subject_id", "left").withColumn(SLICE, which).drop("slices").repartition(
        tasks, "subject_id", SLICE)


def beside_allocated(tables: Tables, allocated: DataFrame, results: DataFrame, category: Any = LESSON_CATEGORY) -> DataFrame:
    """Rows of (user_id, lesson_id) brought to where ``expand`` has left the rows of the user and the lesson.

    Where that is by subject and slice, they get these two columns; results on lessons that nobody is allocated are left out then.
    """
    if SLICE not in allocated.columns:
        return results
    subject_of = lessons(tables, category).select("lesson_id", "subject_id").filter("subject_id IS NOT NULL").distinct()
    return _sliced(tables, results.join(subject_of, "lesson_id"), category)


def _numbered(tables: Tables, lesson_rows: DataFrame) -> DataFrame:
    """Lessons with the block of their subject they lie in."""
    sizes = lesson_rows.groupBy("subject_id").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("lesson_id", "lesson_order", "lesson_name"), F.col("blocks"))
    return lesson_rows.join(tables.lookup(sizes, "subjects"), "subject_id").withColumn("block", block).drop("blocks")


def _in_blocks(numbered: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """(subject_id, block, role, lesson_rows): what each role may see of a subject, some `BLOCK` lessons a row; lessons that differ in ``keys`` lie apart."""
    roles = F.array_compact(F.array(*[F.when(role_sees(F.lit(role), *[F.col(c) for c in ACCESS]), role) for role in ROLES]))
    return numbered.select("subject_id", "block", *keys, F.explode(roles).alias("role"), F.struct(*columns).alias("lesson")).groupBy(
        "subject_id", "block", *keys, "role").agg(F.collect_list("lesson").alias(FOLDED))


def _with_results(met: DataFrame, results: DataFrame, touched: bool) -> DataFrame:
    """User x block rows with column `RESULTS`, or without it those that have results; both sides lie dealt already, and the
    results of a task are held in a hash map."""
    by = ["user_id", "subject_id", "block", *[c for c in results.columns if c in (SLICE, "for_staff")]]
    maps = results.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        "lesson_id", F.struct("score", "rating", "duration")))).alias(RESULTS)).withColumnsRenamed({c: f"done_{c}" for c in by})
    same = [(F.col("allocation_path") == "staff" if c == "for_staff" else F.col(c)) == F.col(f"done_{c}") for c in by]
    if touched:  # asking for the map itself keeps its plan the same as without ``touched``, so that a query with both shuffles once
        return met.join(maps.hint("shuffle_hash"), reduce(and_, [*same, F.size(RESULTS) > 0]), "left_semi")
    return met.join(maps.hint("shuffle_hash"), reduce(and_, same), "left")


def expand(tables: Tables, subjects_of_users: DataFrame, category: Any = LESSON_CATEGORY,
           all_types: bool = True, results: DataFrame | None = None, of_lesson: Sequence[str] = tuple(LESSON),
           touched: bool = False, folded: bool = False) -> DataFrame:
    """Multiply user x subject rows by the lessons the user's role may see.

    The lessons of a subject and role lie in arrays, so a user's subject meets some rows and not thousands, and its lessons
    are read one after the other.

    A few bytes of user x subject rows become many of lessons, so parts sized by their bytes would be far too few.
    Small lessons are broadcast, and the rows are spread by user first, over as many tasks as the predicted number of rows
    needs: all of a user stays in one task, at most as many rows as there are lessons. Other lessons are
    dealt by subject, with the users of a subject in slices (column `SLICE`).

    ``results`` (user_id, lesson_id, score, rating, duration, and ``for_staff`` where staff have their own; one row of each user,
    lesson and ``for_staff``) meet the users before their lessons are multiplied, one row of a block and not one of a lesson. They
    come out as column `RESULTS`, a map by lesson_id. With ``touched`` they only choose: blocks that no result lies in go before
    they are multiplied. ``of_lesson`` are the columns of a lesson that are wanted: Spark cannot tell
    which fields of an array are read later, and they are copied to every slice.

    ``folded`` leaves the lessons in their arrays (column `FOLDED`), a row for each user and block. Lessons whose id stands on
    several rows of the catalogue lie in rows of their own then, marked by `SHARED`.
    """
    rows, lesson_rows = subjects_of_users, lessons(tables, category, all_types)
    if "role" not in rows.columns:
        rows = rows.withColumn("role", access_role(F.col("user_type"), F.col("is_master_trainer")))
    numbered, keys = _numbered(tables, lesson_rows), []
    if folded:
        numbered, keys = numbered.withColumn(SHARED, F.count(F.lit(1)).over(W.partitionBy("lesson_id")) > 1), [SHARED]
    blocks = _in_blocks(numbered, of_lesson, *keys)
    kept = list(rows.columns)
    lesson_columns = ["block", *keys, FOLDED] if folded else [F.inline(FOLDED)]
    if results is not None:
        kept += [] if touched else [RESULTS]
        results = results.join(numbered.select("lesson_id", "subject_id", "block").distinct(), "lesson_id")
    if tables.is_small("lessons", "lesson_types"):
        tasks = _spread(tables, category)
        met = rows.repartition(tasks, "user_id").join(F.broadcast(blocks), ["subject_id", "role"])
        if results is not None:
            met = _with_results(met, results.repartition(tasks, "user_id"), touched)
        # Users with the same lessons follow each other in what is written.
        met = met if folded else met.sortWithinPartitions("subject_id", "block", "role")
        return met.select(*kept, *lesson_columns)
    slices, tasks = _slices(tables, category)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)).alias(SLICE)
    blocks = blocks.join(tables.lookup(slices, "subjects"), "subject_id", "left").select(
        "subject_id", "block", *keys, "role", FOLDED, copies)
    # The users of a slice pass by block after block, so the same lessons follow each other in what is written.
    met = blocks.repartition(tasks, "subject_id", SLICE).join(
        _sliced(tables, rows, category).hint("merge"), ["subject_id", SLICE, "role"])
    if results is not None:
        met = _with_results(met, _sliced(tables, results, category), touched)
    return met.select(*kept, SLICE, *lesson_columns)


def _path(tables: Tables, scope: Scope, path: str, category: Any, folded: bool) -> DataFrame:
    rows = with_basis(subject_rows(tables, scope, (path,), unique=False))
    if not folded:
        return shaped(expand(tables, rows, category), PATH_ALLOCATION_OUTPUT)
    several = _of_several_roles(tables).withColumnRenamed("user_id", "user_of_roles")
    rows = rows.join(several, F.col("user_id").eqNullSafe(F.col("user_of_roles")), "left").drop("user_of_roles")
    met = expand(tables, rows, category, folded=True).withColumn(SHARED, F.col(SHARED) | F.coalesce("several_roles", F.lit(False)))
    # Where `expand` dealt by slice, rows of one user and subject are in one slice.
    met = met.withColumn(SLICE, F.col(SLICE) if SLICE in met.columns else F.lit(0))
    kinds = {c: kind for c, kind in PATH_ALLOCATION_OUTPUT.items() if c not in LESSON}
    return shaped(met, {**kinds, **dict.fromkeys(("role", SLICE, "block", SHARED, FOLDED), ID)})


def _of_several_roles(tables: Tables) -> DataFrame:
    """Ids that stand for several active users of different roles."""
    role = access_role(F.col("type"), F.col("is_master_trainer"))
    roles = tables.users.filter(is_active_user()).groupBy(F.col("id").alias("user_id")).agg(
        F.min(role).alias("least"), F.max(role).alias("most"))
    return roles.filter("least <> most").select("user_id", F.lit(True).alias("several_roles"))


def non_ple(tables: Tables, scope: Scope = EVERYONE, category: Any = LESSON_CATEGORY, folded: bool = False) -> DataFrame:
    """Learners without a career path: centre, and batch and trade where they have one."""
    return _path(tables, scope, "non_ple", category, folded)


def ple(tables: Tables, scope: Scope = EVERYONE, category: Any = LESSON_CATEGORY, folded: bool = False) -> DataFrame:
    """Career path learners: centre and career path, and batch where they have one."""
    return _path(tables, scope, "ple", category, folded)


def staff(tables: Tables, scope: Scope = EVERYONE, category: Any = LESSON_CATEGORY, folded: bool = False) -> DataFrame:
    """Staff: everything of the centre that their role may see."""
    return _path(tables, scope, "staff", category, folded)


def combined(tables: Tables, scope: Scope = EVERYONE, paths: Sequence[str] = PATHS,
             category: Any = LESSON_CATEGORY, all_types: bool = True, keep_slice: bool = False,
             results: DataFrame | None = None, of_lesson: Sequence[str] = tuple(LESSON)) -> DataFrame:
    """One row per user and lesson over the chosen paths.

    A lesson has one subject, so one row per user and subject before the expansion
    leaves one row per user and lesson after it. ``keep_slice`` keeps the column `SLICE`, where ``expand`` gave one.
    With ``results`` the column `RESULTS` comes with the rows; columns of a lesson that are not in ``of_lesson`` are NULL.
    """
    rows = expand(tables, with_basis(subject_rows(tables, scope, paths)), category, all_types, results, of_lesson)
    kept = {c: kind for c, kind in ((SLICE, "int"), (RESULTS, ID)) if c in rows.columns and (c != SLICE or keep_slice)}
    return shaped(rows, {**ALLOCATION_OUTPUT, **kept})


def one_per_lesson(path_rows: DataFrame) -> DataFrame:
    """Keyed dedup of raw path rows: the newest career path wins, then the lowest order.

    ``folded`` path rows hold blocks of lessons, and rows with the same block are compared as a whole: lesson by lesson they
    differ in nothing but what the block's row holds. Only lessons that other rows may hold too are then compared one by one.
    """
    newest = F.col("career_path_updated_at").desc_nulls_last()
    lowest = [F.col(c).asc_nulls_last() for c in ("subject_order", "batch_id", "trade_id", "trade_duration")]
    per_lesson = F.row_number().over(W.partitionBy("user_id", "lesson_id").orderBy(
        newest, F.col("lesson_order").asc_nulls_last(), *lowest))
    if FOLDED not in path_rows.columns:
        return shaped(path_rows.withColumn("rn", per_lesson).filter("rn = 1"), ALLOCATION_OUTPUT)
    per_block = F.row_number().over(W.partitionBy("subject_id", SLICE, "block", "role", "user_id").orderBy(newest, *lowest))
    lesson_columns = [c for c in path_rows.columns if c != FOLDED]
    own = path_rows.filter(~F.col(SHARED)).withColumn("rn", per_block).filter("rn = 1").select(*lesson_columns, F.inline(FOLDED))
    shared = path_rows.filter(SHARED).select(*lesson_columns, F.inline(FOLDED)).withColumn("rn", per_lesson).filter("rn = 1")
    return shaped(own, ALLOCATION_OUTPUT).unionByName(shaped(shared, ALLOCATION_OUTPUT))
