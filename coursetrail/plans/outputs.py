"""The output tables, and their full, scoped and incremental refresh."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.functions.constants import LESSON_CATEGORY
from coursetrail.operators import combos, completion, deltas, incremental, rollup, users
from coursetrail.scope import EVERYONE, Scope
from coursetrail.session import kept
from coursetrail.sinks.snapshot import Change, Snapshots
from coursetrail.sinks.user_table import UserTable
from coursetrail.sources.tables import Tables

NO_ALLOCATION_COLUMNS = ["user_id", "user_name", "user_type", "is_master_trainer", "centre_id", "project_id",
                         "is_ple", "batch_id", "trade_id"]


def lesson_level(tables: Tables, scope: Scope = EVERYONE, **options: Any) -> DataFrame:
    """Completed lessons with totals, and stubs for users who completed nothing."""
    return completion.merge(tables, scope, **options)


def lesson_level_full(tables: Tables, scope: Scope = EVERYONE, **options: Any) -> DataFrame:
    """The same, and a stub for every active user without any allocation."""
    return completion.merge(tables, scope, keep_unallocated=True, **options)


def subject_level(tables: Tables, scope: Scope = EVERYONE, **options: Any) -> DataFrame:
    """One row per user and subject; ``all_types=True`` counts the excluded lesson types too."""
    return rollup.subject_level(completion.merge(tables, scope, **options))


def no_allocation_users(lesson_rows: DataFrame) -> DataFrame:
    """The users of a full lesson-level table who have no allocation, once each.

    Of a user with several profiles, that with the smallest batch, then trade counts; a missing one is the smallest.
    """
    others = [c for c in NO_ALLOCATION_COLUMNS if c != "user_id"]
    first = F.min(F.struct("batch_id", "trade_id", *[c for c in others if c not in ("batch_id", "trade_id")])).alias("first")
    rows = lesson_rows.filter(F.col("subject_id").isNull()).groupBy("user_id").agg(first)
    return rows.select("user_id", *[F.col(f"first.{c}").alias(c) for c in others])


def user_json(tables: Tables, scope: Scope = EVERYONE, subject_rows: DataFrame | None = None,
              **options: Any) -> DataFrame:
    """One row per user with JSON columns, from a stored or a freshly computed subject table."""
    rows = subject_level(tables, scope, **options) if subject_rows is None else subject_rows
    return combos.user_json(tables, rows, scope)


@dataclass(frozen=True)
class Targets:
    """Where the outputs are stored; a missing one is not written."""

    lesson: UserTable | None = None
    subject: UserTable | None = None
    subject_all_types: UserTable | None = None
    json: UserTable | None = None  # its key is tlo_users_id
    summary: str | None = None  # folder of the figures that a partial refresh keeps the summary of the lesson table by


def affected_users(tables: Tables, scope: Scope, since: Any = None) -> DataFrame:
    """Ids of the active users a refresh is about."""
    ids = users.active(tables, scope).select("user_id").distinct()
    if since is not None:
        ids = users.restrict(ids, incremental.changed_users(tables, since))
    return ids


def refresh(tables: Tables, targets: Targets, scope: Scope = EVERYONE, since: Any = None, *,
            category: Any = LESSON_CATEGORY, dry_run: bool = False, routing: str = "by_type",
            attempts: str = "all", snapshot: str | None = None) -> DataFrame:
    """Recompute the outputs and return the run summary: of the users recomputed, or with ``targets.summary`` of the whole lesson table.

    Without scope and ``since`` the tables are replaced. With either, only the affected
    users are recomputed and only their rows are exchanged; all other rows stay.
    ``snapshot`` is the place of states of the tables that allocation rests on (see ``sinks.snapshot``): users
    whom changes of these tables since the last refresh concern are recomputed too. Without a state yet, everybody is.
    A refresh that fails, or meets a change while it runs, leaves that change to the next one.
    """
    if scope.subject_id is not None:
        raise ValueError("totals of one subject must not replace totals of all subjects")
    options = {"category": category, "routing": routing, "attempts": attempts}
    states = before = state = None
    if snapshot is not None:
        states = Snapshots(tables.spark, snapshot)
        before, state = states.latest(), states.take(tables)
        if before is None:
            scope, since = EVERYONE, None
    if since is None and not scope.names_users:
        summary = _written(tables, targets, scope, None, options, dry_run)
    else:
        ids = affected_users(tables, scope, since)
        if state is not None:
            ids = ids.unionByName(users_of_change(tables, Change(state, before)))
        with kept(ids.distinct(), "affected-users") as ids:
            summary = _written(tables, targets, replace(EVERYONE, user_ids=ids), ids, options, dry_run)
    if state is not None and not dry_run:
        states.save(state)
    return summary


def users_of_change(tables: Tables, change: Change) -> DataFrame:
    """Ids of the users whom the changes between two states concern."""
    return deltas.concerned_users(tables, {name: change.before.rows(name) for name in ("centre_subject", "lessons")}, change.rows())


def _written(tables: Tables, targets: Targets, scope: Scope, ids: DataFrame | None, options: dict[str, Any], dry_run: bool) -> DataFrame:
    """Write the targets for everyone, or for the users ``ids`` that the scope names; the run summary, computed."""
    rows = lesson_level_full(tables, scope, **options)

    def store(target: UserTable | None, frame: DataFrame) -> None:
        if target is None:
            return
        if ids is None:
            target.overwrite(frame)
        else:
            target.replace_users(frame, ids)

    kept_summary = None
    if not dry_run:
        with _leaving(targets, ids) as leaving:
            store(targets.lesson, rows)
            if targets.lesson is not None:
                # Read back what was written, so that later outputs do not compute it again.
                rows = targets.lesson.read() if ids is None else targets.lesson.read_users(ids)
            if targets.lesson is not None and targets.summary is not None:
                kept_summary = _keep_summary(tables, targets, rows, leaving)
        store(targets.subject, rollup.subject_level(rows))
        if targets.subject_all_types is not None:
            store(targets.subject_all_types, subject_level(tables, scope, all_types=True, **options))
        if targets.json is not None:
            store(targets.json, user_json(tables, scope, subject_rows=rollup.subject_level(rows)))
    summary = rollup.run_summary(rows) if kept_summary is None else kept_summary
    return tables.spark.createDataFrame([summary.first()], summary.schema)


def _leaving(targets: Targets, ids: DataFrame | None) -> AbstractContextManager[DataFrame | None]:
    """What the rows that are to be replaced added to the summary, computed before they are."""
    if ids is None or targets.lesson is None or targets.summary is None or not targets.lesson.exists():
        return nullcontext()
    return kept(rollup.contributions(targets.lesson.read_users(ids)), "leaving")


def _keep_summary(tables: Tables, targets: Targets, rows: DataFrame, leaving: DataFrame | None) -> DataFrame:
    """The summary of the whole lesson table after an exchange of rows: those that came are put in, those that left are taken out.

    Without figures of the table as it was, it is read once.
    """
    path = f"{targets.summary}/figures"
    if leaving is None or not targets.lesson.has(f"{path}/_SUCCESS"):
        figures = rollup.contributions(targets.lesson.read())
    else:
        figures = rollup.added([leaving, tables.spark.read.parquet(path), rollup.contributions(rows)], sign=(-1,))
    with kept(figures, "figures") as now:
        now.coalesce(1).write.mode("overwrite").parquet(path)
    return rollup.summary_of(tables.spark.read.parquet(path))


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    """The first few rows, to look at."""
    return rows.limit(n)


def merged_after(old: DataFrame, new: DataFrame, ids: DataFrame) -> DataFrame:
    """The table after the rows of some users were exchanged, as a plan without writing."""
    return users.without(old, ids).unionByName(users.restrict(new, ids).select(*old.columns))


def outputs_of(names: Sequence[str], lesson: UserTable, subject: UserTable,
               subject_all_types: UserTable | None = None, json: UserTable | None = None) -> Targets:
    """Pick targets by name: ``lesson``, ``subject``, ``json``."""
    wanted = {n.strip().lower() for n in names}
    if unknown := wanted - {"lesson", "subject", "json"}:
        raise ValueError(f"no such output: {', '.join(sorted(unknown))}")
    return Targets(lesson if "lesson" in wanted else None, subject if "subject" in wanted else None,
                   subject_all_types if "subject" in wanted else None, json if "json" in wanted else None)
