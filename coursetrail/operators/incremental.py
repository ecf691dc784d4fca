"""Which users changed, and how new attempts enter the stored completion table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.functions.constants import LEARNER_TYPES, STAFF_TYPES
from coursetrail.functions.predicates import is_active
from coursetrail.operators.completion import ATTEMPT, LOGS, completed, completed_since, latest_attempt, on_open_lessons
from coursetrail.session import kept
from coursetrail.sinks.user_table import UserTable
from coursetrail.sources.tables import Tables


def changed_users(tables: Tables, since: Any) -> DataFrame:
    """Users with a finished attempt after ``since`` in either log."""
    moment = F.lit(since).cast("timestamp_ntz")
    newer = [completed(tables, log).filter(F.col("completed_at") > moment).select("user_id") for log in LOGS]
    return newer[0].unionByName(newer[1]).filter(F.col("user_id").isNotNull()).distinct()


def high_water_marks(tables: Tables) -> DataFrame:
    """Latest finish time per log."""
    marks = [completed(tables, log).agg(F.max("completed_at").alias("max_completed_at"))
             .select(F.lit(table).alias("table_name"), "max_completed_at") for log, table in LOGS.items()]
    return marks[0].unionByName(marks[1])


def rebuild(tables: Tables, log: str) -> DataFrame:
    """The completion table from scratch: active users of the log, open lessons, newest attempt."""
    types = LEARNER_TYPES if log == "learner" else STAFF_TYPES
    users = tables.users.filter(is_active(F.col("status"), F.col("deleted_at")) & F.col("type").isin(*types))
    rows = completed(tables, log).join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    return latest_attempt(on_open_lessons(tables, rows))


def upsert(stored: DataFrame, new_attempts: DataFrame) -> DataFrame:
    """Stored rows and new attempts, newest per user and lesson.

    The order of arrival plays no part: an attempt that comes late loses against a newer
    stored one, and one that comes twice changes nothing.
    """
    return latest_attempt(stored.unionByName(new_attempts.select(*stored.columns)))


def refreshed(tables: Tables, log: str, stored: DataFrame, since: Any) -> DataFrame:
    """The stored table after the attempts newer than ``since`` came in."""
    return upsert(stored, on_open_lessons(tables, completed_since(tables, log, since)))


# ---------------------------------------------------------------- the stored completion table

RANGES = 16  # stretches of days that one read names at most; each is compared with every row


def day_sums(tables: Tables, log: str, since: date | None = None) -> DataFrame:
    """Finished attempts of a log per day: how many, and the sum of their hashes. Attempts without a time have the day NULL.

    One scan of partial aggregates; every task hands on a row per day, and the order of rows plays no part.
    """
    rows = completed(tables, log)
    if since is not None:
        rows = rows.filter(F.col("completed_at").isNull() | (F.col("completed_at") >= F.lit(since).cast("timestamp_ntz")))
    number = F.xxhash64(*ATTEMPT, *[F.col(c).isNull() for c in ATTEMPT]).cast("decimal(20,0)")
    return rows.groupBy(F.to_date("completed_at").alias("day")).agg(F.count(F.lit(1)).alias("attempts"), F.sum(number).alias("hash_sum"))


def changed_days(now: DataFrame, before: DataFrame) -> list[date | None]:
    """The days whose number or sum of attempts differ."""
    old = before.select(F.col("day").alias("old_day"), F.col("attempts").alias("old_attempts"), F.col("hash_sum").alias("old_sum"))
    both = now.join(old, F.col("day").eqNullSafe(F.col("old_day")), "left")
    same = F.col("attempts").eqNullSafe(F.col("old_attempts")) & F.col("hash_sum").eqNullSafe(F.col("old_sum"))
    return [row["day"] for row in both.filter(~same).select("day").collect()]


def stretches(days: Iterable[date]) -> list[tuple[date, date]]:
    """(first day, day after the last) of days in a row; above `RANGES` of them, those with the smallest gaps are taken together."""
    found: list[list[date]] = []
    for one in sorted(days):
        if found and found[-1][1] == one:
            found[-1][1] = one + timedelta(days=1)
        else:
            found.append([one, one + timedelta(days=1)])
    gaps = sorted(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1], reverse=True)
    starts = sorted(gaps[:RANGES - 1])
    return [(found[a][0], found[b - 1][1]) for a, b in zip([0, *starts], [*starts, len(found)], strict=True) if found]


def attempts_of(tables: Tables, log: str, days: Iterable[date | None]) -> DataFrame:
    """Finished attempts of some days, of users the log is meant for; stretches that hold these days reach the scan."""
    days = list(days)
    known, moment = [d for d in days if d is not None], F.col("completed_at")
    near = [(moment >= F.lit(a).cast("timestamp_ntz")) & (moment < F.lit(b).cast("timestamp_ntz")) for a, b in stretches(known)]
    missing = [moment.isNull()] if None in days else []
    types = LEARNER_TYPES if log == "learner" else STAFF_TYPES
    meant = tables.users.filter(is_active(F.col("status"), F.col("deleted_at")) & F.col("type").isin(*types))
    rows = completed(tables, log).filter(reduce(or_, near + missing, F.lit(False)))
    # A set of days is one look-up a row, however many they are.
    rows = rows.filter(reduce(or_, missing, F.to_date(moment).isin(known)))
    return on_open_lessons(tables, rows.join(meant.select(F.col("id").alias("user_id")), "user_id", "left_semi"))


def update_store(tables: Tables, log: str, store: UserTable, full: bool = False, overlap: timedelta | None = None) -> None:
    """Bring a stored completion table up to date.

    Beside the table lie the sums of its log's days as they were at the last update (``day_sums``). Only days
    whose sums differ are read again, however long ago they are; an attempt may reach the log as late as it likes. To
    find these days, the log is summed up in one scan. With ``overlap``, only days from that long before the latest
    one on are summed and compared: less is read, and attempts later than that stay out until an update without it.
    A table without sums, or ``full``, is rebuilt. Logs are taken to be appended to: an attempt that leaves the log stays in the table.
    """
    path = store.path + ".days"
    known = store.exists() and not full and store.has(path)
    before = store.spark.read.parquet(path) if known else None
    latest = before.agg(F.max("day")).first()[0] if known and overlap is not None else None
    since = latest - overlap if latest is not None else None
    # Summed before the attempts are read: what comes in between differs from the sums, and is taken by the next update.
    with kept(day_sums(tables, log, since), "day-sums") as now:
        if not known:
            store.overwrite(rebuild(tables, log))
        elif days := changed_days(now, before):
            store.upsert(attempts_of(tables, log, days), latest_attempt)
        if since is not None:
            now = now.unionByName(before.filter(F.col("day") < F.lit(since)))
        # Last, so that a failed update is done again from the old sums.
        with kept(now, "day-sums") as whole:
            whole.coalesce(1).write.mode("overwrite").parquet(path)


def duplicate_attempts(tables: Tables) -> DataFrame:
    """Per log: finished attempts, distinct user and lesson pairs, and the difference."""
    parts = []
    for log, table in LOGS.items():
        pairs = completed(tables, log).groupBy("user_id", "lesson_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(pairs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("attempts"), F.count(F.lit(1)).alias("pairs"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        ).select(F.lit(table).alias("table_name"), "attempts", "pairs", "duplicates"))
    return parts[0].unionByName(parts[1])
