"""Subject-level table and run summary, from lesson-level rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.functions.predicates import round_half_even
from coursetrail.schema import SUBJECT_LEVEL_OUTPUT, USER_TOTALS, shaped


def subject_level(lesson_rows: DataFrame) -> DataFrame:
    """One row per user and subject: identity and totals as they are, averages of results.

    Everything but the results is the same on all rows of a user and subject.
    """
    rows = lesson_rows.filter(F.col("subject_id").isNotNull())
    computed = ("avg_score", "avg_rating", "avg_duration", "total_duration", "user_id", "subject_id")
    same = [c for c in SUBJECT_LEVEL_OUTPUT if c not in computed]
    # What is the same on all rows of a key is part of it: so the rows are hashed, and never sorted for it.
    result = rows.groupBy("user_id", "subject_id", *same).agg(
        round_half_even(F.avg("score"), 2).alias("avg_score"),
        round_half_even(F.avg("rating"), 2).alias("avg_rating"),
        round_half_even(F.avg("duration"), 2).alias("avg_duration"),
        F.coalesce(F.sum("duration"), F.lit(0)).alias("total_duration"))
    return shaped(result, SUBJECT_LEVEL_OUTPUT)


def user_totals(lesson_rows: DataFrame) -> DataFrame:
    """Allocated and completed totals and the percentage, one row per user."""
    return lesson_rows.groupBy("user_id").agg(*[F.max(c).alias(c) for c in [*USER_TOTALS, "completion_pct"]])


def subject_counts(lesson_rows: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen per-subject counts, one row per user and subject."""
    rows = lesson_rows.filter(F.col("subject_id").isNotNull())
    return rows.groupBy("user_id", "subject_id").agg(*[F.max(c).alias(c) for c in columns])


def run_summary(lesson_rows: DataFrame) -> DataFrame:
    """One row: users in total and per path, distinct subjects and lessons, rows, mean percentage.

    Users, subjects and lessons are counted in one pass: each is a group of its own that
    shrinks in the tasks before the shuffle, and no set of distinct values is ever held.
    The percentage and the path are the same on all rows of a user.
    """
    kinds = {"user": "user_id", "subject": "subject_id", "lesson": "lesson_id"}
    things = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"))
                       for kind, c in kinds.items()])
    groups = (
        lesson_rows.select(F.explode(things).alias("thing"), "allocation_path", "completion_pct")
        .filter(F.col("thing.value").isNotNull())
        .groupBy(F.col("thing.kind").alias("kind"), F.col("thing.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max("allocation_path").alias("path"), F.max("completion_pct").alias("pct")))
    user = F.col("kind") == "user"

    def number(condition, name: str):
        return F.count(F.when(condition, 1)).alias(name)

    return groups.agg(
        number(user, "users"), number(user & (F.col("path") == "ple"), "ple_users"),
        number(user & (F.col("path") == "non_ple"), "non_ple_users"),
        number(user & (F.col("path") == "staff"), "staff_users"),
        number(user & F.col("path").isNull(), "no_allocation_users"),
        number(F.col("kind") == "subject", "subjects"), number(F.col("kind") == "lesson", "lessons"),
        F.coalesce(F.sum(F.when(user, F.col("rows"))), F.lit(0)).alias("row_count"),
        round_half_even(F.avg(F.when(user, F.col("pct"))), 1).alias("mean_completion_pct"))


# ---------------------------------------------------------------- a summary that is kept

CONTRIBUTION = "kind string, value string, n bigint, total decimal(38,2)"


def contributions(lesson_rows: DataFrame) -> DataFrame:
    """What rows add to a run summary, as numbers that can be taken out again: (kind, value, n, total).

    Kind ``path`` counts users, and adds up their rows (kind ``rows``) and percentages, which have two places; ``subject`` and
    ``lesson`` count rows by id, so that an id is known to be gone when its last row is.
    """
    text = lambda c: F.col(c).cast("string")
    zero = F.lit(0).cast("decimal(38,2)")
    users = lesson_rows.groupBy("user_id").agg(F.max("allocation_path").alias("path"), F.max("completion_pct").alias("pct"), F.count(F.lit(1)).alias("rows"))
    paths = users.groupBy(F.coalesce("path", F.lit("")).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("pct").cast("decimal(20,2)")), F.lit(0)).cast("decimal(38,2)").alias("total"),
        F.count("pct").alias("known"), F.sum("rows").alias("rows"))
    def entry(kind: str, value, n, total):
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), n.alias("n"), total.alias("total"))

    measures = F.array(entry("path", F.col("value"), F.col("n"), F.col("total")), entry("known", F.lit(""), F.col("known"), zero),
                       entry("rows", F.lit(""), F.col("rows"), zero))
    ids = F.array(*[F.struct(F.lit(kind).alias("kind"), text(f"{kind}_id").alias("value")) for kind in ("subject", "lesson")])
    things = (lesson_rows.select(F.explode(ids).alias("thing")).filter("thing.value IS NOT NULL").groupBy("thing.kind", "thing.value")
              .agg(F.count(F.lit(1)).alias("n")).withColumn("total", zero))
    return added([paths.select(F.explode(measures).alias("m")).select("m.*"), things])


def added(parts: list[DataFrame], sign: Sequence[int] = ()) -> DataFrame:
    """Contributions added up, those with the sign -1 taken out; what adds up to nothing goes."""
    signs = [*sign, *[1] * (len(parts) - len(sign))]
    every = reduce(DataFrame.unionByName, [df.select("kind", "value", (F.col("n") * s).alias("n"), (F.col("total") * s).cast("decimal(38,2)").alias("total"))
                                           for df, s in zip(parts, signs, strict=True)])
    return (every.groupBy("kind", "value").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"))
            .filter("n <> 0 OR total <> 0"))


def summary_of(contributed: DataFrame) -> DataFrame:
    """The run summary from contributions: a row for each path, subject and lesson is read, no user's."""
    def count(condition, name: str):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    path, kind = F.col("kind") == "path", F.col("kind")
    mean = F.sum(F.when(path, F.col("total"))).cast("double") / F.sum(F.when(kind == "known", F.col("n")))
    return contributed.agg(
        count(path, "users"), *[count(path & (F.col("value") == p), f"{p}_users") for p in ("ple", "non_ple", "staff")],
        count(path & (F.col("value") == ""), "no_allocation_users"), F.count(F.when(kind == "subject", 1)).alias("subjects"),
        F.count(F.when(kind == "lesson", 1)).alias("lessons"), count(kind == "rows", "row_count"),
        round_half_even(mean, 1).alias("mean_completion_pct"))
