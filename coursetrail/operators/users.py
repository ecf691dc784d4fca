"""Active users with their profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.functions.predicates import allocation_path, is_active_user
from coursetrail.scope import EVERYONE, Scope
from coursetrail.sources.tables import Tables


def active(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """One row per active user and profile row; staff usually have no profile."""
    users = scope.users(tables.users.filter(is_active_user()), user_id="id").select(
        F.col("id").alias("user_id"), F.col("name").alias("user_name"), "email", "mobile",
        F.col("type").alias("user_type"), "is_master_trainer", "centre_id", "project_id", "organisation_id",
        "is_ple", "created_at")
    details = tables.student_details.select(
        "user_id", "batch_id", "trade_id", "educational_qualification_id", "placement_status_id",
        "active_year", "year_of_admission")
    return scope.profile(users.join(details, "user_id", "left"))


def by_path(tables: Tables, scope: Scope = EVERYONE) -> DataFrame:
    """Every active user with the allocation path that applies to them."""
    users = scope.users(tables.users.filter(is_active_user()), user_id="id")
    return users.select(
        F.col("id").alias("user_id"), F.col("type").alias("user_type"), "is_ple",
        allocation_path(F.col("type"), F.col("is_ple")).alias("allocation_path"))


def chosen(tables: Tables, scope: Scope) -> DataFrame:
    """Ids of the active users of a scope, once each."""
    return active(tables, scope).select("user_id").distinct()


def in_hand(df: DataFrame, tables: Tables, scope: Scope, key: str = "user_id") -> DataFrame:
    """Rows of the users a scope names; literal ids reach the scan, other scopes become a semi join below what follows.

    Without any named user all rows stay.
    """
    if not scope.names_users:
        return df
    if scope.user_id is not None:
        df = df.filter(F.col(key) == scope.user_id)
    if scope.user_ids is not None and not isinstance(scope.user_ids, DataFrame):
        df = df.filter(F.col(key).isin(list(scope.user_ids)))
    if isinstance(scope.user_ids, DataFrame) and scope.centre_id is None and scope.batch_id is None and scope.trade_id is None:
        return restrict(df, scope.user_ids, key)
    if isinstance(scope.user_ids, DataFrame) or any(v is not None for v in (scope.centre_id, scope.batch_id, scope.trade_id)):
        return restrict(df, chosen(tables, scope), key)
    return df


def restrict(df: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows of the given users only."""
    return df.join(users.select(F.col("user_id").alias(key)).distinct(), key, "left_semi")


def without(df: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows of all other users."""
    return df.join(users.select(F.col("user_id").alias(key)).distinct(), key, "left_anti")
