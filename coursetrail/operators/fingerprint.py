"""Has anything an allocation depends on changed since the last snapshot?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetrail.session import folder
from coursetrail.sources.tables import Tables

# Fixed values, names of the source: every column that the allocation joins, filters or outputs.
WATCHED: dict[str, list[str]] = {
    "batch_subject": ["id", "batch_id", "subject_id"],
    "centre_subject": ["id", "centre_id", "subject_id", "subject_order"],
    "lesson_types": ["id", "name"],
    "lessons": ["id", "name", "subject_id", "lesson_order", "lesson_type_id", "lesson_category_id", "is_assessment",
                "student_access", "facilitator_access", "mastertrainer_access", "status", "deleted_at"],
    "ple_career_path_user": ["id", "user_id", "job_type_id", "status", "updated_at", "deleted_at"],
    "ple_career_paths": ["id", "name", "deleted_at"],
    "student_details": ["user_id", "batch_id", "trade_id"],
    "subject_ple_career_path": ["id", "ple_career_path_id", "subject_id"],
    "subject_trade": ["id", "subject_id", "trade_id"],
    "subjects": ["id", "name", "is_ple", "ple_career_path_id", "year_to_map", "status", "deleted_at"],
    "trades": ["id", "duration"],
    "users": ["id", "name", "type", "is_master_trainer", "centre_id", "project_id", "is_ple", "status", "deleted_at"],
}


def row_number_of(columns: list[str]) -> Column:
    """A row's hash as a number, to be added up."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")


def table_fingerprint(tables: Tables, names: list[str] | None = None) -> DataFrame:
    """Row count and order-free content sum per table.

    Each row is hashed on its own and the hashes are added up, so the work is one
    partial aggregation per task and the order of rows plays no part.
    """
    parts = []
    for name in names or sorted(WATCHED):
        parts.append(tables[name].agg(
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum(row_number_of(WATCHED[name])), F.lit(0)).cast("string").alias("content_sum"),
        ).select(F.lit(name).alias("table_name"), "row_count", "content_sum"))
    return reduce(DataFrame.unionByName, parts)


def changed_tables(current: DataFrame, snapshot: DataFrame, strategy: str = "hash") -> DataFrame:
    """Every watched table with a flag: changed, or never seen before.

    ``strategy="row_count"`` compares sizes only.
    """
    value = {"hash": "content_sum", "row_count": "row_count"}[strategy]
    before = snapshot.select("table_name", F.col(value).alias("before"))
    return current.join(before, "table_name", "left").select(
        "table_name", F.coalesce(F.col(value) != F.col("before"), F.lit(True)).alias("changed"))


def allocation_changed(tables: Tables, snapshot_path: str, strategy: str = "hash") -> bool:
    """True if any watched table changed, or if there is no snapshot yet."""
    files, target = folder(tables.spark, snapshot_path)
    if not files.exists(target):
        return True
    snapshot = tables.spark.read.parquet(snapshot_path)
    return not changed_tables(table_fingerprint(tables), snapshot, strategy).filter("changed").isEmpty()


def save_snapshot(tables: Tables, snapshot_path: str) -> None:
    taken = table_fingerprint(tables).withColumn("taken_at", F.current_timestamp())
    taken.coalesce(1).write.mode("overwrite").parquet(snapshot_path)
