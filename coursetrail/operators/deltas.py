"""Where a watched table changed, and which users that concerns.

Rows are dealt into buckets by the hash of a key. Counts and hash sums of the buckets are the leaves of a tree, in which a node adds up `FAN`
children. Two trees are compared from the root down: below a node that is the same nothing is looked at. Only rows in changed leaves are
compared one by one, and what was inserted or deleted is joined to the profiles it may concern. A changed row is one
deleted and one inserted.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetrail.operators.fingerprint import WATCHED, row_number_of
from coursetrail.sources.tables import Tables

FAN, DEPTH = 16, 3
LEAVES = FAN ** DEPTH

#: What rows of a watched table are dealt by, where it is not ``id``.
KEYS = {"student_details": "user_id", "ple_career_path_user": "user_id"}


def key_of(name: str) -> str:
    return KEYS.get(name, "id")


def leaf(name: str) -> Column:
    """Number of a row's bucket: three hexadecimal digits of its key's hash."""
    digits = F.substring(F.md5(F.coalesce(F.col(key_of(name)).cast("string"), F.lit(""))), 13, DEPTH)
    return F.conv(digits, 16, 10).cast("int")


def watched(tables: Tables, name: str) -> DataFrame:
    """The watched columns of a table, with the bucket of each row."""
    return tables[name].select(*WATCHED[name], leaf(name).alias("leaf"))


def hash_tree(rows: Mapping[str, DataFrame], levels: int = DEPTH) -> DataFrame:
    """(table_name, level, node, row_count, content_sum) of some tables with buckets; level 0 is the root, others go down to `levels`.

    A scan of partial aggregates per table: no task hands on more rows than there are leaves.
    """
    leaves = [df.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.sum(row_number_of(WATCHED[name])).alias("total"))
              .select(F.lit(name).alias("table_name"), "leaf", "rows", "total") for name, df in rows.items()]
    nodes = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("leaf") / FAN ** (DEPTH - level)).cast("int").alias("node"))
                      for level in range(levels + 1)])
    return (reduce(DataFrame.union, leaves).select("table_name", "rows", "total", F.explode(nodes).alias("at"))
            .groupBy("table_name", "at.level", "at.node")
            .agg(F.sum("rows").alias("row_count"), F.sum("total").cast("string").alias("content_sum")))


def changed_nodes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(table_name, level, node) of the nodes that differ between two trees, from the roots down."""
    place = ["table_name", "level", "node"]
    value = F.struct("row_count", "content_sum")
    found, above = [], None
    for level in range(DEPTH + 1):
        sides = []
        for tree in (now, before):
            side = tree.filter(F.col("level") == level)
            if above is not None:
                parents = above.select("table_name", F.col("node").alias("parent"))
                side = side.withColumn("parent", F.floor(F.col("node") / FAN).cast("int")).join(parents, ["table_name", "parent"], "left_semi")
            sides.append(side)
        new, old = sides[0].select(*place, value.alias("new")), sides[1].select(*place, value.alias("old"))
        above = new.join(old, place, "full").filter(~F.col("new").eqNullSafe(F.col("old"))).select(*place)
        found.append(above)
    return reduce(DataFrame.union, found)


def changed_rows(name: str, now: DataFrame, before: DataFrame, leaves: list[int]) -> DataFrame:
    """Watched columns of the rows in some leaves that are not equally often on both sides, and ``change``: how many more there are now."""
    signed = [df.filter(F.col("leaf").isin(leaves)).select(*WATCHED[name], F.lit(sign).alias("sign")) for df, sign in ((now, 1), (before, -1))]
    return signed[0].unionByName(signed[1]).groupBy(*WATCHED[name]).agg(F.sum("sign").alias("change")).filter("change <> 0")


def concerned_users(tables: Tables, before: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of all users whose allocation the changed rows may concern, active or not.

    ``changes`` are the changed rows of some tables, ``before`` the earlier rows of any that lookups go through
    (``centre_subject``, ``lessons``). What a deleted mapping row gave is looked for in the earlier rows, what an inserted one
    gives in the present ones; a user who changed is in the changes of ``users`` themselves.
    """
    def rows(name: str) -> DataFrame:
        columns = WATCHED[name]
        return tables[name].select(*columns).unionByName(before[name].select(*columns)) if name in before else tables[name].select(*columns)

    found: list[DataFrame] = []

    def name_users(df: DataFrame, column: str) -> None:
        found.append(df.select(F.col(column).alias("user_id")))

    for name, column in (("users", "id"), ("student_details", "user_id"), ("ple_career_path_user", "user_id")):
        if name in changes:
            name_users(changes[name], column)

    offered = rows("centre_subject").select("centre_id", "subject_id").distinct()
    people = tables.users.select(F.col("id").alias("user_id"), "centre_id")
    subjects = [changes[name].select(F.col(column).alias("subject_id")) for name, column in (("subjects", "id"), ("lessons", "subject_id")) if name in changes]
    if "lesson_types" in changes:
        kinds = changes["lesson_types"].select(F.col("id").alias("lesson_type_id"))
        subjects.append(rows("lessons").join(kinds, "lesson_type_id", "left_semi").select("subject_id"))
    centres = [changes["centre_subject"].select("centre_id")] if "centre_subject" in changes else []
    if subjects:
        centres.append(offered.join(reduce(DataFrame.union, subjects).distinct(), "subject_id", "left_semi").select("centre_id"))
    if centres:
        name_users(people.join(reduce(DataFrame.union, centres).distinct(), "centre_id", "left_semi"), "user_id")

    # Pairs of a profile's key and a subject: users with the key whose centre offers the subject.
    profiles = {
        "batch_subject": ("batch_id", tables.student_details.select("user_id", F.col("batch_id").alias("key"))),
        "subject_trade": ("trade_id", tables.student_details.select("user_id", F.col("trade_id").alias("key"))),
        "subject_ple_career_path": ("ple_career_path_id", tables.ple_career_path_user.select("user_id", F.col("job_type_id").alias("key"))),
    }
    for name, (column, holders) in profiles.items():
        if name in changes:
            pairs = changes[name].select(F.col(column).alias("key"), "subject_id").distinct()
            # Centres are looked up for the few pairs first, so that users meet (key, centre) rows only.
            places = pairs.join(offered, "subject_id").select("key", "centre_id").distinct()
            concerned = holders.join(pairs.select("key").distinct(), "key", "left_semi").distinct().join(people, "user_id")
            name_users(concerned.join(places, ["key", "centre_id"], "left_semi"), "user_id")
    for name, holder, column in (("trades", "student_details", "trade_id"), ("ple_career_paths", "ple_career_path_user", "job_type_id")):
        if name in changes:
            ids = changes[name].select(F.col("id").alias(column))
            name_users(tables[holder].join(ids, column, "left_semi"), "user_id")
    if not found:
        return people.select("user_id").limit(0)
    return reduce(DataFrame.unionByName, found).filter(F.col("user_id").isNotNull()).distinct()
