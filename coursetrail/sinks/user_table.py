"""Parquet tables that are replaced user by user.

Rows lie in folders by a hash of the user's id; the name of the partition column carries
the number of folders. A change rewrites only the folders its users fall into: Spark
writes them aside and swaps them in when all tasks have succeeded (dynamic partition
overwrite), so a job may read the table it rewrites, and tasks may fail and be repeated.
The swap itself moves folder after folder: if the driver is lost within it, rows of a
folder being swapped are in Spark's staging folder only, and an update is not a transaction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetrail.session import folder, kept

_PREFIX = "user_bucket_of_"


class UserTable:
    """``key`` is the column with the user's id. An existing table has its number of ``buckets``; 64 is that of new ones."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, key: str = "user_id"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets or 64
        if self.exists():
            name = next(c for c in self._stored().columns if c.startswith(_PREFIX))
            found = int(name.removeprefix(_PREFIX))
            if buckets not in (None, found):
                raise ValueError(f"the table at {self.path} has {found} buckets, not {buckets}")
            self.buckets = found

    @property
    def bucket_column(self) -> str:
        return f"{_PREFIX}{self.buckets}"

    def bucket(self, user_id: str | None = None) -> Column:
        return F.pmod(F.xxhash64(user_id or self.key), F.lit(self.buckets)).cast("int").alias(self.bucket_column)

    def has(self, path: str) -> bool:
        files, target = folder(self.spark, path)
        return files.exists(target)

    def exists(self) -> bool:
        return self.has(self.path + "/_SUCCESS")

    def _ids(self, users: DataFrame) -> DataFrame:
        """Ids of a frame with a column ``user_id``, under the name of the key."""
        return users.select(F.col("user_id").alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()

    def _stored(self) -> DataFrame:
        # The schema lies beside the table, so that a table without rows can be read too.
        schema = self.spark.read.parquet(self.path + ".schema").schema
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.bucket_column)

    def read_users(self, users: DataFrame) -> DataFrame:
        """Rows of the given users; only their folders are listed and read."""
        ids = self._ids(users)
        rows = self._stored().filter(F.col(self.bucket_column).isin(self._touched(ids)))
        return rows.drop(self.bucket_column).join(ids, self.key, "left_semi")

    def _touched(self, users: DataFrame) -> list[int]:
        """Folder numbers of the users: at most ``buckets`` integers."""
        return [row[0] for row in users.select(self.bucket()).distinct().collect()]

    def _write(self, rows: DataFrame, mode: str, dynamic: bool = False) -> None:
        # Rebalancing merges small outputs and splits a folder that outgrows one task.
        rows = rows.hint("rebalance", F.col(self.bucket_column))
        writer = rows.write.mode(mode).partitionBy(self.bucket_column)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path)

    def overwrite(self, rows: DataFrame) -> None:
        rows = rows.select("*", self.bucket())
        rows.limit(0).coalesce(1).write.mode("overwrite").parquet(self.path + ".schema")
        self._write(rows, "overwrite")

    def append(self, rows: DataFrame) -> None:
        self._write(rows.select("*", self.bucket()), "append")

    def rewrite(self, touched: list[int], build: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the touched folders by ``build(their present rows)``; rows that fall elsewhere are an error of the caller and left out."""
        present = self._stored().filter(F.col(self.bucket_column).isin(touched))
        before = {number: self._files(number) for number in touched}
        rows = build(present.drop(self.bucket_column)).select("*", self.bucket())
        self._write(rows.filter(F.col(self.bucket_column).isin(touched)), "overwrite", dynamic=True)
        for number in touched:
            # A folder that got no rows was not swapped: its files are still the old ones.
            if self._files(number) == before[number]:
                files, target = folder(self.spark, f"{self.path}/{self.bucket_column}={number}")
                files.delete(target, True)

    def _files(self, number: int) -> set[str]:
        """File names of one folder, a matter of metadata."""
        files, target = folder(self.spark, f"{self.path}/{self.bucket_column}={number}")
        return {entry.getPath().getName() for entry in files.listStatus(target)} if files.exists(target) else set()

    def replace_users(self, rows: DataFrame, users: DataFrame) -> None:
        """Remove all rows of ``users`` and insert their ``rows``; other users stay as they are, and rows of others are not taken."""
        with kept(self._ids(users), "replaced-users") as ids:
            fresh = rows.join(ids, self.key, "left_semi")
            if self.exists():
                self.rewrite(self._touched(ids), lambda present: present.join(ids, self.key, "left_anti").unionByName(
                    fresh.select(*present.columns)))
            else:
                self.overwrite(fresh)

    def delete_users(self, users: DataFrame) -> None:
        if self.exists():
            self.replace_users(self.read().limit(0), users)

    def upsert(self, rows: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Merge rows into the table; ``combine`` reduces present and new rows of a key.

        The rows are computed once and stored: a source that changes meanwhile must not name other folders than it fills.
        """
        if not self.exists():
            self.overwrite(combine(rows))
            return
        with kept(rows, "upserted-rows") as fixed:
            self.rewrite(self._touched(fixed), lambda present: combine(present.unionByName(fixed.select(*present.columns))))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV folder with header lines, written by all tasks at once."""
    df.write.mode(mode).option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "overwrite") -> None:
    """Replace or append to a database table; ``truncate`` keeps its declared column types."""
    df.write.format("jdbc").mode(mode).options(**properties).option("url", url).option(
        "dbtable", table).option("truncate", True).save()


def stage_for_replace(df: DataFrame, users: DataFrame, url: str, staging: str, properties: dict[str, str]) -> None:
    """Stage rows and the ids they replace in a database, for one statement of its own to exchange them.

    Writes ``staging`` (rows) and ``staging_ids`` (the ids); the keyed delete and insert from there is a transaction that
    only the database can do. Could not be tried here, as no database may be started.
    """
    write_jdbc(df, url, staging, properties)
    write_jdbc(users.select("user_id").distinct(), url, f"{staging}_ids", properties)
