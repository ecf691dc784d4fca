"""Stored states of the watched tables, to find out what changed since an output was made.

A snapshot holds, for each table, a copy of its watched columns sorted by bucket, and the tree of hash sums of that copy. A table that did not
change is not copied again: the new state names the old copy. A state counts from when its name is written, which is the last step; a run that
fails leaves the earlier one in force. What is saved is what was compared, so a change during a run is found by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetrail.operators.deltas import DEPTH, LEAVES, changed_nodes, changed_rows, hash_tree, watched
from coursetrail.operators.fingerprint import WATCHED
from coursetrail.session import folder
from coursetrail.sources.tables import Tables


@dataclass
class State:
    """Copies of the tables by name, and the tree of all of them."""

    spark: SparkSession
    copies: dict[str, str]
    tree_path: str

    @property
    def tree(self) -> DataFrame:
        return self.spark.read.parquet(self.tree_path)

    def rows(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.copies[name])


@dataclass
class Change:
    """A state and the one before it."""

    now: State
    before: State

    @cached_property
    def nodes(self) -> DataFrame:
        """The nodes that differ, computed once; at most as many as two trees have."""
        found = changed_nodes(self.now.tree, self.before.tree)
        return self.now.spark.createDataFrame(found.collect(), found.schema)

    @cached_property
    def leaves(self) -> dict[str, list[int]]:
        """Numbers of the changed leaves of each table, LEAVES at most."""
        found: dict[str, list[int]] = {name: [] for name in self.now.copies}
        for row in self.nodes.filter(F.col("level") == DEPTH).collect():
            found[row["table_name"]].append(row["node"])
        return found

    @cached_property
    def tables(self) -> list[str]:
        """Names of the tables that changed."""
        return sorted(name for name in self.now.copies if self.now.copies[name] != self.before.copies.get(name))

    def rows(self) -> Mapping[str, DataFrame]:
        """The changed rows of each changed table; rows of leaves that are the same are not read, as copies lie sorted by leaf."""
        return {name: changed_rows(name, self.now.rows(name), self.before.rows(name), self.leaves[name]) for name in self.tables}


class Snapshots:
    """States below a folder; the newest one is named in its file ``latest``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def latest(self) -> State | None:
        files, target = folder(self.spark, f"{self.path}/latest/_SUCCESS")
        if not files.exists(target):
            return None
        rows = self.spark.read.parquet(f"{self.path}/latest").collect()  # one row a table
        return State(self.spark, {r["table_name"]: r["copy"] for r in rows}, rows[0]["tree"])

    def take(self, tables: Tables) -> State:
        """The present state, not yet in force. The tables are summed up; those that differ from the state in force are copied."""
        version, known = uuid.uuid4().hex, self.latest()
        names = sorted(WATCHED)
        changed = names
        if known is not None:
            roots = [{r["table_name"]: (r["row_count"], r["content_sum"]) for r in tree.filter("level = 0").collect()}
                     for tree in (hash_tree({name: watched(tables, name) for name in names}, levels=0), known.tree)]
            changed = [name for name in names if roots[0].get(name) != roots[1].get(name)]
            if not changed:
                return known
        copies = {name: known.copies[name] for name in names if name not in changed} if known else {}
        copies |= {name: f"{self.path}/copies/{name}-{version}" for name in changed}
        with ThreadPoolExecutor(4) as several:  # most tables are small, and each is a job of its own
            list(several.map(lambda name: self._copy(watched(tables, name), copies[name]), changed))
        # From the copies, not from the tables: these may have gone on meanwhile.
        tree = hash_tree({name: self.spark.read.parquet(copies[name]) for name in changed})
        if known is not None:
            tree = tree.unionByName(known.tree.filter(~F.col("table_name").isin(changed)))
        path = f"{self.path}/trees/{version}"
        tree.coalesce(1).write.parquet(path)
        return State(self.spark, copies, path)

    def _copy(self, rows: DataFrame, path: str) -> None:
        """Write rows in order of their buckets, a range of these to a file, so that a read of some buckets skips files."""
        files = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        place = F.floor(F.col("leaf") * files / LEAVES).cast("int")
        rows.repartitionById(files, place).sortWithinPartitions("leaf").write.parquet(path)

    def save(self, state: State) -> None:
        """Put a state in force, and delete the copies that the earlier one alone used."""
        before = self.latest()
        rows = [(name, copy, state.tree_path) for name, copy in state.copies.items()]
        self.spark.createDataFrame(rows, "table_name string, copy string, tree string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/latest")
        if before is not None and before.tree_path != state.tree_path:
            for path in {before.tree_path, *before.copies.values()} - {state.tree_path, *state.copies.values()}:
                files, target = folder(self.spark, path)
                files.delete(target, True)
