"""Named access to the source tables, whatever they are stored in."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetrail.schema import SOURCE_TYPES
from coursetrail.sources import testmap
from coursetrail.sources.sanitize import sanitize

# A lookup side is broadcast only after its tables were measured: at most this many rows,
# and at most this many bytes if every row were as wide as the widest. Beyond either bound
# the join shuffles and hot keys are split.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 * 1024 * 1024

# Tables that lookups are made of, measured together.
LOOKUPS = ("batch_subject", "centre_subject", "lesson_types", "lessons", "ple_career_paths", "subject_ple_career_path",
           "subject_trade", "subjects", "trades")
# Tables that grow with use and are never read by one task.
LOGS = ("learning_activities", "facilitator_learning_activities", "login_logs")

# The source calls the position of a subject in a centre by a reserved word.
_RENAMES = {"centre_subject": {"order": "subject_order"}}


class Tables:
    """Maps table names to lazy, cleaned DataFrames: ``tables.users``."""

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame],
                 replaced: Mapping[str, DataFrame] | None = None, clean_times: bool = False,
                 measured: Mapping[str, tuple[int, int]] | None = None):
        self.spark = spark
        self._loader = loader
        self._loaded: dict[str, DataFrame] = dict(replaced or {})
        self._clean_times = clean_times
        self._measured: dict[str, tuple[int, int]] = dict(measured or {})
        self._known: dict[str, Any] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCE_TYPES:
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            raw = self._loader(name)
            for old, new in _RENAMES.get(name, {}).items():
                raw = raw.withColumnRenamed(old, new)
            self._loaded[name] = sanitize(raw, SOURCE_TYPES[name], self._clean_times)
        return self._loaded[name]

    def with_tables(self, **frames: DataFrame) -> Tables:
        """The same tables with some of them exchanged; measures of the others stay known."""
        known = {name: size for name, size in self._measured.items() if name not in frames}
        return Tables(self.spark, self._loader, {**self._loaded, **frames}, self._clean_times, known)

    def known(self, what: str, find: Callable[[], Any]) -> Any:
        """Something about these tables, found once."""
        if what not in self._known:
            self._known[what] = find()
        return self._known[what]

    def _measure(self, *names: str) -> list[tuple[int, int]]:
        """Rows of tables and bytes of their widest rows.

        The first call measures all tables that lookups are made of, in one job of partial
        aggregates: every task hands on one row, however large the table is.
        """
        if missing := [n for n in names if n not in self._measured]:
            wanted = list(dict.fromkeys([*missing, *(n for n in LOOKUPS if n not in self._measured)]))
            parts = []
            for name in wanted:
                df = self[name]
                width = [F.coalesce(F.octet_length(c), F.lit(0)) if kind == "string" else F.lit(16) for c, kind in df.dtypes]
                parts.append(df.select(F.lit(name).alias("name"), sum(width[1:], width[0]).alias("width")))
            sizes = reduce(DataFrame.union, parts).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("width").alias("width"))
            # Only what the job found is believed: should it fail, nothing counts as measured.
            found = {row["name"]: (row["n"], row["width"]) for row in sizes.collect()}
            self._measured.update({name: found.get(name, (0, 0)) for name in wanted})
        return [self._measured[n] for n in names]

    def is_small(self, name: str, *columns_of: str) -> bool:
        """Whether two rows per row of ``name``, with the columns of all these tables, stay in bounds."""
        measures = self._measure(name, *columns_of)
        width = sum(bytes_per_row for _, bytes_per_row in measures) + 256
        return all(rows <= BROADCAST_ROWS for rows, _ in measures) and 2 * measures[0][0] * width <= BROADCAST_BYTES

    def lookup(self, side: DataFrame, rows_of: str, *columns_of: str) -> DataFrame:
        """Mark ``side`` for broadcast if it is proven to be small.

        It has at most two rows per row of table ``rows_of``; its columns come from there
        and from the tables ``columns_of``, and up to 16 more are numbers or flags.
        """
        return F.broadcast(side) if self.is_small(rows_of, *columns_of) else side

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(spark, lambda name: frames[name])

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, clean_times: bool = False) -> Tables:
        """One Parquet folder per table below ``root``; ``clean_times`` for dumps that may hold dates of year one."""
        return cls(spark, lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"), clean_times=clean_times)

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: Mapping[str, str],
                  partitioning: Mapping[str, Mapping[str, str]] | None = None,
                  prefixes: Mapping[str, str] | None = None, queries: Mapping[str, str] | None = None) -> Tables:
        """Tables of a database.

        ``partitioning[table]`` holds ``partitionColumn`` and ``numPartitions`` for the tables
        that must be read by many tasks at once; bounds that it does not give are found by one
        query for the smallest and largest value. The logs are refused without it.
        ``prefixes[table]`` names the schema a table lives in, ``queries[table]`` is a query
        to read instead of the table. Column choice and filters are pushed to the database by Spark.
        """
        def load(source: str, **options: str) -> DataFrame:
            return spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", source).options(**options).load()

        def read(name: str) -> DataFrame:
            query = (queries or {}).get(name)
            source = f"({query}) AS {name}_rows" if query else (prefixes or {}).get(name, "") + name
            options = dict((partitioning or {}).get(name, {}))
            if name in LOGS and not options:
                raise ValueError(f"{name} may be of any size: give it a partitioning")
            if options and "lowerBound" not in options:
                column = options["partitionColumn"]
                least, most = load(f"(SELECT min({column}) AS least, max({column}) AS most FROM {source} AS bounds_of) AS bounds"
                                   if not query else f"(SELECT min({column}) AS least, max({column}) AS most FROM {source}) AS bounds").first()
                if least is None:
                    return load(source)
                options |= {"lowerBound": str(least), "upperBound": str(most)}
            return load(source, **options)

        return cls(spark, read, clean_times=True)

    @classmethod
    def from_star_schema(cls, spark: SparkSession, folder: str) -> Tables:
        """The learning tables derived from the star-schema test tables."""
        return cls(spark, lambda name: testmap.load(spark, folder, name))


def source_profile(tables: Tables, names: list[str]) -> DataFrame:
    """Row count per source table, ordered by name."""
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result.orderBy("table_name")
