"""Declared types of the one-row-per-user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.schema import USER_JSON_TARGET, require


def enforce(df: DataFrame) -> DataFrame:
    """Exactly the declared columns in their declared types."""
    require(df, list(USER_JSON_TARGET), "user rows")
    return df.select(*[F.col(name).cast(kind).alias(name) for name, (kind, _) in USER_JSON_TARGET.items()])


def too_long(df: DataFrame) -> DataFrame:
    """How many texts exceed the declared length, per column, in one pass."""
    limits = {name: length for name, (_, length) in USER_JSON_TARGET.items() if length}
    counted = df.agg(*[F.count(F.when(F.length(F.col(n).cast("string")) > size, 1)).alias(n)
                       for n, size in limits.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(size).alias("max_length"),
                               F.col(n).alias("violations")) for n, size in limits.items()])
    return counted.select(F.explode(pairs).alias("p")).select("p.*")
