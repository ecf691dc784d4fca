"""Dealing rows out in the order of a key, by boundaries taken from the keys alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the name with underscores that no column of the frame has in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def boundaries(keys: DataFrame, key: str, count: int) -> list[int]:
    """At most count - 1 keys of the table that cut it into ranges of about equal size.

    Reads one column. Each boundary is the first key of its range; the smallest key is none. Quantiles are doubles and need not
    be keys, so the first key of each range is looked up.
    """
    if count < 2:
        return []
    shares = [i / count for i in range(count)]
    found = keys.approxQuantile(key, shares, 1 / (8 * count))
    cuts = sorted({max(-(1 << 63), min(int(x), (1 << 63) - 1)) for x in found})
    firsts = keys.groupBy(range_of(F.col(key), cuts).alias("range")).agg(F.min(key).alias("first")).collect()
    return sorted(r["first"] for r in firsts if r["first"] is not None)[1:]


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of boundaries at or below the key, by halving; a null key is in range 0."""
    if not bounds:
        return F.lit(0)
    array, steps = F.array(*(F.lit(b).cast("bigint") for b in bounds)), len(bounds).bit_length()

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = F.get(array, middle) <= key
        return (F.when(s["lo"] >= s["hi"], s)
                .when(above, F.struct((middle + 1).alias("lo"), s["hi"].alias("hi")))
                .otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi"))))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])
    return F.when(key.isNull(), 0).otherwise(found)
