"""Type cleaning at ingest: zero dates, loose timestamps, decimals, text numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how the source database prints a missing date.
ZERO_DATE = "0000-00-00 00:00:00"


def clean_timestamp(value: Column, source: T.DataType) -> Column:
    """Timestamp without zone; the zero date, year one and unreadable text become NULL."""
    if isinstance(source, T.StringType):
        parsed = F.nullif(value, F.lit(ZERO_DATE)).try_cast("timestamp_ntz")
    else:
        parsed = value.cast("timestamp_ntz")
    return F.when(F.year(parsed) > 1, parsed)


def sanitize(df: DataFrame, types: dict[str, str], clean_times: bool = False) -> DataFrame:
    """Bring the named columns to their declared types, one projection, nothing else.

    Columns that already have the declared type are passed through as they are, so
    filters on them still reach the scan. ``clean_times`` looks for year-one dates even in
    columns that already are timestamps, as a database may deliver them.
    """
    columns = []
    for field in df.schema.fields:
        target = types.get(field.name)
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType) and target is None:
            value = value.cast("double")
        elif target == "timestamp_ntz" and (clean_times or not isinstance(field.dataType, T.TimestampNTZType)):
            value = clean_timestamp(value, field.dataType)
        elif target is not None and target != field.dataType.simpleString():
            value = value.try_cast(target)
        columns.append(value.alias(field.name))
    return df.select(*columns)


REJECT = "array<struct<column:string,value:string,reason:string>>"


def checked(df: DataFrame, types: dict[str, str], clean_times: bool = False, name: str = "rejects") -> DataFrame:
    """``sanitize``, and in one more column the values that became NULL by it: column, text and why.

    One pass: rows without an entry are clean, ``rejected`` lists the others' values. Write the frame once to have both.
    """
    clean = sanitize(df.select("*", F.struct("*").alias(name)), types, clean_times)
    found = []
    for field in df.schema.fields:
        if field.name not in types or types[field.name] == field.dataType.simpleString() and not clean_times:
            continue
        before = F.col(f"{name}.{field.name}")
        text = before.cast("string")
        missing = text.startswith("0000-00-00") | text.startswith("0001-01-01")
        reason = F.when(F.lit(types[field.name] == "timestamp_ntz") & missing, "no date").otherwise(f"no {types[field.name]}")
        found.append(F.when(before.isNotNull() & F.col(field.name).isNull(), F.struct(F.lit(field.name).alias("column"), text.alias("value"), reason.alias("reason"))))
    rejects = F.array_compact(F.array(*found)) if found else F.lit(None).cast(REJECT)
    return clean.withColumn(name, F.coalesce(rejects.cast(REJECT), F.array().cast(REJECT)))


def rejected(rows: DataFrame, *keys: str, name: str = "rejects") -> DataFrame:
    """(keys, column, value, reason) of every value that ``checked`` could not take."""
    return rows.filter(F.size(name) > 0).select(*keys, F.explode(name).alias("reject")).select(*keys, "reject.*")
