"""Runs registered queries and their SQL checks side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return None if value != value else round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, run, sql):
    """Empty text if both results are the same multiset of rows, otherwise what differs."""
    frame = run(spark, folder)
    spark_names, left = bag(frame.columns, frame.collect())
    cursor = con.execute(sql)
    sql_names, right = bag([d[0] for d in cursor.description], cursor.fetchall())
    if spark_names != sql_names:
        return f"columns {sorted(set(spark_names) ^ set(sql_names))}", 0
    if left != right:
        only_left, only_right = left - right, right - left
        return (f"rows {left.total()} vs {right.total()}, only spark {only_left.total()}: {list(only_left)[:2]}, "
                f"only sql {only_right.total()}: {list(only_right)[:2]}"), left.total()
    return "", left.total()


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry_points

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, queries, sql = connect(folder), entry_points.queries(), entry_points.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            problem, rows = compare(spark, con, folder, queries[name], sql[name])
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {rows} rows {time.time() - start:.1f}s {problem}", flush=True)
