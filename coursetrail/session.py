"""Session settings the plans rely on, and the durable scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only; sizing (executors, memory, shuffle partitions) stays
# with the cluster. The time zone is part of the results: moments become dates in it.
# The others only change how much is shuffled. `configure` sets them on the caller's session.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # One hot key is split over many tasks, even if that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A frame hashed on user_id may join on (user_id, subject_id) where it lies.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def durable_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the cluster's checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset and no
    checkpoint folder was given to the context (a local test run) a temporary folder
    takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="coursetrail-")
            context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, path: str):
    """File system and path object of a folder, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


@contextmanager
def kept(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame, computed once and stored; its files go when the block has ended well.

    After a failure they stay for the next look; a run that is repeated writes its own.
    """
    path = durable_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    yield df.sparkSession.read.parquet(path)
    files, target = folder(df.sparkSession, path)
    files.delete(target, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the durable folder and read it back: computed once, lineage cut."""
    path = durable_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
