"""Activity logs as streams.

Attempts are merged by key and time, so their order of arrival and repeated delivery
change nothing, and no watermark is needed. The state of ``latest_attempts`` grows with users
and lessons, as its keys hold no time by which Spark could drop them; ``keep_completion_table``
keeps that state in a table instead and is the one for long runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursetrail.operators.completion import ATTEMPT, KEYS, latest_attempt
from coursetrail.sinks.user_table import UserTable


def finished(stream: DataFrame) -> DataFrame:
    return stream.filter(F.col("completed") == 1).select(*ATTEMPT)


def latest_attempts(stream: DataFrame) -> DataFrame:
    """Newest attempt per user and lesson as a running aggregate (update or complete mode).

    A struct compares field by field with NULL as the smallest value, which is the order
    ``latest_attempt`` uses.
    """
    values = [c for c in ("completed_at", "score", "rating", "duration")]
    newest = F.max(F.struct(*values)).alias("newest")
    return finished(stream).groupBy(*KEYS).agg(newest).select(*KEYS, *[F.col(f"newest.{c}").alias(c) for c in values])


def keep_completion_table(stream: DataFrame, table: UserTable, checkpoint: str,
                          then: Callable[[DataFrame], None] | None = None, *,
                          every: str | None = None) -> StreamingQuery:
    """Upsert each micro-batch into the completion table, then hand its users on.

    ``then`` gets the distinct users of the batch, for example to refresh their outputs.
    Repeating a batch after a failure leaves the table as it is. Without ``every`` the
    query takes what is there and stops.
    """
    def take(batch: DataFrame, _number: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                table.upsert(latest_attempt(batch), latest_attempt)
                if then is not None:
                    then(batch.select("user_id").distinct())
        finally:
            batch.unpersist()

    writer = finished(stream).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def changed_users(logs: Sequence[DataFrame], late: str = "7 days") -> DataFrame:
    """Users with new finished attempts in any of the logs, once in each stretch of time, as a stream.

    Both logs are one stream; within ``late`` of its first attempt a user is named once. A user's entry leaves the state when the watermark has
    passed it, so the state is bounded by the users of that time. Attempts later than ``late`` behind the newest one are left to
    an update by day sums (``update_store``).
    """
    moments = [finished(log).select("user_id", "completed_at").filter("user_id IS NOT NULL AND completed_at IS NOT NULL") for log in logs]
    # Watermarks need a timestamp with zone; the session's zone is UTC.
    moment = reduce(DataFrame.unionByName, moments).withColumn("completed_at", F.col("completed_at").cast("timestamp"))
    return moment.withWatermark("completed_at", late).dropDuplicatesWithinWatermark(["user_id"]).select("user_id")
