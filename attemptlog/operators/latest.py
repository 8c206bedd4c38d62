"""Latest attempt per activity, three ways, and orderings of attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attemptlog.operators.skew import order_across


def latest_attempt(log: DataFrame) -> DataFrame:
    """The highest attempt of each activity.

    Spark limits the window to rank 1 before the shuffle as well, so a map task sends
    at most one row per activity however hot that is.
    """
    newest = Window.partitionBy("activity_id").orderBy(
        F.desc("attempt_number"), F.desc("email_instance_id")
    )
    return log.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def max_attempt(log: DataFrame) -> DataFrame:
    """Highest attempt number per activity."""
    return log.groupBy("activity_id").agg(F.max("attempt_number").alias("max_attempt_number"))


def latest_join(log: DataFrame) -> DataFrame:
    """Latest attempt by joining back to the maximum; ties return every tied row.

    The join is on (activity, number), so a hot activity is spread over all tasks.
    """
    top = max_attempt(log).withColumnRenamed("max_attempt_number", "attempt_number")
    return log.join(top, ["activity_id", "attempt_number"], "left_semi")


def latest_columns(log: DataFrame, columns: list[str], extra=()) -> DataFrame:
    """Chosen columns of the latest attempt with other aggregates, in one pass."""
    newest = F.max_by(
        F.struct(*columns), F.struct("attempt_number", "email_instance_id")
    ).alias("_latest")
    grouped = log.groupBy("activity_id").agg(newest, *extra)
    rest = [c for c in grouped.columns if c not in ("activity_id", "_latest")]
    return grouped.select("activity_id", "_latest.*", *rest)


def attempt_history(log: DataFrame) -> DataFrame:
    """Attempts with their recency: 1 is the newest of the activity.

    Of copies of one attempt the lowest id comes first.
    """
    keyed = log.withColumns(
        {
            "_newest": -F.unix_micros(F.col("created_date_time").cast("timestamp")),
            "_highest": -F.col("attempt_number"),
        }
    )
    return order_across(
        keyed, ["activity_id"], ["_newest", "_highest", "email_instance_id"], "recency"
    ).drop("_newest", "_highest")


def retry_gap(log: DataFrame) -> DataFrame:
    """Seconds since the previous attempt of the same activity; NULL on the first."""
    ordered = order_across(
        log.select("email_instance_id", "activity_id", "attempt_number", "created_date_time"),
        ["activity_id"],
        ["attempt_number", "email_instance_id"],
        "_n",
        {"previous_created": "created_date_time"},
    )
    return ordered.select(
        "email_instance_id",
        "activity_id",
        "attempt_number",
        (seconds_between(F.col("previous_created"), F.col("created_date_time"))).alias(
            "gap_seconds"
        ),
    )


def last_retry(log: DataFrame) -> DataFrame:
    """When each retried activity was last retried."""
    return (
        log.groupBy("activity_id")
        .agg(
            F.max("attempt_number").alias("attempts"),
            F.max_by("created_date_time", "attempt_number").alias("last_retry_date_time"),
        )
        .filter("attempts > 1")
    )


def micros_between(start, end):
    """Microseconds from ``start`` to ``end`` as a long."""
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def seconds_between(start, end):
    """Seconds from ``start`` to ``end``, with fraction."""
    return micros_between(start, end) / F.lit(1_000_000)


def audit_page(tracking: DataFrame, start: str, end: str, size: int) -> DataFrame:
    """Newest page of an audit range; the key breaks ties."""
    return audit_range(tracking, start, end).limit(size)


def audit_range(tracking: DataFrame, start: str, end: str) -> DataFrame:
    """Tracked e-mails created in ``[start, end)``, newest first."""
    created = F.col("CreatedAt")
    return (
        tracking.filter((created >= F.lit(start).cast("timestamp_ntz")))
        .filter(created < F.lit(end).cast("timestamp_ntz"))
        .select("ActivityId", "CreatedAt", "Status", "CaseId", "CorrelationId")
        .orderBy(F.desc("CreatedAt"), F.desc("ActivityId"))
    )


def top_one(log: DataFrame, activity_id: str) -> DataFrame:
    """The single highest attempt of one activity; of copies, the one with the highest id."""
    return (
        log.filter(F.col("activity_id") == activity_id)
        .orderBy(F.desc("attempt_number"), F.desc("email_instance_id"))
        .limit(1)
    )
