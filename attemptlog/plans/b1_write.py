"""Next attempts for a whole batch of requests.

The rows equal those of serving the requests one after another. A retry copies the
last completed stage, so its resume point is its prior's and what it may carry forward
does not change along the batch: the k-th request of an activity needs only the
activity's latest stored attempt and k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.identity import instance_id
from attemptlog.functions.stages import (
    CARRY,
    FIRST_STAGE,
    RECEIVED,
    carry_forward,
    resume_stage,
    skip_queueitem,
)
from attemptlog.operators.latest import latest_attempt
from attemptlog.operators.skew import join_unique, order_within, time_pieces
from attemptlog.sources.tables import canonical

PRIOR = ["activity_id", "email_instance_id", "attempt_number", "last_completed_stage", *CARRY]
WRITTEN = [
    "email_instance_id",
    "activity_id",
    "attempt_number",
    "previous_email_instance_id",
    "banker_subject",
    *CARRY,
    "status_code",
    "last_completed_stage",
]


def route_requests(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Mark each request as a retry or a first attempt."""
    requests = canonical(requests)
    known = requested(log, requests).select("activity_id").distinct()
    known = known.withColumn("_known", F.lit(True))
    return join_unique(requests, known, ["activity_id"], "left").select(
        *requests.columns,
        F.when(F.col("_known"), "retry").otherwise("first").alias("route"),
    )


def requested(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Attempts of the activities asked for.

    A short list is broadcast by its measured size, and the rest of the log never leaves
    the scan.
    """
    return log.join(requests.select("activity_id").distinct(), "activity_id", "left_semi")


def reusable_prior(log: DataFrame, requests: DataFrame) -> DataFrame:
    """The latest stored attempt of each requested activity with what a retry may use of it.

    What may not be carried forward is cleared before the shuffle, which keeps most of
    the long texts out of it.
    """
    return _as_prior(latest_attempt(requested(_usable(log), requests)))


def reusable_from(latest: DataFrame) -> DataFrame:
    """The same from rows that are known to be the latest of their activities."""
    return _as_prior(_usable(latest))


def _usable(log: DataFrame) -> DataFrame:
    return log.select(*PRIOR).withColumns(carry_forward(resume_stage(F.col("last_completed_stage"))))


def _as_prior(rows: DataFrame) -> DataFrame:
    return rows.select("activity_id", *[F.col(c).alias(f"prior_{c}") for c in PRIOR[1:]])


def request_prior(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Each request with its activity's latest stored attempt, if any."""
    requests = canonical(requests)
    prior = reusable_prior(log, requests)
    return join_unique(requests, prior, ["activity_id"], "left")


ARRIVAL = ["requested_at", "request_id"]


def assign_attempts(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Requests with their prior attempt, their place in line and their attempt number."""
    return numbered(request_prior(in_line(requests), log))


def in_line(requests: DataFrame) -> DataFrame:
    """Requests with their place among those of their activity."""
    requests = canonical(requests)
    return order_within(
        requests, ["activity_id"], ARRIVAL, time_pieces(requests, *ARRIVAL), "request_number"
    )


def numbered(with_prior: DataFrame) -> DataFrame:
    """Requests in line, with their prior attempt, and the attempt number that follows."""
    stored = F.coalesce("prior_attempt_number", F.lit(0))
    return with_prior.withColumn(
        "attempt_number", (stored + F.col("request_number")).cast("int")
    )


def b1_write(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Attempt rows to append for a batch of requests.

    Ids are computed from (activity, attempt), so the row before is known by name and a
    re-run task yields the same ids.
    """
    return written(assign_attempts(requests, log))


def written(assigned: DataFrame) -> DataFrame:
    """Attempt rows for requests that have their prior attempt and their number."""
    activity, attempt = F.col("activity_id"), F.col("attempt_number")
    first = F.col("prior_email_instance_id").isNull()
    return assigned.select(
        "request_id",
        instance_id(activity, attempt).alias("email_instance_id"),
        activity,
        attempt,
        F.when(F.col("request_number") > 1, instance_id(activity, attempt - 1))
        .otherwise(F.col("prior_email_instance_id").cast("string"))
        .alias("previous_email_instance_id"),
        "banker_subject",
        *[F.col(f"prior_{c}").alias(c) for c in CARRY],
        F.lit(RECEIVED).alias("status_code"),
        F.when(first, FIRST_STAGE)
        .otherwise(F.col("prior_last_completed_stage"))
        .alias("last_completed_stage"),
    )


def insert_first(new_rows: DataFrame) -> DataFrame:
    """The first attempts among new rows."""
    return new_rows.filter("attempt_number = 1")


def insert_retry(new_rows: DataFrame) -> DataFrame:
    """The retries among new rows."""
    return new_rows.filter("attempt_number > 1")


def returning(new_rows: DataFrame) -> DataFrame:
    """What the caller gets back per request: the new id and the skip flag."""
    return new_rows.select(
        "request_id",
        "email_instance_id",
        skip_queueitem(F.col("last_completed_stage")).alias("skip_queueitem_write"),
    )
