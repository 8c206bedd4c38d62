"""Which work to retry, and the queue items new attempts need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import failed_stage
from attemptlog.functions.identity import named_id
from attemptlog.functions.stages import gate_failure, resume_stage, skip_queueitem
from attemptlog.operators.reports import current_failures


def recovery_worklist(log: DataFrame, max_retries: int | None = None) -> DataFrame:
    """Activities whose latest attempt failed without a case and may be tried again.

    A retry does not inherit ``max_retries``, so the limit is the highest one any attempt
    of the activity recorded, or the argument. It counts attempts.
    """
    stage = F.col("last_completed_stage")
    limit = F.col("max_retries") if max_retries is None else F.lit(max_retries)
    open_failures = current_failures(log).filter(
        F.col("crm_case_id").isNull() & F.coalesce(F.col("attempt_number") <= limit, F.lit(True))
    )
    return open_failures.select(
        "activity_id",
        "email_instance_id",
        "attempt_number",
        resume_stage(stage).alias("resume_processing_stage"),
        skip_queueitem(stage).alias("skip_queueitem_write"),
        failed_stage(F.col("status_details")).alias("failed_stage"),
    )


def worklist_requests(worklist: DataFrame, subjects: DataFrame, requested_at: str) -> DataFrame:
    """Turn a worklist into requests for ``b1_write``, with freshly pulled subjects.

    One request per activity; of several subjects the greatest counts.
    """
    pulled = subjects.groupBy("activity_id").agg(F.max("banker_subject").alias("banker_subject"))
    return worklist.join(pulled, "activity_id", "left").select(
        F.col("email_instance_id").cast("string").alias("request_id"),
        "activity_id",
        "banker_subject",
        F.lit(requested_at).cast("timestamp_ntz").alias("requested_at"),
    )


def gate_eval(queue_items: DataFrame) -> DataFrame:
    """Pass or Stop for each queue item, with the first gate it failed."""
    failure = gate_failure(F.col("item_type"), F.col("owner_id"), F.col("regarding_id"))
    return queue_items.withColumn("gate_failed", failure).withColumn(
        "gate_result", F.when(F.col("gate_failed").isNull(), "Pass").otherwise("Stop")
    )


def queue_item_write(
    new_rows: DataFrame, existing: DataFrame, messages: DataFrame
) -> DataFrame:
    """Queue items to append: one per activity that may write and has none yet.

    The earliest new attempt of an activity writes it; the others find it there. The queue
    is the one its request came from: ``messages`` has a ``queue_id`` per ``request_id``.
    """
    may_write = new_rows.filter(~skip_queueitem(F.col("last_completed_stage")))
    writers = (
        may_write.join(messages.select("request_id", "queue_id"), "request_id", "left")
        .groupBy("activity_id")
        .agg(
            F.min("attempt_number").alias("attempt_number"),
            F.min_by("queue_id", "attempt_number").alias("queue_id"),
        )
    )
    return writers.join(
        existing.select("activity_id").distinct(), "activity_id", "left_anti"
    ).select(
        named_id(F.lit("queue_item"), F.col("activity_id")).alias("queue_item_id"),
        "activity_id",
        "attempt_number",
        "queue_id",
        F.lit("Pending").alias("gate_result"),
        F.lit("Enqueued").alias("queue_status_code"),
    )
