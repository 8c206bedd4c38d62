"""Counts, rates and latencies over the attempt log.

All of them aggregate before the shuffle. Hot groups therefore cost one partial row per
map task, and the log itself is never shuffled for a report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import details_typed, failed_stage
from attemptlog.functions.stages import (
    FAILED,
    FAILED_NO_RETRY,
    normalise_stage,
    resume_stage,
    status_description,
)
from attemptlog.operators.latest import latest_columns, micros_between
from attemptlog.operators.lookups import failed
from attemptlog.operators.quantiles import selected_quantiles

VERSIONS = ("agent_version", "prompt_version", "taxonomy_version")


def rows() -> Column:
    return F.count(F.lit(1))


def retry_counts(log: DataFrame) -> DataFrame:
    """How many activities had how many retries."""
    per_activity = log.groupBy("activity_id").agg((rows() - 1).alias("retries"))
    return per_activity.groupBy("retries").agg(rows().alias("activities"))


def failed_by_stage(log: DataFrame) -> DataFrame:
    """Failed attempts per blamed stage, spelling unified."""
    stage = normalise_stage(failed_stage(F.col("status_details")))
    return failed(log).groupBy(stage.alias("failed_stage")).agg(rows().alias("attempts"))


def failed_by_resume(log: DataFrame) -> DataFrame:
    """Failed attempts per resume point."""
    point = resume_stage(F.col("last_completed_stage"))
    return failed(log).groupBy(point.alias("resume_processing_stage")).agg(
        rows().alias("attempts")
    )


def status_counts(log: DataFrame) -> DataFrame:
    """Activities per current status.

    Only the status of the highest attempt is kept per activity, a fixed-width buffer.
    """
    current = log.groupBy("activity_id").agg(
        F.max_by("status_code", "attempt_number").alias("status_code")
    )
    return (
        current.groupBy("status_code")
        .agg(rows().alias("activities"))
        .withColumn("status_description", status_description(F.col("status_code")))
    )


def failure_codes(log: DataFrame) -> DataFrame:
    """Failures by error code, HTTP status and stage."""
    return (
        details_typed(log.filter(F.col("status_details").isNotNull()))
        .groupBy(
            F.col("details.error_code").alias("error_code"),
            F.col("details.http_status").alias("http_status"),
            normalise_stage(F.col("details.failed_stage")).alias("failed_stage"),
        )
        .agg(rows().alias("attempts"))
    )


def _share(flag: Column) -> Column:
    return F.round(F.avg(flag.cast("int").cast("double")), 6)


def banker_modified_rate(log: DataFrame) -> DataFrame:
    """Share of created cases a banker changed afterwards."""
    return log.filter("crm_case_id IS NOT NULL").agg(
        rows().alias("cases"), _share(F.col("banker_modified_flag")).alias("modified_rate")
    )


def version_quality(log: DataFrame) -> DataFrame:
    """Confidence and outcome per agent, prompt and taxonomy version.

    ``percentile`` counts distinct values; a DECIMAL(5,4) has fewer than 200,000 of them.
    """
    score = F.col("agent_confidence_score").cast("double")
    return log.groupBy(*VERSIONS).agg(
        rows().alias("attempts"),
        F.round(F.avg(score), 6).alias("confidence_mean"),
        F.round(F.percentile(score, 0.5), 6).alias("confidence_p50"),
        F.round(F.percentile(score, 0.95), 6).alias("confidence_p95"),
        _share(F.coalesce(F.col("status_code").isin(FAILED, FAILED_NO_RETRY), F.lit(False))).alias(
            "failure_rate"
        ),
        _share(F.col("banker_modified_flag")).alias("modified_rate"),
    )


def time_to_case(log: DataFrame) -> DataFrame:
    """Median and tail of the time from an e-mail's first attempt to its case."""
    spans = (
        log.groupBy("activity_id")
        .agg(
            F.min("created_date_time").alias("_first"),
            F.min("case_created_date_time").alias("_case"),
        )
        .select(micros_between(F.col("_first"), F.col("_case")).alias("micros"))
    )
    return selected_quantiles(spans, [], "micros", {"p50": 0.5, "p95": 0.95}).select(
        F.col("n").alias("cases"),
        F.round(F.col("p50") / 1_000_000, 6).alias("p50_seconds"),
        F.round(F.col("p95") / 1_000_000, 6).alias("p95_seconds"),
    )


def queue_latency(queue_items: DataFrame) -> DataFrame:
    """Median and tail of the waits before and in each queue."""
    waits = queue_items.select(
        "queue_name",
        F.explode(
            F.create_map(
                F.lit("received_to_enqueued"),
                micros_between(F.col("received_date_time"), F.col("enqueued_date_time")),
                F.lit("enqueued_to_processed"),
                micros_between(F.col("enqueued_date_time"), F.col("processed_date_time")),
            )
        ).alias("leg", "micros"),
    )
    return selected_quantiles(
        waits, ["queue_name", "leg"], "micros", {"p50": 0.5, "p95": 0.95}
    ).select(
        "queue_name",
        "leg",
        F.col("n").alias("items"),
        F.round(F.col("p50") / 1_000_000, 6).alias("p50_seconds"),
        F.round(F.col("p95") / 1_000_000, 6).alias("p95_seconds"),
    )


def activity_summary(log: DataFrame) -> DataFrame:
    """One row per activity over all its attempts."""
    failure = F.coalesce(F.col("status_code").isin(FAILED, FAILED_NO_RETRY), F.lit(False))
    return log.groupBy("activity_id").agg(
        rows().alias("attempts"),
        F.min("created_date_time").alias("first_created"),
        F.max("modified_date_time").alias("last_modified"),
        F.bool_or(failure).alias("ever_failed"),
        F.max_by("status_code", "attempt_number").alias("final_status_code"),
        # The newest attempt that has a case: others hold NULL, which max_by passes over.
        F.max_by(
            "crm_case_id", F.when(F.col("crm_case_id").isNotNull(), F.col("attempt_number"))
        ).alias("case_id"),
    )


def status_rollup(log: DataFrame) -> DataFrame:
    """Attempts by status, then agent and prompt version, with subtotals."""
    return log.rollup("status_code", "agent_version", "prompt_version").agg(
        rows().alias("attempts"),
        F.grouping_id().cast("int").alias("level"),
    )


def current_failures(log: DataFrame) -> DataFrame:
    """Activities whose latest attempt failed, with the highest retry limit on record."""
    current = latest_columns(
        log,
        [
            "email_instance_id", "attempt_number", "status_code", "crm_case_id",
            "last_completed_stage", "status_details",
        ],
        [F.max("max_retries").alias("max_retries")],
    )
    return current.filter(F.col("status_code") == FAILED)
