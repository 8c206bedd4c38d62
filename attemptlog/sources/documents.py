"""Diagnostic documents as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import details_typed


def status_details_source(df: DataFrame, key: str, column: str = "status_details") -> DataFrame:
    """Documents of both shapes with their typed members; unreadable ones keep their text."""
    return details_typed(df.filter(F.col(column).isNotNull()), column).select(
        key,
        F.col("details.failed_stage").alias("failed_stage"),
        F.col("details.error_code").alias("error_code"),
        F.col("details.error_message").alias("error_message"),
        F.col("details.http_status").alias("http_status"),
        F.col("details.occurred_at").cast("timestamp_ntz").alias("occurred_at"),
        F.col("details.attempt_number").alias("attempt_number"),
        F.coalesce(F.size("details.attempts"), F.lit(0)).alias("listed_attempts"),
        F.col("details._corrupt").alias("corrupt"),
    )
