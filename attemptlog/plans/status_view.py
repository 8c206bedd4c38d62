"""The view callers read: latest attempt per activity with its derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import failed_stage
from attemptlog.functions.stages import resume_stage, skip_queueitem, status_description
from attemptlog.operators.latest import latest_attempt


def with_derived(df: DataFrame, fallback: str = "B1") -> DataFrame:
    """Add the four computed columns; run at write so that filters on them push down."""
    stage = F.col("last_completed_stage")
    return df.withColumns(
        {
            "failed_stage": failed_stage(F.col("status_details")),
            "resume_processing_stage": resume_stage(stage, fallback),
            "skip_queueitem_write": skip_queueitem(stage),
            "status_description": status_description(F.col("status_code")),
        }
    )


def status_view(log: DataFrame) -> DataFrame:
    """Latest attempts, with expressions evaluated on the surviving rows only."""
    return with_derived(latest_attempt(log))
