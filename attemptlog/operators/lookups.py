"""The lookups the log's indexes exist for, as pushed filters and semi-joins.

Lists of ids arrive as DataFrames of any size; Spark broadcasts them only when their
measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import failed_stage
from attemptlog.functions.stages import FAILED, resume_stage


#: Lists up to this length become part of the filter that a stored log is read with.
SHORT = 64
#: Rows of a list that are fetched, without a shuffle, to see whether it is short.
PROBED = 16 * SHORT


def having(df: DataFrame, wanted: DataFrame, short: int = 0) -> DataFrame:
    """Rows whose key is in the list ``wanted``: nothing is shuffled where the list is short.

    Up to ``short`` different keys are fetched first and reach the files of ``df``, where row
    groups without them are skipped; a longer list is told by its first rows, as many as ``PROBED``.
    """
    if short:
        first = wanted.limit(PROBED).collect()
        keys = set(first)
        if len(keys) <= short and len(first) == PROBED:
            keys = set(wanted.distinct().limit(short + 1).collect())
        if len(keys) <= short:
            for c in wanted.columns:
                values = list({k[c] for k in keys} - {None})
                df = df.filter(F.col(c).isin(values) if values else F.lit(False))
            if len(wanted.columns) == 1:
                return df
    return df.join(wanted, wanted.columns, "left_semi")


def attempts_of_activity(log: DataFrame, activities: DataFrame, short: int = 0) -> DataFrame:
    """All attempts of the given activities."""
    return having(log, activities.select("activity_id"), short)


def failed(log: DataFrame) -> DataFrame:
    """Attempts in the failed state."""
    return log.filter(F.col("status_code") == FAILED)


def failed_by_stage_scan(log: DataFrame, stage: str) -> DataFrame:
    """Failed attempts whose document blames ``stage``."""
    return failed(log).filter(failed_stage(F.col("status_details")) == stage)


def resume_scan(log: DataFrame, point: str) -> DataFrame:
    """Failed attempts that would resume at ``point``."""
    return failed(log).filter(resume_stage(F.col("last_completed_stage")) == point)


def correlation_lookup(
    tracking: DataFrame, correlations: DataFrame, short: int = 0
) -> DataFrame:
    """Status, case and creation time by correlation id."""
    wanted = correlations.select("CorrelationId")
    return having(tracking, wanted, short).select(
        "CorrelationId", "Status", "CaseId", "CreatedAt"
    )


def subject_filter(log: DataFrame, pairs: DataFrame, short: int = 0) -> DataFrame:
    """Failed attempts by subject and activity."""
    wanted = pairs.select("banker_subject", "activity_id")
    return having(failed(log), wanted, short)


def lineage_lookup(log: DataFrame, sources: DataFrame, short: int = 0) -> DataFrame:
    """Retries that took their data from the given rows."""
    wanted = sources.select(F.col("email_instance_id").alias("previous_email_instance_id"))
    return having(log.filter("previous_email_instance_id IS NOT NULL"), wanted, short)


def stuck_scan(log: DataFrame, cutoff: str) -> DataFrame:
    """Attempts still in flight that were last touched before ``cutoff``."""
    return log.filter(
        F.col("status_code").isin(1, 2, 3, 4, 5)
        & (F.col("modified_date_time") < F.lit(cutoff).cast("timestamp_ntz"))
    )
