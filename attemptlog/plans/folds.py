"""Progress and feedback folded into the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.stages import FAILED, FAILED_NO_RETRY, stage_at, stage_rank, stage_status


def stage_progress(events: DataFrame) -> DataFrame:
    """Highest stage and last time per attempt; fixed-width buffers, merged before the shuffle."""
    return events.groupBy("email_instance_id").agg(
        F.max("stage_rank").alias("stage_rank"), F.max("event_time").alias("event_time")
    )


def stage_fold(log: DataFrame, events: DataFrame) -> DataFrame:
    """The log after its stage-completion events.

    A stage never moves back, the modified time is the latest of both, and a failure
    status stays until a new attempt replaces it.
    """
    progress = stage_progress(events).withColumnRenamed("stage_rank", "_reached")
    reached = F.greatest(stage_rank(F.col("last_completed_stage")), F.col("_reached"))
    failed = F.coalesce(F.col("status_code").isin(FAILED, FAILED_NO_RETRY), F.lit(False))
    return log.join(progress, "email_instance_id", "left").select(
        *[
            {
                "last_completed_stage": stage_at(reached).alias("last_completed_stage"),
                "status_code": F.when(~failed & F.col("_reached").isNotNull(), stage_status(reached))
                .otherwise(F.col("status_code"))
                .alias("status_code"),
                "modified_date_time": F.greatest("modified_date_time", "event_time").alias(
                    "modified_date_time"
                ),
            }.get(c, F.col(c))
            for c in log.columns
        ]
    )


def _per_case(cases: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row per case: how many rows the snapshot has of it, and what its columns span."""
    spans = []
    for theirs in fields.values():
        spans += [
            F.min(theirs).alias(f"_low_{theirs}"),
            F.max(theirs).alias(f"_high_{theirs}"),
            F.count(theirs).alias(f"_known_{theirs}"),
        ]
    return cases.groupBy("crm_case_id").agg(F.count(F.lit(1)).alias("_seen"), *spans)


def _changed(fields: dict[str, str]) -> Column:
    """Some row of the case has another value than the attempt in one of the columns."""
    same = F.lit(True)
    for ours, theirs in fields.items():
        value, known = F.col(ours), F.col(f"_known_{theirs}")
        equal = (known == F.col("_seen")) & (F.col(f"_low_{theirs}") == value) & (
            F.col(f"_high_{theirs}") == value
        )
        same = same & F.when(value.isNull(), known == 0).otherwise(F.coalesce(equal, F.lit(False)))
    return ~same


def feedback_flags(log: DataFrame, cases: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The log with ``banker_modified_flag`` set where the case no longer says the same.

    ``cases`` is keyed by ``crm_case_id``, a case may have several rows; ``fields`` maps log
    columns to case columns. Attempts without a case, or whose case is not in the snapshot,
    keep their flag. ``_changed`` tells what the snapshot itself showed. Attempts without a case, most of
    a log, are not joined: they would meet in one task.
    """
    seen = log.filter("crm_case_id IS NOT NULL").join(_per_case(cases, fields), "crm_case_id", "left")
    changed = F.coalesce(F.col("_seen").isNotNull() & _changed(fields), F.lit(False))
    flag = F.when(changed, F.lit(True)).otherwise(F.col("banker_modified_flag"))
    kept = [c for c in log.columns if c != "banker_modified_flag"]
    own = log.filter("crm_case_id IS NULL").select(*kept, "banker_modified_flag", F.lit(False).alias("_changed"))
    return seen.select(*kept, flag.alias("banker_modified_flag"), changed.alias("_changed")).unionByName(own)


def feedback_detect(log: DataFrame, cases: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Attempts with a case: whether it was changed, and the flag they get."""
    with_case = feedback_flags(log.filter("crm_case_id IS NOT NULL"), cases, fields)
    return with_case.select(
        "email_instance_id",
        "crm_case_id",
        F.col("_changed").alias("changed"),
        "banker_modified_flag",
    )
