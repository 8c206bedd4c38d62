"""Jobs that change a stored log: checked appends, folded progress, feedback."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.operators.quality import Rule, quarantine
from attemptlog.plans.folds import feedback_flags, stage_fold
from attemptlog.sources import tables

LOG = "email_instance"


def append_checked(df: DataFrame, path: str, rejected: str, rules: Iterable[Rule]) -> None:
    """Append the rows that keep every rule; store the others with the rules they break."""
    good, bad = quarantine(df, list(rules))
    bad.write.mode("append").parquet(rejected)
    tables.append(good, path)


def _rewrite(spark: SparkSession, path: str, after: DataFrame, columns: list[str]) -> None:
    """Replace the days of ``path`` on which ``after`` differs from it in ``columns``."""
    before = tables.scan(spark, path, LOG)
    old = before.select("email_instance_id", *[F.col(c).alias(f"_old_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    changed = after.join(old, "email_instance_id").filter(~same)
    tables.replace_days(tables.rows_of_days(after, changed), path)


def fold_into(spark: SparkSession, path: str, events: DataFrame) -> None:
    """Write stage-completion events into the stored attempts; untouched days stay."""
    after = stage_fold(tables.scan(spark, path, LOG), events)
    _rewrite(spark, path, after, ["last_completed_stage", "status_code", "modified_date_time"])


def flag_feedback(
    spark: SparkSession, path: str, cases: DataFrame, fields: dict[str, str]
) -> None:
    """Set the flag of stored attempts whose case a banker has changed."""
    log = tables.scan(spark, path, LOG)
    after = feedback_flags(log, cases, fields).select(*log.columns)
    _rewrite(spark, path, after, ["banker_modified_flag"])
