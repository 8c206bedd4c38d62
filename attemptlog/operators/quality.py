"""Declared constraints as violation reports.

A CHECK fails only where its predicate is false; unknown passes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.documents import is_json
from attemptlog.functions.stages import (
    GATE_RESULTS,
    QUEUE_STATUSES,
    STAGES,
    STATUS_NAMES,
    TRACKING_STATUSES,
    one_of,
)
from attemptlog.operators.skew import join_unique

# Columns that may never hold raw message content.
RAW_CONTENT_COLUMNS = ("body_html", "body_text", "sender_email", "sender_contact_id")
HTML_TAG = r"<[A-Za-z/!][^>]*>"
MAIL_ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"


@dataclass(frozen=True)
class Rule:
    """A named CHECK on one column."""

    name: str
    column: str
    holds: Column


def status_rule(column: str, allowed: Iterable[str] = STATUS_NAMES) -> Rule:
    return Rule("chk_status", column, one_of(F.col(column), allowed))


def tracking_rule(column: str) -> Rule:
    return status_rule(column, TRACKING_STATUSES)


def stage_rule(column: str) -> Rule:
    return Rule("chk_stage", column, one_of(F.col(column), STAGES))


def json_rule(name: str, column: str) -> Rule:
    return Rule(name, column, is_json(F.col(column)))


def priority_rule(column: str) -> Rule:
    return Rule("chk_priority", column, F.col(column).isin(1, 2, 3))


def gate_rule(column: str) -> Rule:
    return Rule("chk_gate", column, one_of(F.col(column), GATE_RESULTS))


def queue_status_rule(column: str) -> Rule:
    return Rule("chk_queue_status", column, one_of(F.col(column), QUEUE_STATUSES))


def length_rule(column: str, limit: int) -> Rule:
    """NVARCHAR(n): n counts UTF-16 units."""
    units = F.octet_length(F.encode(F.col(column), "UTF-16BE")) / 2
    return Rule("chk_length", column, units <= limit)


def decimal_rule(column: str, precision: int, scale: int) -> Rule:
    """Value fits DECIMAL(precision, scale) after rounding."""
    fits = F.col(column).try_cast(f"decimal({precision},{scale})").isNotNull()
    return Rule("chk_length", column, F.when(F.col(column).isNotNull(), fits))


def failed_rules(rules: Iterable[Rule]) -> Column:
    """Array of (rule, column, value) for the rules a row breaks."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.coalesce(r.holds, F.lit(True)),
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(r.column).alias("column"),
                        F.col(r.column).cast("string").alias("value"),
                    ),
                )
                for r in rules
            ]
        )
    )


def violations(df: DataFrame, key: str, rules: Iterable[Rule]) -> DataFrame:
    """One row per broken rule; all rules are evaluated in one scan."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.explode(failed_rules(rules)).alias("v")
    ).select("v.rule", "key", "v.column", "v.value")


def quarantine(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass every rule, and the rest with the names they break."""
    judged = df.withColumn("broken", F.transform(failed_rules(rules), lambda v: v["rule"]))
    good = judged.filter(F.size("broken") == 0).drop("broken")
    return good, judged.filter(F.size("broken") > 0)


def null_report(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """NULLs per required column in one aggregate pass; a missing column is all NULL."""
    present = {c: F.col(c) if c in df.columns else F.lit(None) for c in required}
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(v.isNull()).alias(c) for c, v in present.items()],
    )
    return counted.unpivot(["rows"], required, "column", "null_rows").select(
        F.lit(table).alias("table"), "column", "null_rows", "rows"
    )


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by several rows; NULL counts as one value, as UNIQUE has it."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def missing_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    return join_unique(
        child.filter(F.col(key).isNotNull()), parent.select(key).distinct(), [key], "left_anti"
    )


def sequence_breaks(log: DataFrame) -> DataFrame:
    """Attempts that do not follow on: a gap before them, or a wrong previous id.

    The attempt before is looked up by (activity, number), which spreads a hot
    activity over all tasks. Of several attempts with one number the lowest id counts, so
    copies do not multiply; both sides come from a shuffle of the join's own, so adaptive
    execution can split a number that has very many copies.
    """
    before = (
        log.groupBy("activity_id", "attempt_number")
        .agg(F.min("email_instance_id").alias("expected_previous_id"))
        .withColumn("attempt_number", F.col("attempt_number") + 1)
    )
    checked = log.select(
        "email_instance_id", "activity_id", "attempt_number", "previous_email_instance_id"
    ).join(before, ["activity_id", "attempt_number"], "left")
    gap = (F.col("attempt_number") != 1) & F.col("expected_previous_id").isNull()
    wrong = ~F.col("previous_email_instance_id").eqNullSafe(F.col("expected_previous_id"))
    return checked.withColumn(
        "problem", F.when(gap, "gap").when(wrong, "lineage")
    ).filter("problem IS NOT NULL")


def raw_content_columns(df: DataFrame) -> list[str]:
    """Columns of a schema that policy forbids."""
    return [c for c in df.columns if c.lower() in RAW_CONTENT_COLUMNS]


def raw_content_rules(column: str) -> list[Rule]:
    """Raw content in text: markup or a mail address."""
    return [
        Rule("raw_html", column, ~F.col(column).rlike(HTML_TAG)),
        Rule("raw_address", column, ~F.col(column).rlike(MAIL_ADDRESS)),
    ]
