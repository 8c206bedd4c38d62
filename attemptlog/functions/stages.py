"""Stage, status and gate rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pipeline stages in order.
STAGES = (
    "B1_write_activity_id",
    "B2_write_queue_item",
    "B4_data_pull_dataverse",
    "B5_parse_email",
    "B6_invoke_agent_workflow",
    "B7_decision",
    "B8_make_payload",
    "B9_post_case_creation",
)
FIRST_STAGE = STAGES[0]

# Text of each numeric status code (7 has none).
STATUS_TEXT = {
    1: "Email received from queue",
    2: "Email data pulled successfully",
    3: "Email data processed",
    4: "AI classification agent invoked",
    5: "Case payload created",
    6: "Case payload posted to CRM",
    8: "No case payload needed",
    9: "Processing failed",
    10: "Failed, no retry attempted",
}
UNKNOWN_STATUS_TEXT = "Unrecognised status code"

# The older textual statuses, for codes 1 to 10 in this order.
STATUS_NAMES = (
    "Received",
    "DataPulled",
    "Processed",
    "AgentInvoked",
    "PayloadCreated",
    "PayloadPosted",
    "CaseCreated",
    "NoCasePayload",
    "Failed",
    "ExitedNoRetry",
)
TRACKING_STATUSES = ("InProgress", "Completed", "Failed")
GATE_RESULTS = ("Pending", "Pass", "Stop")
QUEUE_STATUSES = ("Enqueued", "Released", "WorkedByServiceAccount")
# What the gates ask for.
GATE_ITEM_TYPE = "Email"
GATE_OWNER = "AAB OPS"

RECEIVED, CASE_CREATED, FAILED, FAILED_NO_RETRY = 1, 7, 9, 10

# Status an attempt reaches by completing a stage (our reading of the status texts).
STAGE_STATUS = (1, 1, 2, 3, 4, 4, 5, 6)


def _sql(value: str | int) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _lookup(key: Column, pairs: Iterable[tuple]) -> Column:
    """Value of ``key`` in a literal map, NULL if it has none."""
    entries = ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in pairs)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def fold(text: Column) -> Column:
    """Text as its declared collation compares it: without case and trailing blanks."""
    return F.lower(F.rtrim(text))


def one_of(text: Column, values: Iterable[str]) -> Column:
    """Membership under that collation; NULL for NULL."""
    return fold(text).isin(*[v.lower() for v in values])


def canonical_name(text: Column, values: Iterable[str]) -> Column:
    """The listed spelling of a name, or the text itself if it is none of them.

    Applied once when rows come in, so that everything later compares binary.
    """
    return F.coalesce(_lookup(fold(text), [(v.lower(), v) for v in values]), text)


def status_description(status_code: Column) -> Column:
    """Text of a status code; text codes are cast leniently, anything else is unrecognised."""
    text = _lookup(status_code.try_cast("int"), STATUS_TEXT.items())
    return F.coalesce(text, F.lit(UNKNOWN_STATUS_TEXT))


def resume_stage(stage: Column, fallback: str = "B1") -> Column:
    """Where the next attempt resumes. ``fallback`` is 'B1', or 'B4' for the older rule."""
    return (
        F.when(stage.isin(*STAGES[:4]), "B4")
        .when(stage == STAGES[4], "B7")
        .when(stage == STAGES[5], "B8")
        .when(stage == STAGES[6], "B9")
        .otherwise(fallback)
    )


def skip_queueitem(stage: Column) -> Column:
    """True once the queue item has been written, that is past the first stage."""
    return F.coalesce(stage != FIRST_STAGE, F.lit(False))


def stage_rank(stage: Column) -> Column:
    """Ordinal 1..8 of a stage, NULL for none."""
    return _lookup(stage, [(s, i) for i, s in enumerate(STAGES, 1)])


def stage_at(rank: Column) -> Column:
    """Inverse of ``stage_rank``; NULL outside 1..8."""
    return _lookup(rank, enumerate(STAGES, 1))


def stage_status(rank: Column) -> Column:
    """Status code reached by completing the stage of this rank."""
    return _lookup(rank, enumerate(STAGE_STATUS, 1))


def normalise_stage(stage: Column) -> Column:
    """Drop the dot of spellings like ``B.6_x``."""
    return F.regexp_replace(stage, r"^B\.", "B")


def status_code_of(name: Column) -> Column:
    """Numeric code of a textual status, NULL if it is none of the ten."""
    return _lookup(fold(name), [(s.lower(), i) for i, s in enumerate(STATUS_NAMES, 1)])


def status_name_of(code: Column) -> Column:
    """Textual status of a code, NULL if it has none."""
    return _lookup(code, enumerate(STATUS_NAMES, 1))


def tracking_status(status_code: Column, case_id: Column) -> Column:
    """Collapse to InProgress / Completed / Failed; failure wins over a case id."""
    return (
        F.when(status_code.isin(FAILED, FAILED_NO_RETRY), "Failed")
        .when((status_code == CASE_CREATED) | case_id.isNotNull(), "Completed")
        .otherwise("InProgress")
    )


def gate_failure(item_type: Column, owner_id: Column, regarding_id: Column) -> Column:
    """First failed gate, A2 to A4, or NULL. A missing value fails its gate."""
    return (
        F.when(~F.coalesce(one_of(item_type, [GATE_ITEM_TYPE]), F.lit(False)), "A2")
        .when(~F.coalesce(one_of(owner_id, [GATE_OWNER]), F.lit(False)), "A3")
        .when(regarding_id.isNotNull(), "A4")
    )


def low_confidence(score: Column, threshold: float) -> Column:
    """Score below the threshold; NULL scores stay NULL."""
    return score < F.lit(threshold)


# Carried column -> resume points of the prior attempt that make it reusable.
CARRY = {
    "agent_subject": ("B7", "B8", "B9"),
    "agent_case_priority": ("B7", "B8", "B9"),
    "agent_case_description": ("B7", "B8", "B9"),
    "agent_response": ("B7", "B8", "B9"),
    "agent_action_flag": ("B8", "B9"),
    "agent_confidence_score": ("B7", "B8", "B9"),
    "crm_case_payload": ("B9",),
}


def carry_forward(resume: Column) -> dict[str, Column]:
    """What a retry may reuse of its prior attempt, as named columns."""
    return {
        name: F.when(resume.isin(*points), F.col(name)) for name, points in CARRY.items()
    }
