"""Table schemas, the older layouts mapped onto them, and insert defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, INT, LONG, BOOLEAN = StringType(), IntegerType(), LongType(), BooleanType()
DOUBLE, SCORE, TIME = DoubleType(), DecimalType(5, 4), TimestampNTZType()

# Columns declared NOT NULL.
REQUIRED = {
    "email_instance": [
        "email_instance_id", "activity_id", "attempt_number", "created_date_time",
        "modified_date_time", "banker_modified_flag",
    ],
    "queue_item": ["queue_item_id", "activity_id", "queue_id"],
    "email_attachment": ["attachment_id", "activity_id"],
    "tracking": ["ActivityId", "CorrelationId", "Status", "RetryCount", "CreatedAt", "UpdatedAt"],
}


def _table(name: str, *columns: tuple) -> StructType:
    """Schema from (column, type[, comment]); required columns are not nullable."""
    required = REQUIRED.get(name, ())
    return StructType(
        [
            StructField(column, kind, column not in required, {"comment": note[0]} if note else {})
            for column, kind, *note in columns
        ]
    )


EMAIL_INSTANCE = _table(
    "email_instance",
    ("email_instance_id", STRING, "primary key, one per attempt"),
    ("activity_id", STRING, "the e-mail, the same over all its attempts"),
    ("attempt_number", INT, "counts up from 1 per activity"),
    ("previous_email_instance_id", STRING, "attempt this one was retried from"),
    ("correlation_id", STRING, "tracing key of older layouts"),
    ("banker_subject", STRING, "subject as pulled for this attempt"),
    ("agent_subject", STRING),
    ("agent_priority_code", INT, "numeric priority of the oldest layout"),
    ("agent_case_priority", STRING),
    ("agent_case_description", STRING),
    ("agent_response", STRING),
    ("agent_action_flag", BOOLEAN),
    ("agent_confidence_score", SCORE),
    ("crm_case_payload", STRING, "JSON"),
    ("crm_case_id", STRING, "set once the case was posted"),
    ("status_code", INT),
    ("last_completed_stage", STRING, "highest stage this attempt completed"),
    ("status_details", STRING, "JSON diagnosis"),
    ("created_date_time", TIME),
    ("modified_date_time", TIME),
    ("case_created_date_time", TIME),
    ("banker_modified_flag", BOOLEAN, "a banker changed the case afterwards"),
    ("error_type", STRING),
    ("max_retries", INT),
    ("crm_received_date_time", TIME),
    ("agent_version", STRING),
    ("taxonomy_version", STRING),
    ("prompt_version", STRING),
    ("agent_name", STRING),
)

QUEUE_ITEM = _table(
    "queue_item",
    ("queue_item_id", STRING, "primary key"),
    ("activity_id", STRING),
    ("item_type", STRING, "gate A2: Email"),
    ("owner_id", STRING, "gate A3: AAB OPS"),
    ("regarding_id", STRING, "gate A4: must be NULL"),
    ("gate_result", STRING),
    ("queue_status_code", STRING),
    ("service_bus_message_id", STRING),
    ("queue_id", STRING),
    ("queue_name", STRING),
    ("worked_by", STRING),
    ("received_date_time", TIME, "released by the CRM"),
    ("enqueued_date_time", TIME, "put on the queue"),
    ("processed_date_time", TIME, "picked up"),
    ("retry_count", INT),
    ("correlation_id", STRING),
)

EMAIL_ATTACHMENT = _table(
    "email_attachment",
    ("attachment_id", STRING, "primary key"),
    ("activity_id", STRING),
    ("file_name", STRING),
    ("content_type", STRING),
    ("dataverse_attachment_ref", STRING, "pointer, never the content"),
)

# What only older layouts have: kept beside the columns of today.
ONLY_OLDER = _table(
    "only_older",
    ("agent_subject_id", STRING),
    ("last_retry_date_time", TIME),
    ("status_text", STRING, "a status that was written as text"),
)

TRACKING = _table(
    "tracking",
    ("ActivityId", STRING, "primary key, one row per e-mail"),
    ("CorrelationId", STRING, "equals ActivityId"),
    ("Status", STRING, "InProgress, Completed or Failed"),
    ("StatusCode", STRING, "detail code of a failure"),
    ("AgentSubjectId", STRING),
    ("AgentSubjectName", STRING),
    ("AgentPriorityCode", INT),
    ("AgentConfidenceScore", SCORE),
    ("CaseId", STRING),
    ("CaseCreatedOn", TIME),
    ("RetryCount", INT),
    ("LastRetryAt", TIME),
    ("CreatedAt", TIME),
    ("UpdatedAt", TIME),
)

EVENTS = _table(
    "events",
    ("event_id", LONG),
    ("ts", TIME),
    ("user_id", LONG),
    ("event_type", STRING),
    ("value", DOUBLE),
    ("props", STRING),
)

TABLES = {
    "email_instance": EMAIL_INSTANCE,
    "queue_item": QUEUE_ITEM,
    "email_attachment": EMAIL_ATTACHMENT,
    "tracking": TRACKING,
}

# NVARCHAR lengths.
LENGTHS = {
    "email_instance": {
        "banker_subject": 500, "agent_subject": 200, "agent_case_priority": 50,
        "last_completed_stage": 50, "error_type": 50, "agent_version": 50,
        "taxonomy_version": 50, "prompt_version": 50, "agent_name": 100,
    },
    "queue_item": {
        "item_type": 50, "owner_id": 100, "queue_name": 256, "worked_by": 512,
        "gate_result": 20, "queue_status_code": 50, "service_bus_message_id": 100,
    },
    "email_attachment": {
        "file_name": 260, "content_type": 100, "dataverse_attachment_ref": 200,
    },
    "tracking": {
        "ActivityId": 50, "CorrelationId": 50, "Status": 20, "StatusCode": 100,
        "AgentSubjectId": 50, "AgentSubjectName": 255, "CaseId": 50,
    },
}

# What an insert fills in for a column it leaves out. 'id' and 'now' stand
# for a new id and the current UTC time.
DEFAULTS = {
    "email_instance": {
        "email_instance_id": "id", "attempt_number": 1, "created_date_time": "now",
        "modified_date_time": "now", "banker_modified_flag": False,
    },
    "legacy": {
        "StatusCode": "Received", "RetryCount": 0, "CreatedDateTime": "now",
        "ModifiedDateTime": "now", "BankerModifiedFlag": False,
    },
    "queue_item": {"gate_result": "Pending", "queue_status_code": "Enqueued", "retry_count": 0},
    "tracking": {"RetryCount": 0, "CreatedAt": "now", "UpdatedAt": "now"},
}


@dataclass(frozen=True)
class Layout:
    """An older table layout: canonical column -> its column there."""

    columns: dict[str, str]
    per_attempt: bool = True
    # How the status is written: 'code', 'name' (ten strings) or 'tracking' (three).
    status: str = "name"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


_SNAKE = {
    **_same(
        "activity_id", "agent_confidence_score", "status_code", "status_details",
        "created_date_time", "modified_date_time", "case_created_date_time",
        "banker_modified_flag",
    ),
    "agent_subject": "classified_subject",
    "agent_case_priority": "priority",
    "agent_case_description": "case_summary",
    "agent_action_flag": "is_actionable",
    "crm_case_payload": "case_payload",
}
_PER_EMAIL = {**_SNAKE, "correlation_id": "correlation_id", "attempt_number": "retry_count"}
_PER_ATTEMPT = {
    **_SNAKE,
    "email_instance_id": "correlation_id",
    "correlation_id": "correlation_id",
    "attempt_number": "attempt_number",
    "banker_subject": "subject",
    "crm_case_id": "case_id",
}
_WITH_STAGE = {
    **_PER_ATTEMPT,
    "previous_email_instance_id": "previous_correlation_id",
    "last_completed_stage": "last_completed_stage",
}


def _pascal(name: str) -> str:
    return "".join(part.capitalize() for part in name.split("_"))


# Columns an older layout of the other tables has, under the names of today; the first one
# writes them in PascalCase.
_FIRST_ITEM = (
    "queue_item_id", "activity_id", "item_type", "owner_id", "regarding_id", "gate_result",
    "queue_status_code", "service_bus_message_id", "received_date_time", "enqueued_date_time",
    "processed_date_time", "retry_count", "correlation_id",
)
_V3_ITEM = tuple(c for c in _FIRST_ITEM if c != "retry_count")
_V4_ITEM = tuple(c for c in _V3_ITEM if c != "correlation_id")
OTHER_LAYOUTS = {
    "queue_item": {
        "v1": {c: _pascal(c) for c in _FIRST_ITEM},
        "sc": _same(*_FIRST_ITEM),
        "v3": _same(*_V3_ITEM),
        "v4": _same(*_V4_ITEM),
        "ddl": _same(*QUEUE_ITEM.names),
    },
    "email_attachment": {
        "v1": {c: _pascal(c) for c in EMAIL_ATTACHMENT.names},
        "ddl": _same(*EMAIL_ATTACHMENT.names),
    },
}

# Six column sets over nine schema versions, oldest first.
LAYOUTS = {
    "tracking": Layout(
        {
            "activity_id": "ActivityId",
            "correlation_id": "CorrelationId",
            "status_code": "Status",
            "error_type": "StatusCode",
            "agent_subject": "AgentSubjectName",
            "agent_subject_id": "AgentSubjectId",
            "last_retry_date_time": "LastRetryAt",
            "agent_priority_code": "AgentPriorityCode",
            "agent_confidence_score": "AgentConfidenceScore",
            "crm_case_id": "CaseId",
            "case_created_date_time": "CaseCreatedOn",
            "attempt_number": "RetryCount",
            "created_date_time": "CreatedAt",
            "modified_date_time": "UpdatedAt",
        },
        per_attempt=False,
        status="tracking",
    ),
    "v1": Layout({c: _pascal(old) for c, old in _PER_EMAIL.items()}, per_attempt=False),
    "sc": Layout(_PER_EMAIL, per_attempt=False),
    "v3": Layout(_PER_EMAIL, per_attempt=False),
    "v4": Layout(_PER_ATTEMPT),
    "v6": Layout(_WITH_STAGE),
    "v7": Layout(_WITH_STAGE),
    "ddl": Layout(
        {c: c for c in EMAIL_INSTANCE.names if c not in ("correlation_id", "agent_priority_code")},
        status="code",
    ),
}
