"""SQL that computes each registered query's rows from the given tables.

Written apart from the DataFrame code where SQL offers another way: join-back for
ranking, correlated lookups for windows, lists for explodes.
"""

from __future__ import annotations

CTES = {
    "keyed": """
SELECT *, CAST(user_id AS VARCHAR)||'-'||CAST(CAST(ts AS DATE) AS VARCHAR) AS activity_id
FROM events""",
    "attempts": """
SELECT event_id AS email_instance_id, activity_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS INT) AS attempt_number,
  LAG(event_id) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS previous_email_instance_id,
  CASE WHEN event_id%50<>0 THEN event_id END AS correlation_id,
  props AS banker_subject,
  'subj_'||CAST(event_id%20 AS VARCHAR) AS agent_subject,
  CASE WHEN event_id%5=0 THEN NULL ELSE CAST(event_id%4 AS INT) END AS agent_priority_code,
  CASE event_id%3 WHEN 0 THEN 'High' WHEN 1 THEN 'Normal' ELSE 'Low' END AS agent_case_priority,
  'case '||CAST(event_id AS VARCHAR) AS agent_case_description,
  '{"r":'||CAST(event_id AS VARCHAR)||'}' AS agent_response,
  event_id%2=0 AS agent_action_flag,
  CAST(CAST(CAST((event_id*37)%10001 AS DOUBLE)/10000 AS DECIMAL(5,4)) AS DOUBLE) AS agent_confidence_score,
  CASE WHEN event_id%13=0 THEN 'not json' ELSE props END AS crm_case_payload,
  CASE WHEN event_type='purchase' THEN event_id+1000000 END AS crm_case_id,
  CAST(CASE event_type WHEN 'error' THEN CASE WHEN event_id%4=0 THEN 10 ELSE 9 END
       WHEN 'purchase' THEN 6 WHEN 'click' THEN 4 ELSE event_id%12 END AS INT) AS status_code,
  CASE event_id%9 WHEN 1 THEN 'B1_write_activity_id' WHEN 2 THEN 'B2_write_queue_item'
    WHEN 3 THEN 'B4_data_pull_dataverse' WHEN 4 THEN 'B5_parse_email'
    WHEN 5 THEN 'B6_invoke_agent_workflow' WHEN 6 THEN 'B7_decision'
    WHEN 7 THEN 'B8_make_payload' WHEN 8 THEN 'B9_post_case_creation' END AS last_completed_stage,
  CASE WHEN event_type='error' THEN CASE
    WHEN event_id%11=0 THEN 'not json'
    WHEN event_id%17=0 THEN '{"attempts":[{"attempt":1,"failed_stage":"B6_invoke_agent_workflow","error_code":"AgentTimeout"},{"attempt":2,"failed_stage":"B9_post_case_creation","error_code":"MuleSoftAuthError"}]}'
    WHEN event_id%7=0 THEN '{"failed_stage":"B.6_invoke_agent_workflow","error_code":"AgentTimeout","http_status":504}'
    WHEN event_id%3=0 THEN '{"failed_stage":"B9_post_case_creation","error_code":"MuleSoftAuthError","http_status":401}'
    ELSE '{"failed_stage":"B6_invoke_agent_workflow","error_code":"AgentTimeout","http_status":504}' END END AS status_details,
  ts AS created_date_time,
  ts + INTERVAL '30' MINUTE AS modified_date_time,
  CASE WHEN event_type='purchase' THEN ts + INTERVAL '45' MINUTE END AS case_created_date_time,
  event_id%10=0 AS banker_modified_flag,
  CAST(3 AS INT) AS max_retries,
  'tax_v'||CAST(event_id%2 AS VARCHAR) AS taxonomy_version,
  'prompt_v'||CAST(user_id%3 AS VARCHAR) AS prompt_version,
  'agent_v'||CAST(user_id%2 AS VARCHAR) AS agent_version
FROM keyed WHERE event_type<>'view'""",
    "queue_items": """
SELECT event_id AS queue_item_id, activity_id, event_type,
  CASE WHEN event_id%5=0 THEN 'PhoneCall' ELSE 'Email' END AS item_type,
  CASE WHEN event_id%4=0 THEN NULL WHEN event_id%7=0 THEN 'OTHER' ELSE 'AAB OPS' END AS owner_id,
  CASE WHEN event_id%3=0 THEN event_id END AS regarding_id,
  'queue_'||CAST(user_id%4 AS VARCHAR) AS queue_name,
  ts AS received_date_time,
  ts + INTERVAL '2' MINUTE AS enqueued_date_time,
  CASE WHEN event_id%6<>0 THEN ts + INTERVAL '5' MINUTE END AS processed_date_time
FROM keyed WHERE event_type IN ('view','click')""",
    "requests": """
SELECT event_id AS request_id, activity_id, props AS banker_subject, ts AS requested_at
FROM keyed WHERE event_type='view'""",
    "attachments": """
SELECT p.page_id AS attachment_id, k.activity_id, p.url AS file_name
FROM pages p JOIN keyed k ON k.event_id = p.page_id*7""",
    "latest": """
SELECT a.* FROM attempts a JOIN (
  SELECT activity_id, MAX(attempt_number) AS top FROM attempts GROUP BY activity_id) m
ON a.activity_id = m.activity_id AND a.attempt_number = m.top""",
    "names": """
SELECT * FROM (VALUES (1,'Received'),(2,'DataPulled'),(3,'Processed'),(4,'AgentInvoked'),
  (5,'PayloadCreated'),(6,'PayloadPosted'),(7,'CaseCreated'),(8,'NoCasePayload'),
  (9,'Failed'),(10,'ExitedNoRetry')) AS t(code, name)""",
    "texts": """
SELECT * FROM (VALUES (1,'Email received from queue'),(2,'Email data pulled successfully'),
  (3,'Email data processed'),(4,'AI classification agent invoked'),(5,'Case payload created'),
  (6,'Case payload posted to CRM'),(8,'No case payload needed'),(9,'Processing failed'),
  (10,'Failed, no retry attempted')) AS t(code, description)""",
    "ranks": """
SELECT * FROM (VALUES (1,'B1_write_activity_id','B4',1),(2,'B2_write_queue_item','B4',1),
  (3,'B4_data_pull_dataverse','B4',2),(4,'B5_parse_email','B4',3),
  (5,'B6_invoke_agent_workflow','B7',4),(6,'B7_decision','B8',4),(7,'B8_make_payload','B9',5),
  (8,'B9_post_case_creation','B1',6)) AS t(rank, stage, resume, status)""",
    # One row per attempt with what the stored computed columns hold.
    "computed": """
SELECT a.*, r.rank, COALESCE(r.resume,'B1') AS resume_processing_stage,
  COALESCE(r.rank > 1, FALSE) AS skip_queueitem_write,
  COALESCE(t.description,'Unrecognised status code') AS status_description,
  CASE WHEN a.details_ok AND json_type(a.status_details,'$.failed_stage')='VARCHAR'
       THEN json_extract_string(a.status_details,'$.failed_stage') END AS failed_stage
FROM (SELECT *, CASE WHEN json_valid(status_details)
        THEN json_type(status_details) IN ('OBJECT','ARRAY') ELSE FALSE END AS details_ok
      FROM attempts) a
LEFT JOIN ranks r ON r.stage = a.last_completed_stage
LEFT JOIN texts t ON t.code = a.status_code""",
    "tracked": """
SELECT l.*, CASE WHEN status_code IN (9,10) THEN 'Failed'
  WHEN status_code = 7 OR crm_case_id IS NOT NULL THEN 'Completed'
  ELSE 'InProgress' END AS tracking_status FROM latest l""",
    "legacy": """
SELECT l.*, COALESCE(n.name,'Bogus') AS status_name
FROM latest l LEFT JOIN names n ON n.code = l.status_code""",
    "prior": """
SELECT l.*, COALESCE(r.resume,'B1') AS resume
FROM latest l LEFT JOIN ranks r ON r.stage = l.last_completed_stage""",
    "written": """
SELECT request_id, q.activity_id, q.k AS request_number,
  CAST(COALESCE(p.attempt_number,0) + q.k AS INT) AS attempt_number,
  {new_id} AS email_instance_id,
  CASE WHEN q.k > 1 THEN {old_id} ELSE CAST(p.email_instance_id AS VARCHAR) END AS previous_email_instance_id,
  q.banker_subject,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_subject END AS agent_subject,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_case_priority END AS agent_case_priority,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_case_description END AS agent_case_description,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_response END AS agent_response,
  CASE WHEN resume IN ('B8','B9') THEN agent_action_flag END AS agent_action_flag,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_confidence_score END AS agent_confidence_score,
  CASE WHEN resume = 'B9' THEN crm_case_payload END AS crm_case_payload,
  CAST(1 AS INT) AS status_code,
  CASE WHEN p.activity_id IS NULL THEN 'B1_write_activity_id' ELSE p.last_completed_stage END AS last_completed_stage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY activity_id ORDER BY requested_at, request_id) AS k
      FROM asked) q
LEFT JOIN prior p ON p.activity_id = q.activity_id""",
    "asked": "SELECT * FROM requests",
    "inserted": """
SELECT w.*, TIMESTAMP '2024-02-01 00:00:00' AS created_date_time,
  TIMESTAMP '2024-02-01 00:00:00' AS modified_date_time, FALSE AS banker_modified_flag,
  CAST(NULL AS VARCHAR) AS failed_stage, COALESCE(r.resume,'B1') AS resume_processing_stage,
  COALESCE(r.rank > 1, FALSE) AS skip_queueitem_write,
  'Email received from queue' AS status_description
FROM written w LEFT JOIN ranks r ON r.stage = w.last_completed_stage""",
    "moves": """
SELECT a.email_instance_id, r.rank AS stage_rank,
  a.created_date_time + r.rank * INTERVAL '1' MINUTE AS event_time
FROM attempts a JOIN ranks own ON own.stage = a.last_completed_stage
JOIN ranks r ON r.rank <= own.rank""",
    "worklist": """
SELECT c.* FROM computed c
JOIN (SELECT activity_id, MAX(attempt_number) AS top, MAX(max_retries) AS allowed
      FROM attempts GROUP BY activity_id) m
ON m.activity_id = c.activity_id AND m.top = c.attempt_number
WHERE c.status_code = 9 AND c.crm_case_id IS NULL
  AND (m.allowed IS NULL OR c.attempt_number <= m.allowed)""",
    "apps": """
SELECT event_id, user_id, n, (event_id + n) % 3 AS s FROM events, (VALUES (1),(2)) AS t(n)""",
}

NEEDS = {
    "attempts": ["keyed"],
    "queue_items": ["keyed"],
    "requests": ["keyed"],
    "attachments": ["keyed"],
    "latest": ["attempts"],
    "computed": ["attempts", "ranks", "texts"],
    "tracked": ["latest"],
    "legacy": ["latest", "names"],
    "prior": ["latest", "ranks"],
    "asked": ["requests"],
    "written": ["asked", "prior"],
    "inserted": ["written", "ranks"],
    "moves": ["attempts", "ranks"],
    "worklist": ["computed"],
}


def named_id(key: str) -> str:
    """GUID-shaped digest of a key expression."""
    digest = f"sha256({key})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "||'-'||".join(f"substr({digest},{at},{size})" for at, size in cuts)


def instance_id(activity: str, attempt: str) -> str:
    return named_id(f"{activity}||'|'||CAST({attempt} AS VARCHAR)")


_NUMBER = "CAST(COALESCE(p.attempt_number,0) + q.k AS INT)"
CTES["written"] = CTES["written"].format(
    new_id=instance_id("q.activity_id", _NUMBER),
    old_id=instance_id("q.activity_id", f"{_NUMBER} - 1"),
)


def with_ctes(body: str, *names: str, **replaced: str) -> str:
    """``body`` after the CTEs it names and all they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS ({replaced.get(n, CTES[n])})" for n in ordered]
    return f"WITH {', '.join(parts)} {body}" if parts else body


ORACLE: dict[str, str] = {}


def add(key: str, body: str, *ctes: str, **replaced: str) -> None:
    ORACLE[key] = with_ctes(body, *ctes, **replaced)


LOG = """activity_id, banker_subject, agent_subject, agent_priority_code,
  agent_case_priority, agent_case_description, agent_response, agent_action_flag,
  agent_confidence_score, crm_case_payload"""
REST = """status_code, last_completed_stage, status_details, created_date_time,
  modified_date_time, case_created_date_time, banker_modified_flag, max_retries,
  taxonomy_version, prompt_version, agent_version"""

# Scans, sources, sinks

add(
    "scan_email_instance",
    f"""SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, attempt_number,
  CAST(previous_email_instance_id AS VARCHAR) AS previous_email_instance_id,
  CAST(correlation_id AS VARCHAR) AS correlation_id, {LOG},
  CAST(crm_case_id AS VARCHAR) AS crm_case_id, {REST},
  CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS TIMESTAMP) AS crm_received_date_time,
  CAST(NULL AS VARCHAR) AS agent_name FROM attempts""",
    "attempts",
)
TRACKING = """
SELECT activity_id AS "ActivityId", activity_id AS "CorrelationId", tracking_status AS "Status",
  CASE WHEN json_valid(status_details) THEN json_extract_string(status_details,'$.error_code') END AS "StatusCode",
  substr(agent_subject, 6) AS "AgentSubjectId", agent_subject AS "AgentSubjectName", agent_priority_code AS "AgentPriorityCode",
  agent_confidence_score AS "AgentConfidenceScore", crm_case_id AS "CaseId",
  case_created_date_time AS "CaseCreatedOn", attempt_number - 1 AS "RetryCount",
  CASE WHEN attempt_number > 1 THEN created_date_time END AS "LastRetryAt",
  created_date_time AS "CreatedAt", modified_date_time AS "UpdatedAt" FROM tracked"""
add("scan_tracking", TRACKING, "tracked")
add(
    "scan_queue_item",
    """SELECT CAST(queue_item_id AS VARCHAR) AS queue_item_id, activity_id, item_type, owner_id,
  CAST(regarding_id AS VARCHAR) AS regarding_id, CAST(NULL AS VARCHAR) AS gate_result,
  CAST(NULL AS VARCHAR) AS queue_status_code, CAST(NULL AS VARCHAR) AS service_bus_message_id,
  CAST(NULL AS VARCHAR) AS queue_id, queue_name, CAST(NULL AS VARCHAR) AS worked_by,
  received_date_time, enqueued_date_time, processed_date_time,
  CAST(NULL AS INT) AS retry_count, CAST(NULL AS VARCHAR) AS correlation_id FROM queue_items""",
    "queue_items",
)
add("scan_email_attachment", "SELECT * FROM attachments", "attachments")
_ID = instance_id("activity_id", "attempt_number")
add(
    "version_union",
    f""", aged AS (SELECT a.*, n.name, a.attempt_number = MAX(a.attempt_number) OVER (PARTITION BY activity_id) AS is_last,
  CASE WHEN created_date_time < TIMESTAMP '2024-01-05' THEN 'tracking'
       WHEN created_date_time < TIMESTAMP '2024-01-09' THEN 'v1'
       WHEN created_date_time < TIMESTAMP '2024-01-13' THEN 'sc'
       WHEN created_date_time < TIMESTAMP '2024-01-17' THEN 'v3'
       WHEN created_date_time < TIMESTAMP '2024-01-21' THEN 'v4'
       WHEN created_date_time < TIMESTAMP '2024-01-24' THEN 'v6'
       WHEN created_date_time < TIMESTAMP '2024-01-27' THEN 'v7' ELSE 'ddl' END AS v
  FROM attempts a LEFT JOIN names n ON n.code = a.status_code)
SELECT v AS schema_version, activity_id, attempt_number,
  CASE WHEN v IN ('tracking','v1','sc','v3') THEN {_ID} ELSE CAST(email_instance_id AS VARCHAR) END AS email_instance_id,
  CASE WHEN v IN ('v6','v7','ddl') THEN CAST(previous_email_instance_id AS VARCHAR) END AS previous_email_instance_id,
  CASE WHEN v = 'tracking' THEN activity_id WHEN v IN ('v1','sc','v3') THEN CAST(correlation_id AS VARCHAR)
       WHEN v <> 'ddl' THEN CAST(email_instance_id AS VARCHAR) END AS correlation_id,
  CASE WHEN v IN ('v4','v6','v7','ddl') THEN banker_subject END AS banker_subject,
  agent_subject,
  CASE WHEN v <> 'tracking' THEN agent_case_priority END AS agent_case_priority,
  CASE WHEN v = 'tracking' THEN agent_priority_code END AS agent_priority_code,
  agent_confidence_score,
  CASE WHEN v NOT IN ('v1','sc','v3') THEN CAST(crm_case_id AS VARCHAR) END AS crm_case_id,
  CAST(CASE WHEN v = 'ddl' THEN status_code
       WHEN v = 'tracking' THEN CASE WHEN status_code IN (9,10) THEN 9
            WHEN status_code = 7 OR crm_case_id IS NOT NULL THEN 7 ELSE 1 END
       WHEN name IS NOT NULL THEN status_code END AS INT) AS status_code,
  CASE WHEN v IN ('v6','v7','ddl') THEN last_completed_stage END AS last_completed_stage,
  created_date_time, modified_date_time, case_created_date_time,
  CASE WHEN v <> 'tracking' THEN banker_modified_flag END AS banker_modified_flag,
  CASE WHEN v = 'tracking' AND json_valid(status_details) THEN json_extract_string(status_details,'$.error_code') END AS error_type,
  CASE WHEN v = 'ddl' THEN max_retries END AS max_retries,
  CASE WHEN v = 'ddl' THEN agent_version END AS agent_version,
  CASE WHEN v = 'tracking' THEN substr(agent_subject, 6) END AS agent_subject_id,
  CASE WHEN v = 'tracking' AND attempt_number > 1 THEN created_date_time END AS last_retry_date_time,
  CASE WHEN v = 'tracking' THEN CASE WHEN status_code IN (9,10) THEN 'Failed'
            WHEN status_code = 7 OR crm_case_id IS NOT NULL THEN 'Completed' ELSE 'InProgress' END
       WHEN v <> 'ddl' THEN COALESCE(name, 'Bogus') END AS status_text
FROM aged WHERE is_last OR v IN ('v4','v6','v7','ddl')""",
    "attempts",
    "names",
)
add(
    "queue_item_union",
    """SELECT CASE event_id % 5 WHEN 0 THEN 'v1' WHEN 1 THEN 'sc' WHEN 2 THEN 'v3' WHEN 3 THEN 'v4'
    ELSE 'ddl' END AS schema_version, CAST(queue_item_id AS VARCHAR) AS queue_item_id, activity_id,
  item_type, owner_id, CAST(regarding_id AS VARCHAR) AS regarding_id,
  CASE WHEN event_id % 5 = 4 THEN queue_name END AS queue_name,
  received_date_time, enqueued_date_time, processed_date_time
FROM (SELECT *, queue_item_id AS event_id FROM queue_items)""",
    "queue_items",
)
add(
    "attachment_union",
    """SELECT CASE attachment_id % 2 WHEN 0 THEN 'v1' ELSE 'ddl' END AS schema_version,
  CAST(attachment_id AS VARCHAR) AS attachment_id, activity_id, file_name FROM attachments""",
    "attachments",
)
add(
    "apply_defaults",
    f"""SELECT request_id, activity_id, banker_subject,
  {named_id("CAST(request_id AS VARCHAR)")} AS email_instance_id,
  CAST(1 AS INT) AS attempt_number, TIMESTAMP '2024-02-01 00:00:00' AS created_date_time,
  TIMESTAMP '2024-02-01 00:00:00' AS modified_date_time, FALSE AS banker_modified_flag
FROM requests""",
    "requests",
)
INSERTED = """SELECT email_instance_id, activity_id, attempt_number, previous_email_instance_id,
  banker_subject, agent_subject, agent_action_flag, crm_case_payload, status_code,
  last_completed_stage, created_date_time, modified_date_time, banker_modified_flag,
  failed_stage, resume_processing_stage, skip_queueitem_write, status_description FROM inserted"""
add("insert_first", f"{INSERTED} WHERE attempt_number = 1", "inserted")
add("insert_retry", f"{INSERTED} WHERE attempt_number > 1", "inserted")
add(
    "insert_returning",
    "SELECT request_id, email_instance_id, skip_queueitem_write FROM inserted",
    "inserted",
)
_ITEMS = f"""DISTINCT {named_id("'queue_item|'||i.activity_id")} AS queue_item_id,
  i.activity_id, attempt_number, 'queue_'||CAST(e.user_id%4 AS VARCHAR) AS queue_id,
  'Pending' AS gate_result, 'Enqueued' AS queue_status_code
FROM inserted i JOIN events e ON e.event_id = i.request_id
WHERE NOT skip_queueitem_write AND request_number = 1
  AND NOT EXISTS (SELECT 1 FROM queue_items q WHERE q.activity_id = i.activity_id
                  AND q.received_date_time < TIMESTAMP '2024-01-15')"""
add(
    "queue_item_write",
    f"""SELECT {_ITEMS}""",
    "inserted",
    "queue_items",
)
add(
    "written_items_not_null",
    "SELECT 'queue_item' AS \"table\", c AS \"column\", CAST(0 AS BIGINT) AS null_rows"
    " FROM (VALUES ('queue_item_id'), ('activity_id'), ('queue_id')) AS t(c)",
)
add(
    "status_details_source",
    """, d AS (SELECT email_instance_id, status_details, json_valid(status_details) AS ok,
    CASE WHEN json_valid(status_details) THEN status_details END AS j
  FROM attempts WHERE status_details IS NOT NULL)
SELECT email_instance_id, json_extract_string(j,'$.failed_stage') AS failed_stage,
  json_extract_string(j,'$.error_code') AS error_code,
  json_extract_string(j,'$.error_message') AS error_message,
  CAST(json_extract_string(j,'$.http_status') AS INT) AS http_status,
  CAST(json_extract_string(j,'$.occurred_at') AS TIMESTAMP) AS occurred_at,
  CAST(json_extract_string(j,'$.attempt_number') AS INT) AS attempt_number,
  CAST(COALESCE(json_array_length(j,'$.attempts'),0) AS INT) AS listed_attempts,
  CASE WHEN NOT ok THEN status_details END AS corrupt FROM d""",
    "attempts",
)

# Projections

add("status_description", "SELECT email_instance_id, status_description FROM computed", "computed")
add(
    "resume_stage",
    """SELECT email_instance_id, resume_processing_stage,
  CASE WHEN rank IS NULL OR rank = 8 THEN 'B4' ELSE resume_processing_stage END
    AS resume_processing_stage_v6 FROM computed""",
    "computed",
)
add("skip_queueitem", "SELECT email_instance_id, skip_queueitem_write FROM computed", "computed")
add("failed_stage", "SELECT email_instance_id, failed_stage FROM computed", "computed")
add(
    "failed_stage_norm",
    """SELECT email_instance_id, CASE WHEN failed_stage LIKE 'B.%' THEN 'B'||substr(failed_stage,3)
  ELSE failed_stage END AS failed_stage_norm FROM computed""",
    "computed",
)
add("stage_rank", "SELECT email_instance_id, rank AS stage_rank FROM computed", "computed")
add(
    "carry_forward",
    """SELECT email_instance_id, resume_processing_stage AS resume,
  CASE WHEN rank BETWEEN 5 AND 7 THEN agent_subject END AS agent_subject,
  CASE WHEN rank BETWEEN 5 AND 7 THEN agent_case_priority END AS agent_case_priority,
  CASE WHEN rank BETWEEN 5 AND 7 THEN agent_case_description END AS agent_case_description,
  CASE WHEN rank BETWEEN 5 AND 7 THEN agent_response END AS agent_response,
  CASE WHEN rank IN (6,7) THEN agent_action_flag END AS agent_action_flag,
  CASE WHEN rank BETWEEN 5 AND 7 THEN agent_confidence_score END AS agent_confidence_score,
  CASE WHEN rank = 7 THEN crm_case_payload END AS crm_case_payload FROM computed""",
    "computed",
)
add(
    "status_map",
    """SELECT activity_id AS "ActivityId", status_name AS "StatusCode",
  CASE WHEN status_name <> 'Bogus' THEN l.status_code END AS status_code FROM legacy l""",
    "legacy",
)
add(
    "tracking_status",
    """SELECT email_instance_id, CASE WHEN status_code IN (9,10) THEN 'Failed'
  WHEN status_code = 7 OR crm_case_id IS NOT NULL THEN 'Completed' ELSE 'InProgress' END
  AS tracking_status FROM attempts""",
    "attempts",
)
GATED = """
SELECT *, CASE WHEN COALESCE(item_type,'') <> 'Email' THEN 'A2'
  WHEN COALESCE(owner_id,'') <> 'AAB OPS' THEN 'A3'
  WHEN regarding_id IS NOT NULL THEN 'A4' END AS gate_failed FROM queue_items"""
add(
    "gate_eval",
    f"""SELECT queue_item_id, gate_failed,
  CASE WHEN gate_failed IS NULL THEN 'Pass' ELSE 'Stop' END AS gate_result FROM ({GATED})""",
    "queue_items",
)
add(
    "low_confidence",
    "SELECT email_instance_id, agent_confidence_score < 0.25 AS low_confidence FROM attempts",
    "attempts",
)

# Filters

add(
    "attempts_of_activity",
    """SELECT email_instance_id, activity_id, attempt_number FROM attempts
WHERE activity_id IN (SELECT activity_id FROM requests)""",
    "attempts",
    "requests",
)
add(
    "failed_scan",
    """SELECT activity_id, status_code, attempt_number - 1 AS retry_count, modified_date_time
FROM attempts WHERE status_code = 9""",
    "attempts",
)
add(
    "failed_by_stage_scan",
    """SELECT email_instance_id, activity_id FROM computed
WHERE status_code = 9 AND failed_stage = 'B6_invoke_agent_workflow'""",
    "computed",
)
add(
    "resume_scan",
    """SELECT email_instance_id, activity_id, last_completed_stage FROM computed
WHERE status_code = 9 AND resume_processing_stage = 'B4'""",
    "computed",
)
add(
    "correlation_lookup",
    """SELECT activity_id AS "CorrelationId", tracking_status AS "Status", crm_case_id AS "CaseId",
  created_date_time AS "CreatedAt" FROM tracked
WHERE activity_id IN (SELECT activity_id FROM requests)""",
    "tracked",
    "requests",
)
AUDIT = """SELECT activity_id AS "ActivityId", created_date_time AS "CreatedAt",
  tracking_status AS "Status", crm_case_id AS "CaseId", activity_id AS "CorrelationId"
FROM tracked WHERE created_date_time >= TIMESTAMP '2024-01-10'
  AND created_date_time < TIMESTAMP '2024-01-12'
ORDER BY created_date_time DESC, activity_id DESC"""
add("audit_range", AUDIT, "tracked")
add("audit_page", f"{AUDIT} LIMIT 100", "tracked")
add(
    "subject_filter",
    """SELECT email_instance_id, activity_id, banker_subject FROM attempts a
WHERE status_code = 9 AND EXISTS (
  SELECT 1 FROM keyed k WHERE k.activity_id = a.activity_id AND k.props = a.banker_subject
    AND k.event_type IN ('view','purchase'))""",
    "attempts",
)
add(
    "lineage_lookup",
    """SELECT a.email_instance_id, a.previous_email_instance_id FROM attempts a
JOIN attempts p ON p.email_instance_id = a.previous_email_instance_id WHERE p.status_code = 9""",
    "attempts",
)
add(
    "stuck_scan",
    """SELECT email_instance_id, status_code, modified_date_time FROM attempts
WHERE status_code BETWEEN 1 AND 5 AND modified_date_time < TIMESTAMP '2024-01-15'""",
    "attempts",
)

# Data-quality rules

add(
    "chk_status",
    """SELECT 'chk_status' AS rule, activity_id AS key, 'StatusCode' AS "column", status_name AS value
FROM legacy WHERE status_name NOT IN (SELECT name FROM names)""",
    "legacy",
)
add(
    "chk_stage",
    """SELECT 'chk_stage' AS rule, CAST(email_instance_id AS VARCHAR) AS key, 'stage' AS "column",
  failed_stage AS value FROM computed c
WHERE failed_stage IS NOT NULL AND failed_stage NOT IN (SELECT stage FROM ranks)
UNION ALL SELECT 'chk_stage', CAST(email_instance_id AS VARCHAR), 'last_completed_stage',
  'B.'||substr(last_completed_stage, 2) FROM computed
WHERE email_instance_id % 9 = 5 AND last_completed_stage IS NOT NULL""",
    "computed",
)


def not_json(key: str, column: str) -> None:
    add(
        key,
        f"""SELECT '{key}' AS rule, CAST(email_instance_id AS VARCHAR) AS key,
  '{column}' AS "column", {column} AS value FROM attempts
WHERE {column} IS NOT NULL AND NOT CASE WHEN json_valid({column})
  THEN json_type({column}) IN ('OBJECT','ARRAY') ELSE FALSE END""",
        "attempts",
    )


not_json("chk_details_json", "status_details")
not_json("chk_payload_json", "crm_case_payload")
add(
    "chk_priority",
    """SELECT 'chk_priority' AS rule, CAST(email_instance_id AS VARCHAR) AS key,
  'agent_priority_code' AS "column", CAST(agent_priority_code AS VARCHAR) AS value
FROM attempts WHERE agent_priority_code NOT IN (1,2,3)""",
    "attempts",
)
add(
    "chk_gate",
    f"""SELECT 'chk_gate' AS rule, CAST(queue_item_id AS VARCHAR) AS key,
  'gate_result' AS "column", gate_failed AS value FROM ({GATED}) WHERE gate_failed IS NOT NULL""",
    "queue_items",
)
add(
    "chk_queue_status",
    """SELECT 'chk_queue_status' AS rule, CAST(queue_item_id AS VARCHAR) AS key,
  'queue_status_code' AS "column", 'Processed' AS value FROM queue_items
WHERE processed_date_time IS NOT NULL AND owner_id <> 'AAB OPS'""",
    "queue_items",
)


def null_counts(table: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{c}' AS "column",
  COUNT(*) - COUNT({'NULL' if c == 'queue_id' else c}) AS null_rows, COUNT(*) AS "rows"
FROM {source}"""
        for c in columns
    )


add(
    "chk_not_null",
    null_counts(
        "email_instance",
        "attempts",
        ["email_instance_id", "activity_id", "attempt_number", "created_date_time",
         "modified_date_time", "banker_modified_flag"],
    )
    + " UNION ALL "
    + null_counts("queue_item", "queue_items", ["queue_item_id", "activity_id", "queue_id"]),
    "attempts",
    "queue_items",
)
add(
    "chk_pk",
    """SELECT email_instance_id, 2::BIGINT AS "rows" FROM attempts WHERE email_instance_id % 6 = 1""",
    "attempts",
)
add(
    "chk_activity_attempt",
    """SELECT l_orderkey AS activity_id, l_linenumber AS attempt_number, COUNT(*) AS "rows"
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
add(
    "chk_correlation",
    """SELECT correlation_id, COUNT(*) AS "rows" FROM attempts
GROUP BY correlation_id HAVING COUNT(*) > 1""",
    "attempts",
)
add(
    "chk_fk_queue",
    """SELECT queue_item_id, activity_id FROM queue_items
WHERE activity_id NOT IN (SELECT activity_id FROM attempts)""",
    "queue_items",
    "attempts",
)
add(
    "chk_fk_attachment",
    """SELECT attachment_id, activity_id, file_name FROM attachments
WHERE activity_id NOT IN (SELECT activity_id FROM attempts)""",
    "attachments",
    "attempts",
)
_UNITS = r"length({c}) + length(regexp_replace({c}, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g'))"
add(
    "chk_length",
    f"""SELECT 'chk_length' AS rule, CAST(doc_id AS VARCHAR) AS key, 'banker_subject' AS "column"
FROM documents WHERE {_UNITS.format(c='text')} > 500
UNION ALL SELECT 'chk_length', CAST(doc_id AS VARCHAR), 'agent_version'
FROM documents WHERE {_UNITS.format(c='source')} > 50
UNION ALL SELECT 'chk_length', CAST(event_id AS VARCHAR), 'agent_confidence_score'
FROM events WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(5,4)) IS NULL""",
)
add(
    "chk_sequence",
    """, changed AS (SELECT email_instance_id, activity_id,
    CAST(attempt_number + CASE WHEN email_instance_id % 7 = 0 THEN 1000 ELSE 0 END AS INT) AS attempt_number,
    CASE WHEN email_instance_id % 11 <> 0 THEN previous_email_instance_id END AS previous
  FROM attempts),
judged AS (SELECT *, (SELECT MIN(b.email_instance_id) FROM changed b
    WHERE b.activity_id = c.activity_id AND b.attempt_number = c.attempt_number - 1) AS wanted
  FROM changed c)
SELECT email_instance_id, activity_id, attempt_number,
  CASE WHEN attempt_number <> 1 AND wanted IS NULL THEN 'gap' ELSE 'lineage' END AS problem
FROM judged WHERE (attempt_number <> 1 AND wanted IS NULL) OR previous IS DISTINCT FROM wanted""",
    "attempts",
)
add(
    "chk_raw_content",
    """, texts_ AS (SELECT 'document-'||CAST(doc_id AS VARCHAR) AS key, text AS content FROM documents
  UNION ALL SELECT 'page-'||CAST(page_id AS VARCHAR), html FROM pages)
SELECT 'raw_html' AS rule, key FROM texts_ WHERE regexp_matches(content, '<[A-Za-z/!][^>]*>')
UNION ALL SELECT 'raw_address', key FROM texts_
WHERE regexp_matches(content, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\\.[A-Za-z0-9.-]+')""",
    "keyed",
)
add(
    "quarantine",
    """, judged AS (SELECT email_instance_id,
  CASE WHEN status_details = 'not json' THEN 'chk_details_json' END AS a,
  CASE WHEN crm_case_payload = 'not json' THEN 'chk_payload_json' END AS b,
  CASE WHEN agent_priority_code = 0 THEN 'chk_priority' END AS c FROM attempts)
SELECT email_instance_id, concat_ws(',', a, b, c) AS broken FROM judged
WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL""",
    "attempts",
)

# Joins

add("latest_join", "SELECT * FROM latest", "latest")
add(
    "route_requests",
    """SELECT request_id, activity_id, banker_subject, requested_at,
  CASE WHEN EXISTS (SELECT 1 FROM attempts a WHERE a.activity_id = r.activity_id)
       THEN 'retry' ELSE 'first' END AS route FROM requests r""",
    "requests",
    "attempts",
)
add(
    "request_prior",
    """SELECT request_id, r.activity_id, p.email_instance_id AS prior_email_instance_id,
  p.attempt_number AS prior_attempt_number, p.last_completed_stage AS prior_last_completed_stage
FROM requests r LEFT JOIN prior p ON p.activity_id = r.activity_id""",
    "requests",
    "prior",
)
add(
    "orphans",
    "SELECT activity_id FROM queue_items EXCEPT SELECT activity_id FROM attempts",
    "queue_items",
    "attempts",
)
add(
    "lineage_parent",
    """SELECT a.email_instance_id, a.previous_email_instance_id,
  p.attempt_number AS parent_attempt_number, p.status_code AS parent_status_code,
  p.last_completed_stage AS parent_stage
FROM attempts a LEFT JOIN attempts p ON p.email_instance_id = a.previous_email_instance_id""",
    "attempts",
)
ORACLE["lineage_chain"] = (
    with_ctes("", "attempts").replace("WITH ", "WITH RECURSIVE ", 1)
    + """, chain AS (
  SELECT email_instance_id, email_instance_id AS root, CAST(1 AS BIGINT) AS depth
  FROM attempts WHERE previous_email_instance_id IS NULL
  UNION ALL
  SELECT a.email_instance_id, c.root, c.depth + 1 FROM attempts a
  JOIN chain c ON c.email_instance_id = a.previous_email_instance_id)
SELECT email_instance_id, root AS root_email_instance_id, depth FROM chain"""
)
add(
    "lineage_chain_clean",
    """SELECT email_instance_id, first_value(email_instance_id) OVER (
  PARTITION BY activity_id ORDER BY attempt_number) AS root_email_instance_id,
  CAST(attempt_number AS BIGINT) AS depth FROM attempts""",
    "attempts",
)
add(
    "queue_latest",
    """SELECT queue_item_id, q.activity_id, l.email_instance_id, l.attempt_number, l.status_code,
  l.last_completed_stage FROM queue_items q LEFT JOIN latest l ON l.activity_id = q.activity_id""",
    "queue_items",
    "latest",
)
add(
    "attachment_latest",
    """SELECT f.activity_id, COUNT(*) AS attachments, MIN(file_name) AS first_file_name,
  ANY_VALUE(l.email_instance_id) AS email_instance_id,
  ANY_VALUE(l.attempt_number) AS attempt_number, ANY_VALUE(l.status_code) AS status_code
FROM attachments f LEFT JOIN latest l ON l.activity_id = f.activity_id GROUP BY f.activity_id""",
    "attachments",
    "latest",
)

# Aggregations

add(
    "max_attempt",
    """SELECT activity_id, CAST(COUNT(*) AS INT) AS max_attempt_number FROM attempts
GROUP BY activity_id""",
    "attempts",
)
add(
    "retry_counts",
    """SELECT CAST(attempt_number - 1 AS BIGINT) AS retries, COUNT(*) AS activities FROM latest
GROUP BY attempt_number""",
    "latest",
)
add(
    "failed_by_stage",
    """SELECT replace(failed_stage,'B.','B') AS failed_stage, COUNT(*) AS attempts FROM computed
WHERE status_code = 9 GROUP BY 1""",
    "computed",
)
add(
    "failed_by_resume",
    """SELECT resume_processing_stage, COUNT(*) AS attempts FROM computed WHERE status_code = 9
GROUP BY 1""",
    "computed",
)
add(
    "status_counts",
    """SELECT l.status_code, COUNT(*) AS activities,
  COALESCE(MIN(t.description),'Unrecognised status code') AS status_description
FROM latest l LEFT JOIN texts t ON t.code = l.status_code GROUP BY l.status_code""",
    "latest",
    "texts",
)
add(
    "failure_codes",
    """, d AS (SELECT CASE WHEN json_valid(status_details) THEN status_details END AS j
  FROM attempts WHERE status_details IS NOT NULL)
SELECT json_extract_string(j,'$.error_code') AS error_code,
  CAST(json_extract_string(j,'$.http_status') AS INT) AS http_status,
  replace(json_extract_string(j,'$.failed_stage'),'B.','B') AS failed_stage,
  COUNT(*) AS attempts FROM d GROUP BY 1,2,3""",
    "attempts",
)
add(
    "banker_modified_rate",
    """SELECT COUNT(*) AS cases,
  ROUND(COUNT(*) FILTER (banker_modified_flag) / CAST(COUNT(*) AS DOUBLE), 6) AS modified_rate
FROM attempts WHERE crm_case_id IS NOT NULL""",
    "attempts",
)
add(
    "version_quality",
    """SELECT agent_version, prompt_version, taxonomy_version, COUNT(*) AS attempts,
  ROUND(AVG(agent_confidence_score),6) AS confidence_mean,
  ROUND(quantile_cont(agent_confidence_score,0.5),6) AS confidence_p50,
  ROUND(quantile_cont(agent_confidence_score,0.95),6) AS confidence_p95,
  ROUND(AVG(CASE WHEN status_code IN (9,10) THEN 1.0 ELSE 0.0 END),6) AS failure_rate,
  ROUND(AVG(CASE WHEN banker_modified_flag THEN 1.0 ELSE 0.0 END),6) AS modified_rate
FROM attempts GROUP BY 1,2,3""",
    "attempts",
)
add(
    "time_to_case",
    """, spans AS (SELECT date_diff('microsecond', MIN(created_date_time), MIN(case_created_date_time)) AS us
  FROM attempts GROUP BY activity_id)
SELECT COUNT(us) AS cases, ROUND(quantile_cont(us,0.5)/1000000,6) AS p50_seconds,
  ROUND(quantile_cont(us,0.95)/1000000,6) AS p95_seconds FROM spans""",
    "attempts",
)
add(
    "queue_latency",
    """, legs AS (SELECT queue_name, 'received_to_enqueued' AS leg,
    date_diff('microsecond', received_date_time, enqueued_date_time) AS us FROM queue_items
  UNION ALL SELECT queue_name, 'enqueued_to_processed',
    date_diff('microsecond', enqueued_date_time, processed_date_time) FROM queue_items)
SELECT queue_name, leg, COUNT(us) AS items, ROUND(quantile_cont(us,0.5)/1000000,6) AS p50_seconds,
  ROUND(quantile_cont(us,0.95)/1000000,6) AS p95_seconds FROM legs GROUP BY queue_name, leg""",
    "queue_items",
)
add(
    "activity_summary",
    """SELECT activity_id, COUNT(*) AS attempts, MIN(created_date_time) AS first_created,
  MAX(modified_date_time) AS last_modified, BOOL_OR(status_code IN (9,10)) AS ever_failed,
  arg_max(status_code, attempt_number) AS final_status_code, arg_max(crm_case_id, attempt_number) FILTER (crm_case_id IS NOT NULL) AS case_id
FROM attempts GROUP BY activity_id""",
    "attempts",
)
add(
    "status_rollup",
    """SELECT status_code, agent_version, prompt_version, COUNT(*) AS attempts, CAST(0 AS INT) AS level
FROM attempts GROUP BY 1,2,3
UNION ALL SELECT status_code, agent_version, NULL, COUNT(*), 1 FROM attempts GROUP BY 1,2
UNION ALL SELECT status_code, NULL, NULL, COUNT(*), 3 FROM attempts GROUP BY 1
UNION ALL SELECT NULL, NULL, NULL, COUNT(*), 7 FROM attempts""",
    "attempts",
)

# Ordering

add("latest_attempt", "SELECT * FROM latest", "latest")
add(
    "attempt_history",
    """SELECT activity_id, email_instance_id, attempt_number, created_date_time,
  ROW_NUMBER() OVER (PARTITION BY activity_id ORDER BY created_date_time DESC, attempt_number DESC)
  AS recency FROM attempts""",
    "attempts",
)
add(
    "retry_gap",
    """SELECT a.email_instance_id, a.activity_id, a.attempt_number,
  date_diff('microsecond', p.created_date_time, a.created_date_time) / 1000000.0 AS gap_seconds
FROM attempts a LEFT JOIN attempts p
  ON p.activity_id = a.activity_id AND p.attempt_number = a.attempt_number - 1""",
    "attempts",
)
add(
    "last_retry",
    """SELECT activity_id, attempt_number AS attempts, created_date_time AS last_retry_date_time
FROM latest WHERE attempt_number > 1""",
    "latest",
)
add(
    "assign_attempts",
    "SELECT request_id, activity_id, request_number, attempt_number FROM written",
    "written",
)
add(
    "top_one",
    """SELECT 'copy-'||CAST(email_instance_id AS VARCHAR) AS email_instance_id, activity_id,
  attempt_number, created_date_time FROM attempts WHERE activity_id = '7-2024-01-05'
ORDER BY attempt_number DESC LIMIT 1""",
    "attempts",
)

# Documents

add(
    "json_value",
    """, d AS (SELECT email_instance_id, CASE WHEN json_valid(status_details) THEN status_details END AS j
  FROM attempts)
SELECT email_instance_id, json_extract_string(j,'$.error_code') AS error_code,
  json_extract_string(j,'$.http_status') AS http_status, CAST(NULL AS VARCHAR) AS attempts,
  json_extract_string(j,'$.attempts[1].error_code') AS second_code FROM d""",
    "attempts",
)
add(
    "is_json",
    """SELECT email_instance_id,
  CASE WHEN status_details IS NOT NULL THEN status_details <> 'not json' END AS details_is_json,
  crm_case_payload <> 'not json' AS payload_is_json, json_valid(agent_subject) AS subject_is_json
FROM attempts""",
    "attempts",
)
add(
    "try_cast_status",
    """, s AS (SELECT a.email_instance_id, CASE WHEN a.agent_action_flag
    THEN COALESCE(n.name, CAST(a.status_code AS VARCHAR)) ELSE CAST(a.status_code AS VARCHAR) END AS status_text
  FROM attempts a LEFT JOIN names n ON n.code = a.status_code)
SELECT email_instance_id, status_text, TRY_CAST(status_text AS INT) AS status_code,
  COALESCE(t.description,'Unrecognised status code') AS status_description
FROM s LEFT JOIN texts t ON t.code = TRY_CAST(status_text AS INT)""",
    "attempts",
    "names",
    "texts",
)
add(
    "json_project",
    """SELECT event_id, 'app-'||event_id||'-'||n AS "Name", 'rg-'||user_id AS "ResourceGroup",
  CASE WHEN s = 0 THEN 'Stopped' ELSE 'Running' END AS "State", 'loc-'||(user_id % 5) AS "Location"
FROM apps""",
    "apps",
)
add(
    "json_path_by_kind",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '3.'||(event_id % 4 + 9)
  ELSE 'PYTHON|3.'||(event_id % 3 + 8) END AS runtime_version FROM events""",
)
add(
    "details_typed",
    """, d AS (SELECT email_instance_id, CASE WHEN json_valid(status_details) THEN status_details END AS j
  FROM attempts WHERE status_details IS NOT NULL)
SELECT email_instance_id, json_extract_string(j,'$.failed_stage') AS failed_stage,
  json_extract_string(j,'$.error_code') AS error_code,
  CAST(json_extract_string(j,'$.http_status') AS INT) AS http_status FROM d""",
    "attempts",
)
add(
    "status_details_rows",
    """, d AS (SELECT email_instance_id, status_details AS j FROM attempts WHERE json_valid(status_details)),
many AS (SELECT email_instance_id, unnest(json_extract(j,'$.attempts[*]')) AS f FROM d)
SELECT email_instance_id, CAST(json_extract_string(f,'$.attempt') AS INT) AS attempt,
  json_extract_string(f,'$.failed_stage') AS failed_stage,
  json_extract_string(f,'$.error_code') AS error_code, CAST(NULL AS INT) AS http_status FROM many
UNION ALL SELECT email_instance_id, NULL, replace(json_extract_string(j,'$.failed_stage'),'B.','B'),
  json_extract_string(j,'$.error_code'), CAST(json_extract_string(j,'$.http_status') AS INT)
FROM d WHERE json_extract(j,'$.attempts') IS NULL""",
    "attempts",
)

# Jobs

WRITTEN = """SELECT request_id, email_instance_id, activity_id, attempt_number,
  previous_email_instance_id, banker_subject, agent_subject, agent_case_priority,
  agent_case_description, agent_response, agent_action_flag, agent_confidence_score,
  crm_case_payload, status_code, last_completed_stage FROM written"""
add("b1_write", WRITTEN, "written")
add("b1_write_other_case", WRITTEN, "written")
add(
    "recovery_worklist",
    """SELECT activity_id, email_instance_id, attempt_number, resume_processing_stage,
  skip_queueitem_write, failed_stage FROM worklist""",
    "worklist",
)
add(
    "recovery_retry",
    WRITTEN,
    "requests",
    "worklist",
    "written",
    asked="""SELECT CAST(w.email_instance_id AS VARCHAR) AS request_id, w.activity_id,
  (SELECT MAX(banker_subject) FROM requests r WHERE r.activity_id = w.activity_id) AS banker_subject,
  TIMESTAMP '2024-02-01 00:00:00' AS requested_at FROM worklist w""",
)
add(
    "stage_fold",
    """SELECT email_instance_id, last_completed_stage,
  CAST(CASE WHEN rank IS NULL OR status_code IN (9,10) THEN status_code
       ELSE (SELECT status FROM ranks r WHERE r.rank = c.rank) END AS INT) AS status_code,
  modified_date_time FROM computed c""",
    "computed",
)
add(
    "feedback_detect",
    """, seen AS (SELECT *, email_instance_id % 15 = 0 OR email_instance_id % 10 = 0 AS edited
  FROM attempts WHERE crm_case_id IS NOT NULL)
SELECT email_instance_id, crm_case_id, edited AS changed,
  edited OR banker_modified_flag AS banker_modified_flag FROM seen""",
    "attempts",
)
add(
    "stage_fold_stored",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, last_completed_stage,
  CAST(CASE WHEN rank IS NULL OR status_code IN (9,10) THEN status_code
       ELSE (SELECT status FROM ranks r WHERE r.rank = c.rank) END AS INT) AS status_code,
  modified_date_time FROM computed c""",
    "computed",
)
add(
    "feedback_stored",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id,
  CAST(crm_case_id AS VARCHAR) AS crm_case_id, banker_modified_flag
    OR (crm_case_id IS NOT NULL AND (email_instance_id % 15 = 0 OR email_instance_id % 10 = 0))
    AS banker_modified_flag FROM attempts""",
    "attempts",
)
add(
    "append_checked",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id,
  COALESCE(status_details <> 'not json', TRUE) AND COALESCE(crm_case_payload <> 'not json', TRUE)
  AND COALESCE(agent_priority_code <> 0, TRUE) AS stored FROM attempts""",
    "attempts",
)
FEW = "('7-2024-01-05', '12-2024-01-09', '3-2024-01-20', 'none')"
add(
    "stored_attempts_of_activity",
    f"""SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, activity_id, attempt_number,
  created_date_time FROM attempts WHERE activity_id IN {FEW}""",
    "attempts",
)
add(
    "stored_lineage_lookup",
    """SELECT CAST(a.email_instance_id AS VARCHAR) AS email_instance_id,
  CAST(a.previous_email_instance_id AS VARCHAR) AS previous_email_instance_id FROM attempts a
JOIN attempts p ON p.email_instance_id = a.previous_email_instance_id WHERE p.status_code = 9""",
    "attempts",
)
add(
    "stored_subject_filter",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, activity_id, banker_subject
FROM attempts a WHERE status_code = 9 AND EXISTS (
  SELECT 1 FROM keyed k WHERE k.activity_id = a.activity_id AND k.props = a.banker_subject
    AND k.event_type IN ('view','purchase'))""",
    "attempts",
)
add(
    "stored_correlation_lookup",
    f"""SELECT activity_id AS "CorrelationId", tracking_status AS "Status", crm_case_id AS "CaseId",
  created_date_time AS "CreatedAt" FROM tracked WHERE activity_id IN {FEW}""",
    "tracked",
)
add(
    "stored_top_one",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, activity_id,
  attempt_number, created_date_time FROM attempts WHERE activity_id = '7-2024-01-05'
ORDER BY attempt_number DESC LIMIT 1""",
    "attempts",
)
add(
    "stored_status_view",
    """SELECT CAST(c.email_instance_id AS VARCHAR) AS email_instance_id, c.activity_id, c.attempt_number,
  c.status_code, c.failed_stage, c.resume_processing_stage, c.skip_queueitem_write, c.status_description
FROM computed c JOIN (SELECT activity_id, MAX(attempt_number) AS top FROM attempts GROUP BY activity_id) m
ON c.activity_id = m.activity_id AND c.attempt_number = m.top""",
    "computed",
)
add(
    "stored_queue_latest",
    """SELECT queue_item_id, q.activity_id, CAST(l.email_instance_id AS VARCHAR) AS email_instance_id,
  l.attempt_number, l.status_code, l.last_completed_stage
FROM queue_items q LEFT JOIN latest l ON l.activity_id = q.activity_id""",
    "queue_items",
    "latest",
)
add(
    "stored_request_prior",
    """SELECT request_id, q.activity_id, CAST(p.email_instance_id AS VARCHAR) AS prior_email_instance_id,
  p.attempt_number AS prior_attempt_number, p.last_completed_stage AS prior_last_completed_stage,
  CASE WHEN resume IN ('B7','B8','B9') THEN agent_subject END AS prior_agent_subject,
  CASE WHEN resume = 'B9' THEN crm_case_payload END AS prior_crm_case_payload
FROM requests q LEFT JOIN prior p ON p.activity_id = q.activity_id""",
    "requests",
    "prior",
)
add("stored_b1_write", WRITTEN, "written")
add(
    "chk_activity_attempt_log",
    """SELECT activity_id, attempt_number, COUNT(*) + 1 AS rows FROM attempts
WHERE status_code = 9 GROUP BY activity_id, attempt_number""",
    "attempts",
)
add(
    "stored_fold_days",
    """, folded AS (SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, last_completed_stage,
  CAST(CASE WHEN rank IS NULL OR status_code IN (9,10) THEN status_code
       ELSE (SELECT status FROM ranks r WHERE r.rank = c.rank) END AS INT) AS status_code,
  modified_date_time, attempt_number = MAX(attempt_number) OVER (PARTITION BY activity_id) AS top FROM computed c)
SELECT * EXCLUDE (top), FALSE AS latest FROM folded
UNION ALL SELECT * EXCLUDE (top), TRUE AS latest FROM folded WHERE top""",
    "computed",
)
add(
    "stored_feedback_days",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id,
  CAST(crm_case_id AS VARCHAR) AS crm_case_id, banker_modified_flag
    OR (crm_case_id IS NOT NULL AND (email_instance_id % 15 = 0 OR email_instance_id % 10 = 0))
    AS banker_modified_flag FROM attempts""",
    "attempts",
)
add(
    "stored_append_keys",
    """SELECT CAST(email_instance_id AS VARCHAR) AS email_instance_id, CAST(NULL AS VARCHAR) AS broken FROM attempts
UNION ALL SELECT CAST(email_instance_id AS VARCHAR), 'chk_pk,chk_activity_attempt' FROM attempts
WHERE created_date_time < TIMESTAMP '2024-01-15'""",
    "attempts",
)
add(
    "stored_without_parent",
    """SELECT event_id AS queue_item_id, activity_id FROM keyed
WHERE event_type IN ('view','click','signup') AND activity_id NOT IN (SELECT activity_id FROM attempts)""",
    "attempts",
)
add(
    "status_view_all",
    """SELECT email_instance_id, activity_id, attempt_number, failed_stage,
  resume_processing_stage, skip_queueitem_write, status_description FROM computed""",
    "computed",
)
add(
    "status_view",
    """SELECT c.* EXCLUDE (rank, details_ok) FROM computed c
JOIN (SELECT activity_id, MAX(attempt_number) AS top FROM attempts GROUP BY activity_id) m
ON c.activity_id = m.activity_id AND c.attempt_number = m.top""",
    "computed",
)

# Streams

add(
    "intake_source",
    """SELECT event_id AS message_id, ts AS enqueued_date_time,
  CASE WHEN event_type <> 'signup' THEN activity_id END AS activity_id,
  CASE WHEN event_type <> 'signup' THEN 's'||event_id END AS subject,
  event_type <> 'signup' AS accepted FROM keyed""",
    "keyed",
)
add(
    "stream_gate",
    f"""SELECT queue_item_id, activity_id, 'Pass' AS gate_result FROM ({GATED})
WHERE gate_failed IS NULL""",
    "queue_items",
)
add(
    "stream_dedupe",
    """SELECT CASE WHEN event_id % 13 <> 0 THEN event_id END AS message_id,
  ts + CASE WHEN n = 0 THEN INTERVAL '0' MINUTE WHEN event_id % 2 = 0 THEN INTERVAL '30' MINUTE
       ELSE INTERVAL '180' MINUTE END AS enqueued_date_time,
  CASE WHEN event_type = 'signup' THEN props
    ELSE '{"activity_id":"'||activity_id||'","subject":"s'||event_id||'"}' END AS body
FROM keyed, (VALUES (0), (1)) AS t(n) WHERE n = 0 OR event_id % 2 = 1 OR event_id % 13 = 0""",
    "keyed",
)
add(
    "stream_b1_write",
    WRITTEN.replace("request_id,", "CAST(request_id AS VARCHAR) AS request_id,", 1),
    "written",
)
add(
    "stream_stage_fold",
    """SELECT email_instance_id, MAX(stage_rank) AS stage_rank, MAX(event_time) AS event_time
FROM moves GROUP BY email_instance_id""",
    "moves",
)
add(
    "stream_status_windows",
    """SELECT time_bucket(INTERVAL '1 day', created_date_time) AS window_start,
  time_bucket(INTERVAL '1 day', created_date_time) + INTERVAL '1 day' AS window_end,
  status_code, COUNT(*) AS attempts FROM attempts GROUP BY 1,2,3""",
    "attempts",
)
add(
    "stream_status_sliding",
    """, placed AS (SELECT status_code, time_bucket(INTERVAL '6 hours', created_date_time)
    - back * INTERVAL '6 hours' AS window_start FROM attempts, (VALUES (0),(1)) AS t(back))
SELECT window_start, window_start + INTERVAL '12 hours' AS window_end, status_code,
  COUNT(*) AS attempts FROM placed GROUP BY 1,2,3""",
    "attempts",
)
add(
    "stream_late",
    """SELECT event_id, COALESCE(ts < (SELECT MAX(b.ts) FROM events b
  WHERE b.event_id % 4 < e.event_id % 4) - INTERVAL '1' HOUR, FALSE) AS late FROM events e""",
)
# Open rows are those that the newest event time, less the allowed delay, has not passed.
add(
    "stream_sessions",
    """, gaps AS (SELECT activity_id, ts, CASE WHEN ts >= LAG(ts) OVER w + INTERVAL '2 hours' THEN 1 ELSE 0 END AS opens
  FROM keyed WINDOW w AS (PARTITION BY activity_id ORDER BY ts)),
runs AS (SELECT activity_id, ts, SUM(opens) OVER (PARTITION BY activity_id ORDER BY ts) AS run FROM gaps),
mark AS (SELECT MAX(ts) - INTERVAL '1 hour' AS w FROM keyed)
SELECT activity_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '2 hours' AS session_end,
  COUNT(*) AS events, MAX(ts) + INTERVAL '2 hours' > (SELECT w FROM mark) AS open
FROM runs GROUP BY activity_id, run""",
    "keyed",
)
ORPHANS = """, mark AS (SELECT LEAST(MAX(ts) FILTER (event_type IN ('view','click')),
    MAX(ts) FILTER (event_type <> 'view')) - INTERVAL '1 hour' AS w FROM keyed)
SELECT event_id AS message_id, activity_id, ts AS message_time, ts + INTERVAL '6 hours' >= w AS open
FROM keyed m, mark WHERE event_type IN ('view','click') AND NOT EXISTS (
  SELECT 1 FROM keyed a WHERE a.event_type <> 'view' AND a.activity_id = m.activity_id
    AND a.ts BETWEEN m.ts AND m.ts + INTERVAL '6 hours')"""
add("stream_orphans", ORPHANS, "keyed")
add("stream_orphans_live", ORPHANS, "keyed")
STUCK = """, reached AS (SELECT email_instance_id, MAX(stage_rank) AS stage_rank,
    MAX(event_time) + INTERVAL '2 hours' AS stuck_since FROM moves GROUP BY email_instance_id),
mark AS (SELECT MAX(event_time) - INTERVAL '1 hour' AS w FROM moves)
SELECT email_instance_id, stage_rank, stuck_since, stuck_since > w AS open FROM reached, mark
WHERE stage_rank < 8"""
add("stream_stuck", STUCK, "moves")
add(
    "stream_stuck_alarms",
    STUCK.replace(", stuck_since > w AS open", "") + " AND stuck_since <= w",
    "moves",
)
