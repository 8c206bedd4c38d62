"""Attempt-log tables derived from the ``events`` and ``pages`` tables.

An activity is a user's day. Its attempts are that day's events other than views; the
views are requests for a new attempt; views and clicks are queue items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.functions.stages import (
    FAILED,
    FAILED_NO_RETRY,
    STAGES,
    stage_at,
    stage_rank,
    status_name_of,
    tracking_status,
)
from attemptlog.operators.skew import order_between
from attemptlog.sources.schemas import EVENTS, LAYOUTS, OTHER_LAYOUTS

ACTIVITY = "CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING)"

# The diagnostic documents of the derived log.
DOC_MANY = (
    '{"attempts":[{"attempt":1,"failed_stage":"B6_invoke_agent_workflow",'
    '"error_code":"AgentTimeout"},{"attempt":2,"failed_stage":"B9_post_case_creation",'
    '"error_code":"MuleSoftAuthError"}]}'
)
DOC_DOTTED = (
    '{"failed_stage":"B.6_invoke_agent_workflow","error_code":"AgentTimeout","http_status":504}'
)
DOC_AUTH = (
    '{"failed_stage":"B9_post_case_creation","error_code":"MuleSoftAuthError","http_status":401}'
)
DOC_TIMEOUT = (
    '{"failed_stage":"B6_invoke_agent_workflow","error_code":"AgentTimeout","http_status":504}'
)


STAGE_LIST = "array(" + ", ".join(f"'{s}'" for s in STAGES) + ")"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("activity_id", F.expr(ACTIVITY))


def attempt_columns(df: DataFrame) -> DataFrame:
    """Every attempt column; the ones that need an order only if ``df`` brings them."""
    ordered = [c for c in ("attempt_number", "previous_email_instance_id") if c in df.columns]
    return df.selectExpr(
        "event_id AS email_instance_id",
        "activity_id",
        *ordered,
        "CASE WHEN event_id % 50 <> 0 THEN event_id END AS correlation_id",
        "props AS banker_subject",
        "'subj_' || (event_id % 20) AS agent_subject",
        "CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 4 AS INT) END AS agent_priority_code",
        "elt(event_id % 3 + 1, 'High', 'Normal', 'Low') AS agent_case_priority",
        "'case ' || event_id AS agent_case_description",
        "'{\"r\":' || event_id || '}' AS agent_response",
        "event_id % 2 = 0 AS agent_action_flag",
        "CAST(CAST(event_id * 37 % 10001 AS DOUBLE) / 10000 AS DECIMAL(5,4))"
        " AS agent_confidence_score",
        "CASE WHEN event_id % 13 = 0 THEN 'not json' ELSE props END AS crm_case_payload",
        "CASE WHEN event_type = 'purchase' THEN event_id + 1000000 END AS crm_case_id",
        f"CASE event_type WHEN 'error' THEN IF(event_id % 4 = 0, {FAILED_NO_RETRY}, {FAILED})"
        " WHEN 'purchase' THEN 6 WHEN 'click' THEN 4 ELSE CAST(event_id % 12 AS INT) END"
        " AS status_code",
        f"get({STAGE_LIST}, CAST(event_id % 9 AS INT) - 1) AS last_completed_stage",
        f"CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 11 = 0 THEN 'not json'"
        f" WHEN event_id % 17 = 0 THEN '{DOC_MANY}' WHEN event_id % 7 = 0 THEN '{DOC_DOTTED}'"
        f" WHEN event_id % 3 = 0 THEN '{DOC_AUTH}' ELSE '{DOC_TIMEOUT}' END END"
        " AS status_details",
        "ts AS created_date_time",
        "ts + INTERVAL '30' MINUTE AS modified_date_time",
        "CASE WHEN event_type = 'purchase' THEN ts + INTERVAL '45' MINUTE END"
        " AS case_created_date_time",
        "event_id % 10 = 0 AS banker_modified_flag",
        "3 AS max_retries",
        "'tax_v' || (event_id % 2) AS taxonomy_version",
        "'prompt_v' || (user_id % 3) AS prompt_version",
        "'agent_v' || (user_id % 2) AS agent_version",
    )


def attempt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without attempt numbers: for work that does not need the order, no shuffle."""
    return attempt_columns(keyed_events(spark, sf_dir).filter("event_type <> 'view'"))


def attempts(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """The attempt log: the n-th event of an activity is its n-th attempt."""
    rows = keyed_events(spark, sf_dir).filter("event_type <> 'view'").filter(where)
    numbered = order_between(
        rows,
        ["activity_id"],
        ["ts", "event_id"],
        "attempt_number",
        {"previous_email_instance_id": "event_id"},
    ).withColumn("attempt_number", F.col("attempt_number").cast("int"))
    return attempt_columns(numbered)


def latest_rows(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Only the latest attempt of each activity: its number is how many there are."""
    rows = keyed_events(spark, sf_dir).filter("event_type <> 'view'").filter(where)
    carried = [c for c in rows.columns if c != "activity_id"]
    newest = (
        rows.groupBy("activity_id")
        .agg(
            F.count(F.lit(1)).cast("int").alias("attempt_number"),
            F.max_by(F.struct(*carried), F.struct("ts", "event_id")).alias("_newest"),
        )
        .select("activity_id", "attempt_number", "_newest.*")
    )
    return attempt_columns(newest)


def queue_item_columns(keyed: DataFrame) -> DataFrame:
    return keyed.selectExpr(
        "event_id AS queue_item_id",
        "activity_id",
        "IF(event_id % 5 = 0, 'PhoneCall', 'Email') AS item_type",
        "CASE WHEN event_id % 4 <> 0 THEN IF(event_id % 7 = 0, 'OTHER', 'AAB OPS') END AS owner_id",
        "CASE WHEN event_id % 3 = 0 THEN event_id END AS regarding_id",
        "'queue_' || (user_id % 4) AS queue_name",
        "ts AS received_date_time",
        "ts + INTERVAL '2' MINUTE AS enqueued_date_time",
        "CASE WHEN event_id % 6 <> 0 THEN ts + INTERVAL '5' MINUTE END AS processed_date_time",
    )


def queue_items(spark: SparkSession, sf_dir: str, kinds=("view", "click")) -> DataFrame:
    return queue_item_columns(
        keyed_events(spark, sf_dir).filter(F.col("event_type").isin(*kinds))
    )


def request_columns(keyed: DataFrame) -> DataFrame:
    return keyed.filter("event_type = 'view'").select(
        F.col("event_id").alias("request_id"),
        "activity_id",
        F.col("props").alias("banker_subject"),
        F.col("ts").alias("requested_at"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue each request came from."""
    return keyed_events(spark, sf_dir).filter("event_type = 'view'").selectExpr(
        "event_id AS request_id", "'queue_' || (user_id % 4) AS queue_id"
    )


def in_other_layout(df: DataFrame, table: str, version: str) -> DataFrame:
    """Queue items or attachments under the names of one of their layouts."""
    columns = OTHER_LAYOUTS[table][version]
    return df.selectExpr(*[f"{c} AS {old}" for c, old in columns.items() if c in df.columns])


def item_history(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Queue items, a fifth in each layout."""
    items, versions = queue_items(spark, sf_dir), list(OTHER_LAYOUTS["queue_item"])
    return {
        v: in_other_layout(items.filter(F.col("queue_item_id") % len(versions) == i), "queue_item", v)
        for i, v in enumerate(versions)
    }


def attachment_history(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Attachments, half of them in the first layout."""
    files = attachments(spark, sf_dir)
    return {
        v: in_other_layout(files.filter(F.col("attachment_id") % 2 == i), "email_attachment", v)
        for i, v in enumerate(OTHER_LAYOUTS["email_attachment"])
    }


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_columns(keyed_events(spark, sf_dir))


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is attached to the activity of event ``7 * page_id``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        (F.col("page_id") * 7).alias("event_id"),
        F.col("page_id").alias("attachment_id"),
        F.col("url").alias("file_name"),
    )
    owners = keyed_events(spark, sf_dir).select("event_id", "activity_id")
    return pages.join(owners, "event_id").select("attachment_id", "activity_id", "file_name")


def named_status(log: DataFrame) -> DataFrame:
    """The log with the textual status of older layouts; unknown codes break their rule."""
    name = F.coalesce(status_name_of(F.col("status_code")), F.lit("Bogus"))
    return log.withColumn("status_code", name)


def in_layout(log: DataFrame, version: str) -> DataFrame:
    """A log with the columns of an older layout, under the names they had there."""
    layout = LAYOUTS[version]
    if not layout.per_attempt:
        log = log.withColumn("attempt_number", F.col("attempt_number") - 1)
    if layout.status == "name":
        log = named_status(log)
    # Where one old column became two, the first of them is its value.
    sources: dict[str, str] = {}
    for c, old in layout.columns.items():
        if c in log.columns:
            sources.setdefault(old, c)
    return log.selectExpr(*[f"{c} AS {old}" for old, c in sources.items()])


def legacy(latest: DataFrame) -> DataFrame:
    """Latest attempts in the first layout with textual status, one row per e-mail."""
    return in_layout(latest, "v1")


def tracking(latest: DataFrame) -> DataFrame:
    """Latest attempts in the layout of the tracking table."""
    status = tracking_status(F.col("status_code"), F.col("crm_case_id"))
    return latest.withColumn("status", status).selectExpr(
        "activity_id AS ActivityId",
        "activity_id AS CorrelationId",
        "status AS Status",
        "get_json_object(status_details, '$.error_code') AS StatusCode",
        "agent_subject AS AgentSubjectName",
        "substring(agent_subject, 6) AS AgentSubjectId",
        "agent_priority_code AS AgentPriorityCode",
        "agent_confidence_score AS AgentConfidenceScore",
        "crm_case_id AS CaseId",
        "case_created_date_time AS CaseCreatedOn",
        "attempt_number - 1 AS RetryCount",
        "CASE WHEN attempt_number > 1 THEN created_date_time END AS LastRetryAt",
        "created_date_time AS CreatedAt",
        "modified_date_time AS UpdatedAt",
    )


# First day of each layout's era in the derived history.
ERAS = (
    ("tracking", "2024-01-01"),
    ("v1", "2024-01-05"),
    ("sc", "2024-01-09"),
    ("v3", "2024-01-13"),
    ("v4", "2024-01-17"),
    ("v6", "2024-01-21"),
    ("v7", "2024-01-24"),
    ("ddl", "2024-01-27"),
)


def history(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The log as it would lie in storage: each era in the layout of its time."""
    frames = {}
    for i, (version, start) in enumerate(ERAS):
        bounds = []
        if i > 0:
            bounds.append(f"ts >= TIMESTAMP_NTZ '{start} 00:00:00'")
        if i + 1 < len(ERAS):
            bounds.append(f"ts < TIMESTAMP_NTZ '{ERAS[i + 1][1]} 00:00:00'")
        rows = attempts if LAYOUTS[version].per_attempt else latest_rows
        log = rows(spark, sf_dir, " AND ".join(bounds))
        frames[version] = tracking(log) if version == "tracking" else in_layout(log, version)
    return frames


def stage_events(log: DataFrame) -> DataFrame:
    """One completion event per stage an attempt got through, a minute apart."""
    reached = stage_rank(F.col("last_completed_stage"))
    return (
        log.filter("last_completed_stage IS NOT NULL")
        .select(
            "email_instance_id",
            "created_date_time",
            F.explode(F.sequence(F.lit(1), reached)).alias("stage_rank"),
        )
        .select(
            "email_instance_id",
            "stage_rank",
            stage_at(F.col("stage_rank")).alias("stage"),
            F.expr("created_date_time + make_dt_interval(0, 0, stage_rank)").alias("event_time"),
        )
    )


def case_snapshot(log: DataFrame) -> DataFrame:
    """The CRM's view of the created cases; some subjects were changed or cleared."""
    event = F.col("email_instance_id")
    return log.filter("crm_case_id IS NOT NULL").select(
        "crm_case_id",
        F.when(event % 15 == 0, F.lit(None))
        .when(event % 10 == 0, F.concat(F.col("agent_subject"), F.lit(" (edited)")))
        .otherwise(F.col("agent_subject"))
        .alias("case_subject"),
        F.col("agent_case_priority").alias("case_priority"),
    )


def app_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON lists, two apps per event, of the two kinds of plan."""
    def app(n: int) -> str:
        return f"""
        '{{"name":"app-' || event_id || '-{n}","resourceGroup":"rg-' || user_id || '","state":"'
        || CASE WHEN (event_id + {n}) % 3 = 0 THEN 'Stopped' ELSE 'Running' END
        || '","location":"loc-' || (user_id % 5) || '"}}'
        """

    listed = f"'[' || {app(1)} || ',' || {app(2)} || ']'"
    one = """
        '{"properties":{"sku":"' || CASE WHEN event_id % 2 = 0 THEN 'FlexConsumption'
        ELSE 'Dynamic' END || '","functionAppConfig":{"runtime":{"name":"python","version":"3.'
        || (event_id % 4 + 9) || '"}}},"siteConfig":{"linuxFxVersion":"PYTHON|3.'
        || (event_id % 3 + 8) || '"}}'
    """
    return events(spark, sf_dir).select(
        "event_id", F.expr(listed).alias("apps"), F.expr(one).alias("app")
    )


def intake_messages(events_df: DataFrame) -> DataFrame:
    """Queue messages with their JSON body; sign-ups carry one that names no activity."""
    body = F.concat(
        F.lit('{"activity_id":"'), F.expr(ACTIVITY), F.lit('","subject":"'),
        F.concat(F.lit("s"), F.col("event_id").cast("string")), F.lit('"}'),
    )
    return events_df.select(
        F.col("event_id").alias("message_id"),
        F.col("ts").alias("enqueued_date_time"),
        F.when(F.col("event_type") == "signup", F.col("props")).otherwise(body).alias("body"),
    )
