"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.functions import documents as doc
from attemptlog.functions import stages as st
from attemptlog.operators import latest, links, lookups, quality, reports
from attemptlog.plans import b1_write as b1
from attemptlog.plans import folds, logstore, recovery, store
from attemptlog.plans.status_view import status_view, with_derived
from attemptlog.session import configure, materialize, shared_dir
from attemptlog.sources import derived, documents, tables
from attemptlog.sources.schemas import EMAIL_INSTANCE, LENGTHS, QUEUE_ITEM, REQUIRED
from attemptlog.streaming import alarms, intake, progress
from attemptlog.streaming import tables as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered runs.
AUDIT = ("2024-01-10", "2024-01-12")
PAGE = 100
CUTOFF = "2024-01-15"
THRESHOLD = 0.25
INSERT_TIME = "2024-02-01 00:00:00"
ACTIVITY = "7-2024-01-05"
FAILED_STAGE, RESUME_POINT = st.STAGES[4], "B4"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def as_double(df: DataFrame) -> DataFrame:
    """Scores as doubles: engines print decimals differently."""
    score = F.col("agent_confidence_score").cast("double")
    return df.withColumn("agent_confidence_score", score)


# Scans, sources, sinks


@query
def scan_email_instance(spark, sf):
    return as_double(tables.conform(derived.attempts(spark, sf), EMAIL_INSTANCE))


@query
def scan_tracking(spark, sf):
    log = derived.tracking(derived.latest_rows(spark, sf))
    return log.withColumn("AgentConfidenceScore", F.col("AgentConfidenceScore").cast("double"))


@query
def scan_queue_item(spark, sf):
    return tables.conform(derived.queue_items(spark, sf), QUEUE_ITEM)


@query
def scan_email_attachment(spark, sf):
    return derived.attachments(spark, sf)


@query
def version_union(spark, sf):
    return as_double(tables.version_union(derived.history(spark, sf))).select(
        "schema_version", "activity_id", "attempt_number", "email_instance_id",
        "previous_email_instance_id", "correlation_id", "banker_subject", "agent_subject",
        "agent_case_priority", "agent_priority_code", "agent_confidence_score", "crm_case_id",
        "status_code", "last_completed_stage", "created_date_time", "modified_date_time",
        "case_created_date_time", "banker_modified_flag", "error_type", "max_retries",
        "agent_version", "agent_subject_id", "last_retry_date_time", "status_text",
    )


@query
def queue_item_union(spark, sf):
    """Queue items of five layouts, each queue's in the layout of its time."""
    return tables.other_union(derived.item_history(spark, sf), "queue_item").select(
        "schema_version", "queue_item_id", "activity_id", "item_type", "owner_id", "regarding_id",
        "queue_name", "received_date_time", "enqueued_date_time", "processed_date_time",
    )


@query
def attachment_union(spark, sf):
    """Attachments of both layouts."""
    return tables.other_union(derived.attachment_history(spark, sf), "email_attachment").select(
        "schema_version", "attachment_id", "activity_id", "file_name"
    )


@query
def apply_defaults(spark, sf):
    minimal = derived.requests(spark, sf).select("request_id", "activity_id", "banker_subject")
    return tables.apply_defaults(minimal, "email_instance", ["request_id"], INSERT_TIME)


def new_rows(spark, sf):
    return b1.b1_write(derived.attempts(spark, sf), derived.requests(spark, sf))


INSERTED = [
    "email_instance_id", "activity_id", "attempt_number", "previous_email_instance_id",
    "banker_subject", "agent_subject", "agent_action_flag", "crm_case_payload", "status_code",
    "last_completed_stage", "created_date_time", "modified_date_time", "banker_modified_flag",
    "failed_stage", "resume_processing_stage", "skip_queueitem_write", "status_description",
]


@query
def insert_first(spark, sf):
    return tables.insertable(b1.insert_first(new_rows(spark, sf)), INSERT_TIME).select(*INSERTED)


@query
def insert_retry(spark, sf):
    return tables.insertable(b1.insert_retry(new_rows(spark, sf)), INSERT_TIME).select(*INSERTED)


@query
def insert_returning(spark, sf):
    return b1.returning(new_rows(spark, sf))


@query
def queue_item_write(spark, sf):
    """Items for the requests of the last days, which the stored items do not cover."""
    items = derived.queue_items(spark, sf)
    early = items.filter(F.col("received_date_time") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return recovery.queue_item_write(new_rows(spark, sf), early, derived.messages(spark, sf))


@query
def written_items_not_null(spark, sf):
    """NULLs in the required columns of the items written."""
    items = tables.apply_defaults(queue_item_write(spark, sf), "queue_item")
    report = quality.null_report(tables.conform(items, QUEUE_ITEM), "queue_item", REQUIRED["queue_item"])
    return report.select("table", "column", "null_rows")


@query
def b1_write_other_case(spark, sf):
    """Requests whose ids come in upper case, with padding."""
    padded = F.concat(F.lit(" "), F.upper(F.col("activity_id")))
    asked = derived.requests(spark, sf).withColumn("activity_id", padded)
    return as_double(b1.b1_write(derived.attempts(spark, sf), asked))


@query
def status_details_source(spark, sf):
    rows = derived.attempt_rows(spark, sf)
    return documents.status_details_source(rows, "email_instance_id")


# Projections


def projected(spark, sf, **columns) -> DataFrame:
    return derived.attempt_rows(spark, sf).select(
        "email_instance_id", *[c.alias(name) for name, c in columns.items()]
    )


@query
def status_description(spark, sf):
    return projected(spark, sf, status_description=st.status_description(F.col("status_code")))


@query
def resume_stage(spark, sf):
    stage = F.col("last_completed_stage")
    return projected(
        spark, sf,
        resume_processing_stage=st.resume_stage(stage),
        resume_processing_stage_v6=st.resume_stage(stage, fallback="B4"),
    )


@query
def skip_queueitem(spark, sf):
    return projected(
        spark, sf, skip_queueitem_write=st.skip_queueitem(F.col("last_completed_stage"))
    )


@query
def failed_stage(spark, sf):
    return projected(spark, sf, failed_stage=doc.failed_stage(F.col("status_details")))


@query
def failed_stage_norm(spark, sf):
    stage = doc.failed_stage(F.col("status_details"))
    return projected(spark, sf, failed_stage_norm=st.normalise_stage(stage))


@query
def stage_rank(spark, sf):
    return projected(spark, sf, stage_rank=st.stage_rank(F.col("last_completed_stage")))


@query
def carry_forward(spark, sf):
    resume = st.resume_stage(F.col("last_completed_stage"))
    return as_double(projected(spark, sf, resume=resume, **st.carry_forward(resume)))


@query
def status_map(spark, sf):
    return derived.legacy(derived.latest_rows(spark, sf)).select(
        "ActivityId", "StatusCode", st.status_code_of(F.col("StatusCode")).alias("status_code")
    )


@query
def tracking_status(spark, sf):
    status = st.tracking_status(F.col("status_code"), F.col("crm_case_id"))
    return projected(spark, sf, tracking_status=status)


@query
def gate_eval(spark, sf):
    return recovery.gate_eval(derived.queue_items(spark, sf)).select(
        "queue_item_id", "gate_result", "gate_failed"
    )


@query
def low_confidence(spark, sf):
    flag = st.low_confidence(F.col("agent_confidence_score"), THRESHOLD)
    return projected(spark, sf, low_confidence=flag)


# Filters


@query
def attempts_of_activity(spark, sf):
    wanted = links.activities(derived.requests(spark, sf))
    return lookups.attempts_of_activity(derived.attempts(spark, sf), wanted).select(
        "email_instance_id", "activity_id", "attempt_number"
    )


@query
def failed_scan(spark, sf):
    return lookups.failed(derived.attempts(spark, sf)).select(
        "activity_id", "status_code", (F.col("attempt_number") - 1).alias("retry_count"),
        "modified_date_time",
    )


@query
def failed_by_stage_scan(spark, sf):
    return lookups.failed_by_stage_scan(derived.attempt_rows(spark, sf), FAILED_STAGE).select(
        "email_instance_id", "activity_id"
    )


@query
def resume_scan(spark, sf):
    return lookups.resume_scan(derived.attempt_rows(spark, sf), RESUME_POINT).select(
        "email_instance_id", "activity_id", "last_completed_stage"
    )


@query
def correlation_lookup(spark, sf):
    wanted = derived.requests(spark, sf).select(F.col("activity_id").alias("CorrelationId"))
    return lookups.correlation_lookup(derived.tracking(derived.latest_rows(spark, sf)), wanted)


@query
def audit_range(spark, sf):
    return latest.audit_range(derived.tracking(derived.latest_rows(spark, sf)), *AUDIT)


@query
def subject_filter(spark, sf):
    pairs = derived.requests(spark, sf).select("banker_subject", "activity_id")
    same_day = derived.attempt_rows(spark, sf).filter("crm_case_id IS NOT NULL")
    wanted = pairs.unionByName(same_day.select("banker_subject", "activity_id"))
    return lookups.subject_filter(derived.attempt_rows(spark, sf), wanted).select(
        "email_instance_id", "activity_id", "banker_subject"
    )


@query
def lineage_lookup(spark, sf):
    log = derived.attempts(spark, sf)
    return lookups.lineage_lookup(log, lookups.failed(derived.attempt_rows(spark, sf))).select(
        "email_instance_id", "previous_email_instance_id"
    )


@query
def stuck_scan(spark, sf):
    return lookups.stuck_scan(derived.attempt_rows(spark, sf), CUTOFF).select(
        "email_instance_id", "status_code", "modified_date_time"
    )


# Data-quality rules


def checked(df: DataFrame, key: str, *rules) -> DataFrame:
    return quality.violations(df, key, rules)


@query
def chk_status(spark, sf):
    latest_rows = derived.latest_rows(spark, sf)
    old = checked(derived.legacy(latest_rows), "ActivityId", quality.status_rule("StatusCode"))
    oldest = checked(derived.tracking(latest_rows), "ActivityId", quality.tracking_rule("Status"))
    return old.unionByName(oldest)


@query
def chk_stage(spark, sf):
    """The completed and the blamed stage against the stage names.

    Some completed stages are written dotted; so are some blamed ones.
    """
    dotted = F.regexp_replace("last_completed_stage", "^B", "B.")
    stage = F.when(F.col("email_instance_id") % 9 == 5, dotted).otherwise(
        F.col("last_completed_stage")
    )
    rows = projected(
        spark, sf, last_completed_stage=stage, stage=doc.failed_stage(F.col("status_details"))
    )
    rules = [quality.stage_rule("last_completed_stage"), quality.stage_rule("stage")]
    return checked(rows, "email_instance_id", *rules)


@query
def chk_details_json(spark, sf):
    rule = quality.json_rule("chk_details_json", "status_details")
    return checked(derived.attempt_rows(spark, sf), "email_instance_id", rule)


@query
def chk_payload_json(spark, sf):
    rule = quality.json_rule("chk_payload_json", "crm_case_payload")
    return checked(derived.attempt_rows(spark, sf), "email_instance_id", rule)


@query
def chk_priority(spark, sf):
    rule = quality.priority_rule("agent_priority_code")
    return checked(derived.attempt_rows(spark, sf), "email_instance_id", rule)


@query
def chk_gate(spark, sf):
    """Gate outcomes with the failed gate's name written in place of Stop."""
    items = recovery.gate_eval(derived.queue_items(spark, sf)).withColumn(
        "gate_result", F.coalesce("gate_failed", "gate_result")
    )
    return checked(items, "queue_item_id", quality.gate_rule("gate_result"))


@query
def chk_queue_status(spark, sf):
    """Queue states with a picked-up item written as Processed."""
    items = derived.queue_items(spark, sf).withColumn(
        "queue_status_code",
        F.when(F.col("processed_date_time").isNull(), "Enqueued")
        .when(F.col("owner_id") == st.GATE_OWNER, "WorkedByServiceAccount")
        .when(F.col("owner_id").isNotNull(), "Processed"),
    )
    return checked(items, "queue_item_id", quality.queue_status_rule("queue_status_code"))


@query
def chk_not_null(spark, sf):
    log = tables.conform(derived.attempts(spark, sf), EMAIL_INSTANCE)
    items = tables.conform(derived.queue_items(spark, sf), QUEUE_ITEM)
    return quality.null_report(log, "email_instance", REQUIRED["email_instance"]).unionByName(
        quality.null_report(items, "queue_item", REQUIRED["queue_item"])
    )


def lines(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("attempt_number")
    )


@query
def chk_pk(spark, sf):
    """Ids held twice, in a log of which a sixth has a copy."""
    log = derived.attempt_rows(spark, sf)
    copies = log.filter(F.col("email_instance_id") % 6 == 1)
    return quality.duplicate_keys(log.unionByName(copies), ["email_instance_id"])


@query
def chk_activity_attempt(spark, sf):
    return quality.duplicate_keys(lines(spark, sf), ["activity_id", "attempt_number"])


@query
def chk_correlation(spark, sf):
    return quality.duplicate_keys(derived.attempt_rows(spark, sf), ["correlation_id"])


@query
def chk_fk_queue(spark, sf):
    items = derived.queue_items(spark, sf).select("queue_item_id", "activity_id")
    return quality.missing_parent(items, derived.attempt_rows(spark, sf), "activity_id")


@query
def chk_fk_attachment(spark, sf):
    files = derived.attachments(spark, sf)
    return quality.missing_parent(files, derived.attempt_rows(spark, sf), "activity_id")


@query
def chk_length(spark, sf):
    """Texts measured as subjects, and event values as confidence scores."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.col("text").alias("banker_subject"), F.col("source").alias("agent_version")
    )
    limits = LENGTHS["email_instance"]
    too_long = quality.violations(
        texts,
        "doc_id",
        [quality.length_rule(c, limits[c]) for c in ("banker_subject", "agent_version")],
    )
    scores = derived.events(spark, sf).select(
        "event_id", F.col("value").alias("agent_confidence_score")
    )
    too_big = quality.violations(
        scores, "event_id", [quality.decimal_rule("agent_confidence_score", 5, 4)]
    )
    return too_long.select("rule", "key", "column").unionByName(
        too_big.select("rule", "key", "column")
    )


@query
def chk_sequence(spark, sf):
    """The log with some numbers skipped and some previous ids lost."""
    event, number = F.col("email_instance_id"), F.col("attempt_number")
    log = derived.attempts(spark, sf).withColumns(
        {
            "attempt_number": F.when(event % 7 == 0, number + 1000).otherwise(number),
            "previous_email_instance_id": F.when(
                event % 11 != 0, F.col("previous_email_instance_id")
            ),
        }
    )
    return quality.sequence_breaks(log).select(
        "email_instance_id", "activity_id", "attempt_number", "problem"
    )


@query
def chk_raw_content(spark, sf):
    """Texts and pages that hold markup or mail addresses."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.concat(F.lit("document-"), F.col("doc_id")).alias("key"), F.col("text").alias("content")
    )
    pages = spark.read.parquet(f"{sf}/pages.parquet").select(
        F.concat(F.lit("page-"), F.col("page_id")).alias("key"), F.col("html").alias("content")
    )
    return quality.violations(
        texts.unionByName(pages), "key", quality.raw_content_rules("content")
    ).select("rule", "key")


def log_rules():
    return [
        quality.stage_rule("last_completed_stage"),
        quality.json_rule("chk_details_json", "status_details"),
        quality.json_rule("chk_payload_json", "crm_case_payload"),
        quality.priority_rule("agent_priority_code"),
    ]


@query
def quarantine(spark, sf):
    """Attempts that break any rule of the log, with the rules they break."""
    _, bad = quality.quarantine(derived.attempt_rows(spark, sf), log_rules())
    return bad.select("email_instance_id", F.array_join("broken", ",").alias("broken"))


# Joins


@query
def latest_join(spark, sf):
    return as_double(latest.latest_join(derived.attempts(spark, sf)))


@query
def route_requests(spark, sf):
    return b1.route_requests(derived.requests(spark, sf), derived.attempt_rows(spark, sf))


@query
def request_prior(spark, sf):
    return b1.request_prior(derived.requests(spark, sf), derived.attempts(spark, sf)).select(
        "request_id", "activity_id", "prior_email_instance_id", "prior_attempt_number",
        "prior_last_completed_stage",
    )


@query
def orphans(spark, sf):
    return links.orphans(derived.queue_items(spark, sf), derived.attempt_rows(spark, sf))


@query
def lineage_parent(spark, sf):
    return links.lineage_parent(derived.attempts(spark, sf)).select(
        "email_instance_id", "previous_email_instance_id", "parent_attempt_number",
        "parent_status_code", "parent_stage",
    )


@query
def lineage_chain(spark, sf):
    return links.lineage_chain(derived.attempts(spark, sf))


@query
def lineage_chain_clean(spark, sf):
    return links.lineage_chain_clean(derived.attempts(spark, sf))


@query
def queue_latest(spark, sf):
    return links.queue_latest(derived.queue_items(spark, sf), derived.attempts(spark, sf)).select(
        "queue_item_id", "activity_id", "email_instance_id", "attempt_number", "status_code",
        "last_completed_stage",
    )


@query
def attachment_latest(spark, sf):
    return links.attachment_latest(
        derived.attachments(spark, sf), derived.attempts(spark, sf)
    )


# Aggregations


@query
def max_attempt(spark, sf):
    return latest.max_attempt(derived.attempts(spark, sf))


@query
def retry_counts(spark, sf):
    return reports.retry_counts(derived.attempt_rows(spark, sf))


@query
def failed_by_stage(spark, sf):
    return reports.failed_by_stage(derived.attempt_rows(spark, sf))


@query
def failed_by_resume(spark, sf):
    return reports.failed_by_resume(derived.attempt_rows(spark, sf))


@query
def status_counts(spark, sf):
    return reports.status_counts(derived.attempts(spark, sf))


@query
def failure_codes(spark, sf):
    return reports.failure_codes(derived.attempt_rows(spark, sf))


@query
def banker_modified_rate(spark, sf):
    return reports.banker_modified_rate(derived.attempt_rows(spark, sf))


@query
def version_quality(spark, sf):
    return reports.version_quality(derived.attempt_rows(spark, sf))


@query
def time_to_case(spark, sf):
    return reports.time_to_case(derived.attempt_rows(spark, sf))


@query
def queue_latency(spark, sf):
    return reports.queue_latency(derived.queue_items(spark, sf))


@query
def activity_summary(spark, sf):
    return reports.activity_summary(derived.attempts(spark, sf))


@query
def status_rollup(spark, sf):
    return reports.status_rollup(derived.attempt_rows(spark, sf))


# Ordering


@query
def latest_attempt(spark, sf):
    return as_double(latest.latest_attempt(derived.attempts(spark, sf)))


@query
def attempt_history(spark, sf):
    return latest.attempt_history(derived.attempts(spark, sf)).select(
        "activity_id", "email_instance_id", "attempt_number", "created_date_time", "recency"
    )


@query
def retry_gap(spark, sf):
    return latest.retry_gap(derived.attempts(spark, sf))


@query
def last_retry(spark, sf):
    return latest.last_retry(derived.attempts(spark, sf))


@query
def assign_attempts(spark, sf):
    return b1.assign_attempts(derived.requests(spark, sf), derived.attempts(spark, sf)).select(
        "request_id", "activity_id", "request_number", "attempt_number"
    )


@query
def audit_page(spark, sf):
    return latest.audit_page(derived.tracking(derived.latest_rows(spark, sf)), *AUDIT, PAGE)


@query
def top_one(spark, sf):
    """The newest attempt of one activity, in a log where every attempt has a copy."""
    log = derived.attempts(spark, sf).select(
        F.col("email_instance_id").cast("string"), "activity_id", "attempt_number",
        "created_date_time",
    )
    copy = log.withColumn("email_instance_id", F.concat(F.lit("copy-"), "email_instance_id"))
    return latest.top_one(log.unionByName(copy), ACTIVITY)


# Documents


@query
def json_value(spark, sf):
    details = F.col("status_details")
    return projected(
        spark, sf,
        error_code=doc.json_value(details, "$.error_code"),
        http_status=doc.json_value(details, "$.http_status"),
        attempts=doc.json_value(details, "$.attempts"),
        second_code=doc.json_value(details, "$.attempts[1].error_code"),
    )


@query
def is_json(spark, sf):
    return projected(
        spark, sf,
        details_is_json=doc.is_json(F.col("status_details")),
        payload_is_json=doc.is_json(F.col("crm_case_payload")),
        subject_is_json=doc.is_json(F.col("agent_subject")),
    )


@query
def try_cast_status(spark, sf):
    """Status codes written as text, some of them names."""
    text = F.coalesce(st.status_name_of(F.col("status_code")), F.col("status_code").cast("string"))
    either = F.when(F.col("agent_action_flag"), text).otherwise(
        F.col("status_code").cast("string")
    )
    return projected(
        spark, sf,
        status_text=either,
        status_code=either.try_cast("int"),
        status_description=st.status_description(either),
    )


@query
def json_project(spark, sf):
    fields = {"Name": "name", "ResourceGroup": "resourceGroup", "State": "state",
              "Location": "location"}
    return doc.json_project(derived.app_documents(spark, sf), "event_id", "apps", fields)


@query
def json_path_by_kind(spark, sf):
    app = F.col("app")
    runtime = "$.properties.functionAppConfig.runtime"
    return derived.app_documents(spark, sf).select(
        "event_id",
        doc.json_path_by_kind(
            app, "$.properties.sku", {"FlexConsumption": f"{runtime}.version"},
            "$.siteConfig.linuxFxVersion",
        ).alias("runtime_version"),
    )


@query
def details_typed(spark, sf):
    rows = derived.attempt_rows(spark, sf).filter("status_details IS NOT NULL")
    return doc.details_typed(rows).select(
        "email_instance_id", "details.failed_stage", "details.error_code", "details.http_status"
    )


@query
def status_details_rows(spark, sf):
    return doc.status_details_rows(derived.attempt_rows(spark, sf), "email_instance_id").select(
        "email_instance_id", "attempt", "failed_stage", "error_code", "http_status"
    )


# Jobs


@query
def b1_write(spark, sf):
    return as_double(new_rows(spark, sf))


@query
def recovery_worklist(spark, sf):
    return recovery.recovery_worklist(derived.attempts(spark, sf))


@query
def recovery_retry(spark, sf):
    """One recovery run: the worklist turned into new attempts."""
    log = derived.attempts(spark, sf)
    worklist = recovery.recovery_worklist(log)
    subjects = derived.requests(spark, sf).groupBy("activity_id").agg(
        F.max("banker_subject").alias("banker_subject")
    )
    due = recovery.worklist_requests(worklist, subjects, INSERT_TIME)
    return as_double(b1.b1_write(log, due))


@query
def stage_fold(spark, sf):
    """The log without its stages, rebuilt from the stage events."""
    log = derived.attempt_rows(spark, sf)
    bare = log.withColumn("last_completed_stage", F.lit(None).cast("string"))
    return folds.stage_fold(bare, derived.stage_events(log)).select(
        "email_instance_id", "last_completed_stage", "status_code", "modified_date_time"
    )


FIELDS = {"agent_subject": "case_subject", "agent_case_priority": "case_priority"}


@query
def feedback_detect(spark, sf):
    """Every case is in the snapshot twice."""
    log = derived.attempt_rows(spark, sf)
    cases = derived.case_snapshot(log)
    return folds.feedback_detect(log, cases.unionByName(cases), FIELDS)


def stored_log(spark, log: DataFrame) -> str:
    path = shared_dir(spark, "stored")
    tables.append(tables.conform(log, EMAIL_INSTANCE), path)
    return path


@query
def stage_fold_stored(spark, sf):
    """A log stored without its stages, its days replaced by the folded ones, read back."""
    log = derived.attempt_rows(spark, sf).withColumn("attempt_number", F.lit(1))
    path = stored_log(spark, log.withColumn("last_completed_stage", F.lit(None).cast("string")))
    store.fold_into(spark, path, derived.stage_events(log))
    return tables.scan(spark, path, "email_instance").select(
        "email_instance_id", "last_completed_stage", "status_code", "modified_date_time"
    )


@query
def feedback_stored(spark, sf):
    """A stored log after a banker's changes were written back, twice."""
    log = derived.attempt_rows(spark, sf).withColumn("attempt_number", F.lit(1))
    path = stored_log(spark, log)
    for _ in range(2):
        store.flag_feedback(spark, path, derived.case_snapshot(log), FIELDS)
    return tables.scan(spark, path, "email_instance").select(
        "email_instance_id", "crm_case_id", "banker_modified_flag"
    )


@query
def append_checked(spark, sf):
    """Attempts appended under the log's rules: what was stored and what was turned away."""
    log = tables.conform(
        derived.attempt_rows(spark, sf).withColumn("attempt_number", F.lit(1)), EMAIL_INSTANCE
    )
    path, rejected = shared_dir(spark, "checked"), shared_dir(spark, "rejected")
    store.append_checked(log, path, rejected, log_rules())
    good = tables.scan(spark, path, "email_instance").withColumn("stored", F.lit(True))
    bad = spark.read.parquet(rejected).withColumn("stored", F.lit(False))
    return good.select("email_instance_id", "stored").unionByName(
        bad.select("email_instance_id", "stored")
    )


LOOKED_UP = (f" {ACTIVITY.upper()} ", "12-2024-01-09", "3-2024-01-20", "none")


def looked_up(spark, column: str) -> DataFrame:
    return spark.createDataFrame([(a,) for a in LOOKED_UP], f"{column} string")


def log_store(spark, sf) -> logstore.LogStore:
    """The attempts in a store, added in two batches, the first of them twice."""
    log = materialize(derived.attempts(spark, sf), "attempts")
    early = F.col("created_date_time") < F.lit(CUTOFF).cast("timestamp_ntz")
    made = logstore.open_store(spark, "log-store", 8)
    for batch, rows in (("0001", log.filter(early)), ("0002", log.filter(~early)), ("0001", log.filter(early))):
        made.append(rows, batch)
    return made


@query
def stored_attempts_of_activity(spark, sf):
    """Attempts of a few activities, whose ids reach the files."""
    return log_store(spark, sf).attempts_of(looked_up(spark, "activity_id")).select(
        "email_instance_id", "activity_id", "attempt_number", "created_date_time"
    )


@query
def stored_lineage_lookup(spark, sf):
    made = log_store(spark, sf)
    return made.retries_of(lookups.failed(made.log())).select(
        "email_instance_id", "previous_email_instance_id"
    )


@query
def stored_subject_filter(spark, sf):
    pairs = derived.requests(spark, sf).select("banker_subject", "activity_id")
    made = log_store(spark, sf)
    own = made.log().filter("crm_case_id IS NOT NULL").select("banker_subject", "activity_id")
    return made.failed_of(pairs.unionByName(own)).select(
        "email_instance_id", "activity_id", "banker_subject"
    )


@query
def stored_correlation_lookup(spark, sf):
    """The tracking table as stored, asked for a few correlations."""
    path = shared_dir(spark, "tracking")
    derived.tracking(derived.latest_rows(spark, sf)).write.parquet(path)
    wanted = looked_up(spark, "CorrelationId").select(F.lower(F.trim("CorrelationId")).alias("CorrelationId"))
    return lookups.correlation_lookup(spark.read.parquet(path), wanted, lookups.SHORT)


@query
def stored_top_one(spark, sf):
    return latest.top_one(log_store(spark, sf).log(), ACTIVITY).select(
        "email_instance_id", "activity_id", "attempt_number", "created_date_time"
    )


@query
def stored_status_view(spark, sf):
    return log_store(spark, sf).status_view().select(
        "email_instance_id", "activity_id", "attempt_number", "status_code", "failed_stage",
        "resume_processing_stage", "skip_queueitem_write", "status_description",
    )


@query
def stored_queue_latest(spark, sf):
    return log_store(spark, sf).queue_latest(derived.queue_items(spark, sf)).select(
        "queue_item_id", "activity_id", "email_instance_id", "attempt_number", "status_code",
        "last_completed_stage",
    )


@query
def stored_request_prior(spark, sf):
    return log_store(spark, sf).request_prior(derived.requests(spark, sf)).select(
        "request_id", "activity_id", "prior_email_instance_id", "prior_attempt_number",
        "prior_last_completed_stage", "prior_agent_subject", "prior_crm_case_payload",
    )


@query
def stored_b1_write(spark, sf):
    """New attempts for all requests, from the table of latest attempts."""
    return as_double(log_store(spark, sf).b1_write(derived.requests(spark, sf)))


@query
def chk_activity_attempt_log(spark, sf):
    """Places of the log held by several rows: its failed attempts come twice."""
    log = derived.attempts(spark, sf)
    return quality.duplicate_keys(
        log.unionByName(lookups.failed(log)), ["activity_id", "attempt_number"]
    )


@query
def stored_fold_days(spark, sf):
    """Attempts stored without a stage, their events folded in by day, and the latest of them."""
    log = materialize(derived.attempts(spark, sf), "attempts")
    made = logstore.open_store(spark, "fold-store", 8)
    made.append(log.withColumn("last_completed_stage", F.lit(None).cast("string")), "0001")
    events = derived.stage_events(log).withColumn("email_instance_id", F.col("email_instance_id").cast("string"))
    for batch in ("0002", "0003"):
        made.fold(events, batch)
    shown = ["email_instance_id", "last_completed_stage", "status_code", "modified_date_time"]
    newest = made.latest().select(*shown, F.lit(True).alias("latest"))
    return made.log().select(*shown, F.lit(False).alias("latest")).unionByName(newest)


@query
def stored_feedback_days(spark, sf):
    made = log_store(spark, sf)
    cases = derived.case_snapshot(derived.attempt_rows(spark, sf))
    made.flag_feedback(cases, FIELDS, "0003")
    return made.log().select("email_instance_id", "crm_case_id", "banker_modified_flag")


@query
def stored_append_keys(spark, sf):
    """All attempts added to a store that has those of the first days: these are turned away."""
    log = materialize(derived.attempts(spark, sf), "attempts")
    made = logstore.open_store(spark, "key-store", 8)
    made.append(log.filter(F.col("created_date_time") < F.lit(CUTOFF).cast("timestamp_ntz")), "0001")
    made.append(log, "0002")
    stored = made.log().select("email_instance_id", F.lit(None).cast("string").alias("broken"))
    return stored.unionByName(made.rejected().select("email_instance_id", "broken"))


@query
def stored_without_parent(spark, sf):
    """Queue items without an attempt in the store."""
    items = derived.queue_items(spark, sf, ("view", "click", "signup"))
    return log_store(spark, sf).without_parent(items).select("queue_item_id", "activity_id")


@query
def status_view_all(spark, sf):
    """Every attempt with the computed columns, as stored."""
    return with_derived(derived.attempts(spark, sf)).select(
        "email_instance_id", "activity_id", "attempt_number", "failed_stage",
        "resume_processing_stage", "skip_queueitem_write", "status_description",
    )


def status_view_query(spark, sf):
    return as_double(status_view(derived.attempts(configure(spark), sf)))


QUERIES["status_view"] = status_view_query


# Streams


def attempt_stream(spark, sf):
    keyed = streams.event_stream(spark, sf).withColumn("activity_id", F.expr(derived.ACTIVITY))
    return derived.attempt_columns(keyed.filter("event_type <> 'view'"))


@query
def intake_source(spark, sf):
    messages = derived.intake_messages(streams.event_stream(spark, sf))
    return streams.collect_appended(intake.intake_source(messages), "intake")


@query
def stream_gate(spark, sf):
    keyed = streams.event_stream(spark, sf).withColumn("activity_id", F.expr(derived.ACTIVITY))
    items = derived.queue_item_columns(keyed.filter("event_type IN ('view', 'click')"))
    gated = recovery.gate_eval(items).filter("gate_result = 'Pass'")
    return streams.collect_appended(
        gated.select("queue_item_id", "activity_id", "gate_result"), "gate"
    )


@query
def stream_dedupe(spark, sf):
    """Every message comes twice, half an hour or three hours apart, over four batches.

    Of those three hours apart both stay, and so do both of the messages without an id.
    """
    once = derived.intake_messages(derived.events(spark, sf))
    event = F.col("message_id")
    once = once.withColumn("_part", event % 3)
    again = once.withColumns(
        {
            "enqueued_date_time": F.expr(
                "enqueued_date_time + IF(message_id % 2 = 0, INTERVAL 30 MINUTES, INTERVAL 3 HOURS)"
            ),
            "_part": F.col("_part") + F.floor(event / 3) % 2,
        }
    )
    both = once.unionByName(again).withColumn("message_id", F.when(event % 13 != 0, event))
    folder = shared_dir(spark, "dedupe")
    for live in streams.arriving(both, F.col("_part"), 4, "messages"):
        kept = intake.dedupe(
            live, ["message_id"], "enqueued_date_time", "1 hour", "dedupe", folder, span=24
        )
    return kept.select("message_id", "enqueued_date_time", "body")


@query
def stream_b1_write(spark, sf):
    folder = progress.open_log(derived.attempts(spark, sf), "attempts", buckets=8)
    asked = streams.event_stream(spark, sf).withColumn("activity_id", F.expr(derived.ACTIVITY))
    written = progress.write_attempts(derived.request_columns(asked), folder, buckets=8)
    return as_double(written).select("request_id", *b1.WRITTEN)


@query
def stream_stage_fold(spark, sf):
    moves = derived.stage_events(attempt_stream(spark, sf))
    return progress.fold_stages(moves, "stage_fold")


@query
def stream_status_windows(spark, sf):
    windows = progress.status_windows(attempt_stream(spark, sf), "1 day")
    return streams.collect_updated(
        windows, "windows", ["window_start", "window_end", "status_code"]
    )


@query
def stream_status_sliding(spark, sf):
    windows = progress.status_windows(attempt_stream(spark, sf), "12 hours", "6 hours")
    return streams.collect_updated(
        windows, "sliding", ["window_start", "window_end", "status_code"]
    )


@query
def stream_sessions(spark, sf):
    """Bursts of events that come in four batches, not in the order of time."""
    rows = derived.keyed_events(spark, sf).select("event_id", "activity_id", "ts")
    folder = shared_dir(spark, "session-events")
    for live in streams.arriving(rows, F.col("event_id") % 4, 4, "session-events"):
        found = progress.sessions(live, "2 hours", folder=folder)
    return found


def asked_and_answered(spark, sf):
    """Streams of messages and of attempts."""
    def keyed():
        return streams.event_stream(spark, sf).withColumn("activity_id", F.expr(derived.ACTIVITY))

    messages = keyed().filter("event_type IN ('view', 'click')").select(
        F.col("event_id").alias("message_id"), "activity_id", F.col("ts").alias("message_time")
    )
    answers = keyed().filter("event_type <> 'view'").select(
        "activity_id", F.col("ts").alias("attempt_time")
    )
    return messages, answers


@query
def stream_orphans(spark, sf):
    return progress.orphans(*asked_and_answered(spark, sf), hours=6, delay="1 hour")


@query
def stream_orphans_live(spark, sf):
    """The same, given out by the join of both streams as time passes."""
    return progress.orphans_live(*asked_and_answered(spark, sf), hours=6, delay="1 hour", span=24)


@query
def stream_stuck(spark, sf):
    moves = derived.stage_events(attempt_stream(spark, sf))
    return progress.stuck(moves, "2 hours", "1 hour")


@query
def stream_stuck_alarms(spark, sf):
    """Alarms of the engine's timers: bursts that are over for certain."""
    moves = derived.stage_events(attempt_stream(spark, sf))
    return alarms.stuck_alarms(moves, "2 hours", "1 hour")


@query
def stream_late(spark, sf):
    """Events that come in four batches, not in the order of time."""
    rows = derived.events(spark, sf).select("event_id", "ts")
    folder = shared_dir(spark, "late")
    for live in streams.arriving(rows, F.col("event_id") % 4, 4, "arrivals"):
        split = intake.split_late(live, "ts", "1 hour", "late", folder)
    return split.select("event_id", "late")
