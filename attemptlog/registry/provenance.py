"""How far each registered query is fixed by the tables' own definitions."""

from __future__ import annotations

# Semantics are written down as executable SQL.
RULED = """
    scan_email_instance scan_tracking scan_queue_item scan_email_attachment apply_defaults
    insert_first insert_retry insert_returning status_description resume_stage
    skip_queueitem failed_stage carry_forward attempts_of_activity chk_status chk_stage
    chk_details_json chk_payload_json chk_priority chk_gate chk_queue_status chk_not_null
    chk_pk chk_activity_attempt chk_correlation chk_fk_queue chk_fk_attachment chk_length
    latest_join route_requests request_prior max_attempt latest_attempt assign_attempts
    top_one json_value is_json try_cast_status b1_write status_view_all status_view
""".split()

# The need is stated in comments, columns or indexes; the semantics are our reading.
STATED = """
    version_union queue_item_union attachment_union queue_item_write written_items_not_null
    b1_write_other_case stage_fold_stored feedback_stored append_checked status_details_source failed_stage_norm stage_rank
    status_map tracking_status gate_eval failed_scan failed_by_stage_scan resume_scan
    correlation_lookup audit_range subject_filter lineage_lookup chk_sequence
    chk_raw_content quarantine orphans lineage_parent lineage_chain lineage_chain_clean
    queue_latest attachment_latest retry_counts failed_by_stage failed_by_resume
    status_counts banker_modified_rate attempt_history audit_page details_typed
    stored_attempts_of_activity stored_lineage_lookup stored_subject_filter stored_correlation_lookup
    stored_top_one stored_status_view stored_queue_latest stored_request_prior stored_fold_days
    stored_b1_write chk_activity_attempt_log stored_feedback_days stored_append_keys stored_without_parent
    status_details_rows recovery_worklist recovery_retry stage_fold feedback_detect
""".split()

# The data is there but not the operator; added because these tables invite it.
ADDED = """
    low_confidence stuck_scan failure_codes version_quality time_to_case queue_latency
    activity_summary status_rollup retry_gap last_retry json_project json_path_by_kind
    intake_source stream_gate stream_dedupe stream_b1_write stream_stage_fold
    stream_status_windows stream_status_sliding stream_sessions stream_orphans stream_orphans_live stream_stuck stream_stuck_alarms
    stream_late
""".split()

PROVENANCE = {
    **dict.fromkeys(RULED, "ruled"),
    **dict.fromkeys(STATED, "stated"),
    **dict.fromkeys(ADDED, "added"),
}
