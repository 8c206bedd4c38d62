"""Batch jobs against row-by-row simulations and small hand-made logs."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from attemptlog.functions.identity import instance_id
from attemptlog.functions.stages import CARRY, STAGES
from attemptlog.operators import links, reports
from attemptlog.plans import folds, recovery
from attemptlog.plans.b1_write import WRITTEN, b1_write, insert_first, insert_retry, returning
from attemptlog.sources import derived, tables
from attemptlog.sources.schemas import EMAIL_INSTANCE

from conftest import final_plan, rows

RESUME = dict(zip(STAGES, ["B4", "B4", "B4", "B4", "B7", "B8", "B9"]))
LOG_DDL = (
    "email_instance_id string, activity_id string, attempt_number int, agent_subject string,"
    " agent_case_priority string, agent_case_description string, agent_response string,"
    " agent_action_flag boolean, agent_confidence_score decimal(5,4), crm_case_payload string,"
    " last_completed_stage string"
)
REQUEST_DDL = (
    "request_id long, activity_id string, banker_subject string, requested_at timestamp_ntz"
)


def random_log(rnd):
    log = []
    for a in range(40):
        for n in range(1, rnd.randrange(0, 6)):
            log.append(
                {
                    "email_instance_id": f"id-{a}-{n}",
                    "activity_id": f"act{a}",
                    "attempt_number": n,
                    **{
                        c: rnd.choice([f"{c}{a}{n}", None])
                        for c in CARRY
                        if c not in ("agent_action_flag", "agent_confidence_score")
                    },
                    "agent_action_flag": rnd.choice([True, False, None]),
                    "agent_confidence_score": rnd.choice([None, Decimal("0.1234")]),
                    "last_completed_stage": rnd.choice([*STAGES, None]),
                }
            )
    return log


def random_requests(rnd, n, first):
    start = datetime.datetime(2024, 5, 1)
    return [
        (first + i, f"act{rnd.randrange(55)}", rnd.choice([None, f"s{i}"]),
         start + datetime.timedelta(seconds=rnd.randrange(600)))
        for i in range(n)
    ]


def serve_one_by_one(log, requests, ids):
    """The writer's rules, applied to one request after another."""
    written = []
    for request_id, activity, subject, _ in sorted(requests, key=lambda r: (r[3], r[0])):
        prior = [r for r in log if r["activity_id"] == activity]
        row = {c: None for c in WRITTEN}
        row.update(activity_id=activity, banker_subject=subject, status_code=1)
        if prior:
            last = max(prior, key=lambda r: r["attempt_number"])
            point = RESUME.get(last["last_completed_stage"], "B1")
            row.update(
                attempt_number=last["attempt_number"] + 1,
                previous_email_instance_id=last["email_instance_id"],
                last_completed_stage=last["last_completed_stage"],
                **{c: last[c] for c, points in CARRY.items() if point in points},
            )
        else:
            row.update(attempt_number=1, last_completed_stage=STAGES[0])
        row["email_instance_id"] = ids[activity, row["attempt_number"]]
        log.append(row)
        written.append({"request_id": request_id, **row})
    return written


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_b1_write_equals_serving_one_by_one(spark, seed):
    rnd = random.Random(seed)
    known = spark.range(55).select(F.concat(F.lit("act"), "id").alias("a")).crossJoin(
        spark.range(1, 40).select(F.col("id").alias("n"))
    )
    ids = {
        (r["a"], r["n"]): r["i"]
        for r in known.select("a", "n", instance_id(F.col("a"), F.col("n")).alias("i")).collect()
    }
    log = random_log(rnd)
    names = [c.split()[0] for c in LOG_DDL.split(", ")]
    stored = spark.createDataFrame([tuple(r[c] for c in names) for r in log], LOG_DDL)
    for batch in range(2):
        asked = random_requests(rnd, 120, 1000 * batch)
        requests = spark.createDataFrame(asked, REQUEST_DDL)
        new = b1_write(stored, requests)
        want = serve_one_by_one(log, asked, ids)
        got = {r["request_id"]: r.asDict() for r in new.collect()}
        assert got == {r["request_id"]: r for r in want}
        stored = stored.unionByName(new.select(*stored.columns))


def test_first_attempt_then_retry(spark):
    """The writer's own smoke call: an unknown activity with no subject, twice."""
    empty = spark.createDataFrame([], LOG_DDL)
    asked = spark.createDataFrame(
        [(1, "11111111-1111-1111-1111-111111111111", None, datetime.datetime(2024, 1, 1))],
        REQUEST_DDL,
    )
    first = b1_write(empty, asked)
    row = first.first()
    assert (row["attempt_number"], row["status_code"], row["last_completed_stage"]) == (
        1, 1, STAGES[0],
    )
    assert row["previous_email_instance_id"] is None
    assert returning(first).first()["skip_queueitem_write"] is False
    again = b1_write(first.select(*empty.columns), asked).first()
    assert again["attempt_number"] == 2
    assert again["previous_email_instance_id"] == row["email_instance_id"]


def test_first_and_retry_partition_the_new_rows(spark, sf):
    new = b1_write(derived.attempts(spark, sf), derived.requests(spark, sf))
    assert insert_first(new).count() + insert_retry(new).count() == new.count()


def test_ids_are_shaped_like_guids_and_stable(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "a string, n int")
    made = df.select(instance_id(F.col("a"), F.col("n")).alias("i"))
    assert rows(made) == rows(made.repartition(3)) and len(set(rows(made))) == 2
    assert all(len(r[0]) == 36 and r[0].count("-") == 4 for r in rows(made))


WORK_DDL = (
    "activity_id string, email_instance_id string, attempt_number int, status_code int,"
    " crm_case_id string, last_completed_stage string, status_details string, max_retries int"
)


def test_worklist_rules(spark):
    log = spark.createDataFrame(
        [
            ("due", "d1", 1, 9, None, "B7_decision", '{"failed_stage":"B8_make_payload"}', 3),
            ("later-ok", "l1", 1, 9, None, None, None, 3),
            ("later-ok", "l2", 2, 4, None, None, None, 3),
            ("has-case", "h1", 1, 9, "case", None, None, 3),
            ("no-retry", "n1", 1, 10, None, None, None, 3),
            ("used-up", "u1", 1, 9, None, None, None, 1),
            ("used-up", "u2", 2, 9, None, None, None, None),
            ("no-limit", "x1", 1, 9, None, None, None, None),
            ("case-before", "c1", 1, 6, "case", None, None, 3),
            ("case-before", "c2", 2, 9, None, None, None, 3),
        ],
        WORK_DDL,
    )
    work = {r["activity_id"]: r for r in recovery.recovery_worklist(log).collect()}
    assert set(work) == {"due", "no-limit", "case-before"}
    assert tuple(work["due"])[3:] == ("B8", True, "B8_make_payload")
    assert {r[0] for r in recovery.recovery_worklist(log, max_retries=2).collect()} == {
        "due", "no-limit", "case-before", "used-up",
    }


def lineage(spark, pairs):
    log = spark.createDataFrame(pairs, "email_instance_id string, previous_email_instance_id string")
    return {r[0]: (r[1], r[2]) for r in links.lineage_chain(log).collect()}


def test_lineage_of_long_chains_trees_gaps_and_cycles(spark):
    pairs = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    pairs += [("t", None), *[(f"t{i}", "t") for i in range(20)]]
    pairs += [("lost2", "lost1"), ("lost3", "lost2")]
    pairs += [("x", "z"), ("y", "x"), ("z", "y"), ("w", "x")]
    got = lineage(spark, pairs)
    assert all(got[f"c{i}"] == ("c0", i + 1) for i in range(300))
    assert got["t"] == ("t", 1) and all(got[f"t{i}"] == ("t", 2) for i in range(20))
    assert got["lost2"] == ("lost2", 1) and got["lost3"] == ("lost2", 2)
    assert {got[k] for k in "xyzw"} == {(None, None)}


def test_lineage_without_retries(spark):
    assert lineage(spark, [("a", None)]) == {"a": ("a", 1)}


def test_lineage_forms_agree(spark, sf):
    log = derived.attempts(spark, sf)
    assert rows(links.lineage_chain(log)) == rows(links.lineage_chain_clean(log))


def test_stage_fold(spark):
    t = datetime.datetime
    log = spark.createDataFrame(
        [
            ("new", None, 1, t(2024, 1, 1)),
            ("ahead", "B8_make_payload", 5, t(2024, 1, 1)),
            ("failed", "B5_parse_email", 9, t(2024, 1, 1)),
            ("quiet", "B1_write_activity_id", 1, t(2024, 1, 1)),
        ],
        "email_instance_id string, last_completed_stage string, status_code int,"
        " modified_date_time timestamp_ntz",
    )
    events = spark.createDataFrame(
        [
            ("new", 1, t(2024, 1, 2)), ("new", 3, t(2024, 1, 4)), ("new", 2, t(2024, 1, 3)),
            ("new", 3, t(2024, 1, 4)), ("ahead", 2, t(2023, 1, 1)), ("failed", 5, t(2024, 1, 5)),
        ],
        "email_instance_id string, stage_rank int, event_time timestamp_ntz",
    )
    got = {r[0]: tuple(r)[1:] for r in folds.stage_fold(log, events).collect()}
    assert got == {
        "new": ("B4_data_pull_dataverse", 2, t(2024, 1, 4)),
        "ahead": ("B8_make_payload", 5, t(2024, 1, 1)),
        "failed": ("B6_invoke_agent_workflow", 9, t(2024, 1, 5)),
        "quiet": ("B1_write_activity_id", 1, t(2024, 1, 1)),
    }


def test_feedback(spark):
    log = spark.createDataFrame(
        [
            ("same", "c1", "s", "p", False), ("edited", "c2", "s", "p", False),
            ("cleared", "c3", "s", "p", False), ("both-null", "c4", None, "p", False),
            ("unseen", "c5", "s", "p", False), ("flagged", "c6", "s", "p", True),
            ("no-case", None, "s", "p", False),
        ],
        "email_instance_id string, crm_case_id string, agent_subject string,"
        " agent_case_priority string, banker_modified_flag boolean",
    )
    cases = spark.createDataFrame(
        [("c1", "s", "p"), ("c2", "new", "p"), ("c3", None, "p"), ("c4", None, "p"),
         ("c6", "s", "p")],
        "crm_case_id string, case_subject string, case_priority string",
    )
    fields = {"agent_subject": "case_subject", "agent_case_priority": "case_priority"}
    got = {r[0]: (r[2], r[3]) for r in folds.feedback_detect(log, cases, fields).collect()}
    assert got == {
        "same": (False, False), "edited": (True, True), "cleared": (True, True),
        "both-null": (False, False), "unseen": (False, False), "flagged": (False, True),
    }


def test_status_counts_use_the_latest_attempt(spark):
    log = spark.createDataFrame(
        [("a", 1, 9), ("a", 2, 6), ("b", 1, 9), ("c", 1, None)],
        "activity_id string, attempt_number int, status_code int",
    )
    got = {r[0]: r[1] for r in reports.status_counts(log).collect()}
    assert got == {6: 1, 9: 1, None: 1}


# Storage


def test_log_round_trip(spark, sf, tmp_path):
    path = str(tmp_path / "log")
    log = tables.conform(derived.attempts(spark, sf), EMAIL_INSTANCE)
    tables.append(log, path)
    requests = derived.requests(spark, sf)
    new = tables.insertable(b1_write(tables.scan(spark, path, "email_instance"), requests))
    tables.append(new.select(*EMAIL_INSTANCE.names), path)
    grown = tables.scan(spark, path, "email_instance")
    assert grown.count() == log.count() + requests.count()
    assert grown.groupBy("activity_id", "attempt_number").count().filter("count > 1").count() == 0
    some = tables.scan_range(spark, path, "2024-01-03 06:00:00", "2024-01-04")
    plan = final_plan(some)
    assert "PartitionFilters: [isnotnull(created_day" in plan
    assert "PushedFilters: [IsNotNull(created_date_time), GreaterThanOrEqual(" in plan
    inside = "created_date_time >= '2024-01-03 06:00:00' AND created_date_time < '2024-01-04'"
    assert rows(some) == rows(grown.filter(inside))


def test_scan_of_every_layout(spark, sf, tmp_path):
    total = 0
    for version, df in derived.history(spark, sf).items():
        path = str(tmp_path / version)
        df.write.parquet(path)
        back = tables.scan_version(spark, path, version)
        assert back.columns == [*tables.WITH_OLDER.names, "schema_version"]
        assert back.filter("activity_id IS NULL OR attempt_number IS NULL").count() == 0
        total += back.count()
    assert total > 500


def test_ids_are_canonical_in_any_layout(spark):
    old = spark.createDataFrame(
        [(" AbC ", 2, "FAILED "), ("abc", 0, "Bogus")],
        "ActivityId string, RetryCount int, StatusCode string",
    )
    got = [tuple(r) for r in tables.to_canonical(old, "v1").select(
        "activity_id", "attempt_number", "status_code").collect()]
    assert got == [("abc", 3, 9), ("abc", 1, None)]


def test_defaults_fill_only_missing_columns(spark):
    df = spark.createDataFrame([("a", None)], "activity_id string, banker_modified_flag boolean")
    got = tables.apply_defaults(df, "email_instance", ["activity_id"], "2024-01-01 00:00:00")
    row = got.first()
    assert row["banker_modified_flag"] is None and row["attempt_number"] == 1
    assert row["created_date_time"] == datetime.datetime(2024, 1, 1)
    item = tables.apply_defaults(df, "queue_item").first()
    assert (item["gate_result"], item["queue_status_code"]) == ("Pending", "Enqueued")
    assert tables.apply_defaults(df, "legacy").first()["StatusCode"] == "Received"
    now = tables.apply_defaults(df, "tracking").first()["CreatedAt"]
    assert abs((datetime.datetime.now(datetime.UTC).replace(tzinfo=None) - now).total_seconds()) < 60
