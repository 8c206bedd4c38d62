"""What the plans must and must not contain."""

import pathlib

import pytest

from attemptlog.plans.status_view import status_view
from attemptlog.operators import lookups, reports
from attemptlog.plans.b1_write import b1_write
from attemptlog.registry.queries import QUERIES
from attemptlog.sources import derived, tables
from attemptlog.sources.schemas import EMAIL_INSTANCE

from conftest import final_plan

PACKAGE = pathlib.Path(__file__).parent.parent / "attemptlog"
BATCH = [k for k in QUERIES if not k.startswith("stream_") and k not in ("intake_source", "lineage_chain")]


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "t")
    tables.conform(derived.attempts(spark, sf), EMAIL_INSTANCE).write.parquet(path)
    return tables.scan(spark, path, "email_instance")


@pytest.mark.parametrize("key", BATCH)
def test_no_python_and_no_cross_join(spark, sf, key):
    plan = QUERIES[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert word not in plan


def test_status_view_shuffles_once(stored):
    plan = final_plan(status_view(stored))
    assert plan.count("Exchange hashpartitioning") == 1


def test_worklist_shuffles_once_and_reads_what_it_needs(stored):
    from attemptlog.plans.recovery import recovery_worklist

    plan = final_plan(recovery_worklist(stored))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "agent_response" not in plan and "crm_case_payload" not in plan


def test_report_merges_before_the_shuffle(stored):
    plan = final_plan(reports.activity_summary(stored))
    assert "partial_min" in plan and plan.count("Exchange hashpartitioning") == 1


def test_failed_filter_reaches_the_scan(stored):
    plan = final_plan(lookups.failed(stored).select("activity_id", "status_code"))
    assert "EqualTo(status_code,9)" in plan
    assert "ReadSchema: struct<activity_id:string,status_code:int>" in plan


def test_writer_limits_the_rank(spark, sf, stored):
    plan = final_plan(b1_write(stored, derived.requests(spark, sf)))
    assert plan.count("WindowGroupLimit") >= 1


def test_sources_name_no_forbidden_calls():
    for path in PACKAGE.rglob("*.py"):
        text = path.read_text()
        for word in ("localCheckpoint", "crossJoin", "toPandas", ".rdd", "udf"):
            assert word not in text, (path, word)


def test_writer_ranks_only_what_is_requested(spark, sf, stored):
    """The rank sits above the semi-join to the activities asked for."""
    few = derived.requests(spark, sf).filter("request_id % 50 = 0")
    plan = final_plan(b1_write(stored, few))
    rank, semi = plan.rindex("WindowGroupLimit"), plan.rindex("LeftSemi")
    assert rank < semi, plan


def test_mixed_case_requests_meet_their_log(spark, tmp_path):
    from pyspark.sql import functions as F

    log = spark.createDataFrame(
        [("I1", " ACT-A", 1), ("i2", "act-a ", 2)],
        "email_instance_id string, activity_id string, attempt_number int",
    )
    path = str(tmp_path / "t")
    tables.conform(log, EMAIL_INSTANCE).write.parquet(path)
    asked = spark.createDataFrame([(1, "Act-A", "s")], "request_id int, activity_id string, banker_subject string")
    asked = asked.withColumn("requested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    new = b1_write(tables.scan(spark, path, "email_instance"), asked).first()
    assert (new["attempt_number"], new["previous_email_instance_id"]) == (3, "i2")


def test_replaced_days_leave_the_others(spark, tmp_path):
    from pyspark.sql import functions as F

    log = spark.range(40).select(
        F.col("id").cast("string").alias("email_instance_id"), F.lit("a").alias("activity_id"),
        F.lit(1).alias("attempt_number"), F.lit(1).alias("status_code"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 4)").alias("created_date_time"),
    )
    path = str(tmp_path / "days")
    tables.append(tables.conform(log, EMAIL_INSTANCE), path)
    before = {f.name for f in (tmp_path / "days" / "created_day=2024-01-02").iterdir()}
    for _ in range(2):
        now = tables.scan(spark, path, "email_instance")
        status = F.when(F.col("email_instance_id") == "0", 9).otherwise(1)
        changed = now.withColumn("status_code", status)
        day = tables.rows_of_days(changed, changed.filter("status_code = 9"))
        tables.replace_days(day, path)
    after = tables.scan(spark, path, "email_instance")
    assert after.count() == 40 and after.filter("status_code = 9").count() == 1
    assert {f.name for f in (tmp_path / "days" / "created_day=2024-01-02").iterdir()} == before
