"""Times headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Keys starting with ``stored_`` read an attempt log written once before the timing; the
others derive the log from ``events`` on every run. Each time is the median of the runs
after a warm-up run, rows going to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from attemptlog.operators import latest, quality, reports
from attemptlog.plans.b1_write import b1_write
from attemptlog.plans.logstore import open_store
from attemptlog.plans.recovery import recovery_worklist
from attemptlog.plans.status_view import status_view, with_derived
from attemptlog.registry.queries import QUERIES
from attemptlog.session import configure, shared_dir
from attemptlog.sources import derived, tables
from attemptlog.sources.schemas import EMAIL_INSTANCE

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
HEADLINE = (
    "status_view", "latest_attempt", "latest_join", "b1_write", "recovery_worklist",
    "activity_summary", "status_counts", "status_rollup", "chk_details_json", "chk_sequence",
    "chk_activity_attempt", "chk_length", "queue_latest", "lineage_parent", "retry_gap",
    "stage_fold", "time_to_case", "version_quality", "failed_scan", "json_value",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("attemptlog-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED", tempfile.mkdtemp(prefix="run-")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stored_queries(spark: SparkSession) -> dict:
    path = shared_dir(spark, "bench-log")
    tables.conform(derived.attempts(spark, SF_DIR), EMAIL_INSTANCE).repartition(
        int(CPUS), "created_date_time"
    ).write.parquet(path)
    log = tables.scan(spark, path, "email_instance")
    asked = derived.requests(spark, SF_DIR)
    few = asked.filter("request_id % 1000 = 0")
    store = open_store(spark, "bench-store", int(CPUS))
    store.append(derived.attempts(spark, SF_DIR), "0001")
    one = store.log().filter("activity_id = '7-2024-01-05'")
    unknown = store.log().filter("email_instance_id = '1000000007'")
    return {
        "stored_status_view": lambda: status_view(log),
        "stored_latest_window": lambda: latest.latest_attempt(log),
        "stored_latest_join": lambda: latest.latest_join(log),
        "stored_latest_packed": lambda: latest.latest_columns(
            log, [c for c in log.columns if c != "activity_id"]
        ),
        "stored_b1_write": lambda: b1_write(log, asked),
        "stored_b1_write_few": lambda: b1_write(log, few),
        "stored_worklist": lambda: recovery_worklist(log),
        "stored_summary": lambda: reports.activity_summary(log),
        "stored_sequence": lambda: quality.sequence_breaks(log),
        "stored_retry_gap": lambda: latest.retry_gap(log),
        "stored_computed_columns": lambda: with_derived(log),
        "store_status_view": store.status_view,
        "store_b1_write": lambda: store.b1_write(asked),
        "store_b1_write_few": lambda: store.b1_write(few),
        "store_one_activity": lambda: one,
        "store_unknown_id": lambda: unknown,
    }


def timed(build) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def main() -> None:
    spark = session()
    work = {name: (lambda n=name: QUERIES[n](spark, SF_DIR)) for name in HEADLINE}
    work.update(stored_queries(spark))
    seconds = {name: timed(build) for name, build in work.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
