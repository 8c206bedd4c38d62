"""Alarms that the engine's own state gives out: one for each burst that ended too early.

Two aggregates follow each other. The first lets an attempt's events through once the watermark has
passed them, and drops those that come later than it; the second merges them into bursts and gives
a burst out when the watermark has passed its idle span, so that nothing can reach it any more. Both keep their
state in the checkpoint: a run that goes on from one neither loses nor repeats an alarm. No row
leaves the engine, and finished bursts leave the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.stages import STAGES
from attemptlog.session import shared_dir
from attemptlog.streaming.tables import read_rows, run_available, with_event_time

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are kept to this; a window of one holds the events of one time.
TICK = "1 microsecond"


def stuck_alarms(events: DataFrame, idle: str, delay: str, folder: str | None = None) -> DataFrame:
    """Attempts that completed a stage, not the last one, and then nothing for ``idle``.

    A row comes out once the watermark (the newest event less ``delay``) has passed the idle
    span. Events later than the watermark take no part. ``folder`` goes on from earlier runs.
    """
    spark = events.sparkSession
    folder = folder or shared_dir(spark, "alarms")
    timed = with_event_time(events.select("email_instance_id", "stage_rank", "event_time"), "event_time", delay)
    reached = F.max("stage_rank").alias("stage_rank")
    once = timed.groupBy("email_instance_id", F.window("event_time", TICK)).agg(reached)
    passed = once.select("email_instance_id", "stage_rank", F.window_time("window").alias("event_time"))
    bursts = passed.groupBy("email_instance_id", F.session_window("event_time", idle)).agg(reached)
    over = bursts.filter(F.col("stage_rank") < len(STAGES)).select(
        "email_instance_id", "stage_rank", F.col("session_window.end").cast("timestamp_ntz").alias("stuck_since")
    )
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        run_available(over, folder)
    finally:
        spark.conf.set(STATE_STORE, before)
    return read_rows(spark, folder).select("email_instance_id", "stage_rank", "stuck_since")
