"""Attempts as they move: new attempts, stage progress, windows, sessions, alarms."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from attemptlog.functions.stages import STAGES
from attemptlog.operators.lookups import attempts_of_activity
from attemptlog.operators.skew import join_unique, order_within, running_sum
from attemptlog.plans.b1_write import b1_write
from attemptlog.plans.folds import stage_progress
from attemptlog.session import shared_dir
from attemptlog.sources.schemas import EMAIL_INSTANCE
from attemptlog.sources.tables import apply_defaults, conform
from attemptlog.streaming.tables import (
    BATCH,
    HOUR,
    HOUR_MICROS,
    hour_of,
    kept_hours,
    micros,
    piece_of,
    read_hours,
    read_rows,
    run_available,
    store_hours,
    with_event_time,
)

BUCKET = "activity_bucket"
BUCKETS = 256
STORED = StructType([*EMAIL_INSTANCE.fields, StructField("request_id", StringType())])


def log_rows(df: DataFrame) -> DataFrame:
    """Rows in the stored form: the log's columns and the request they answer."""
    request = F.col("request_id") if "request_id" in df.columns else F.lit(None)
    return conform(df.withColumn("request_id", request.cast("string")), STORED)


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Add the bucket of each row's activity."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64("activity_id"), F.lit(buckets)).cast("int"))


def store_batch(rows: DataFrame, folder: str, batch_id: int, buckets: int) -> None:
    """Replace one batch of a stored log, split by activity bucket.

    Rebalancing keeps files few and cuts a bucket that a busy activity makes too large.
    """
    (
        bucketed(log_rows(rows), buckets)
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{folder}/rows/{BATCH}={batch_id}")
    )


def open_log(log: DataFrame, name: str, buckets: int = BUCKETS) -> str:
    """Store ``log`` as a table that micro-batches append to; returns its folder."""
    folder = shared_dir(log.sparkSession, name)
    store_batch(log, folder, -1, buckets)
    return folder


def write_attempts(requests: DataFrame, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Answer each micro-batch of requests with its new attempts; returns those.

    A batch reads only the buckets its activities fall in, without its own output, and
    replaces that output. Ids come from (activity, attempt): repeating a batch leaves the
    same rows.
    """
    spark = requests.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        asked = batch.select("activity_id").distinct()
        # At most ``buckets`` numbers.
        hit = [row[BUCKET] for row in bucketed(asked, buckets).select(BUCKET).distinct().collect()]
        stored = read_rows(batch.sparkSession, folder).filter(
            (F.col(BATCH) < batch_id) & F.col(BUCKET).isin(hit)
        )
        log = attempts_of_activity(stored, asked)
        new_rows = apply_defaults(b1_write(log, batch), "email_instance")
        store_batch(new_rows, folder, batch_id, buckets)

    run_available(requests, folder, write)
    return read_rows(spark, folder).filter(F.col(BATCH) >= 0).drop(BATCH, BUCKET)


def fold_stages(events: DataFrame, name: str) -> DataFrame:
    """Highest stage and last time per attempt.

    Each batch is folded on its own and stored; a maximum of maxima needs no state store.
    """
    spark = events.sparkSession
    folder = shared_dir(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        stage_progress(batch).write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={batch_id}")

    run_available(events, folder, write)
    return stage_progress(read_rows(spark, folder))


def status_windows(
    attempts: DataFrame, size: str, slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Attempts per status and time window, tumbling or sliding."""
    timed = with_event_time(attempts, "created_date_time", delay)
    return (
        timed.groupBy(F.window("created_date_time", size, slide), "status_code")
        .agg(F.count(F.lit(1)).alias("attempts"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "status_code",
            "attempts",
        )
    )


def _newest(spark, rows: DataFrame, time: str, delay: str) -> Column:
    """The newest stored time less ``delay``: what lies behind it is settled."""
    limit = rows.agg((F.max(time) - F.expr(f"INTERVAL '{delay}'")).alias("limit")).first()["limit"]
    return F.lit(limit).cast("timestamp_ntz")


def bursts(
    events: DataFrame,
    key: str,
    time: str,
    gap: str,
    delay: str,
    name: str,
    highest: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Runs of a key's events less than ``gap`` apart: key, session_start, session_end, events.

    Events of a key within one piece of time as long as the gap always belong together, so each
    batch is folded to one row per key and piece, in the map tasks first, and stored. Pieces
    are chained into runs when they are read: neither events nor pieces of a busy key meet in one
    task, and there is no state to keep or to lose. A run that ended less than ``delay`` before the
    newest event may still grow: it is marked as open. ``highest`` names a column whose
    greatest value each run gets; ``folder`` goes on from earlier runs.
    """
    spark = events.sparkSession
    folder = folder or shared_dir(spark, name)
    width = micros(spark, gap)
    extra = [F.max(highest).alias(highest)] if highest else []

    def write(batch: DataFrame, batch_id: int) -> None:
        in_pieces(batch, key, time, width, extra).write.mode("overwrite").parquet(
            f"{folder}/rows/{BATCH}={batch_id}"
        )

    run_available(events, folder, write)
    stored = read_rows(spark, folder).drop(BATCH)
    settled = _newest(spark, stored, "last", delay)
    pieces = stored.groupBy(key, "piece").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events"), *extra
    )
    length = F.expr(f"INTERVAL '{gap}'")
    cuts = [F.floor(F.col("piece") / n) for n in PIECES_TOGETHER]
    chained = order_within(pieces, [key], ["piece"], cuts, "_n", {"_ended": "last"})
    begins = F.col("_ended").isNull() | (F.col("first") >= F.col("_ended") + length)
    chained = chained.withColumn("_begins", begins.cast("int"))
    numbered = running_sum(chained, [key], ["piece"], cuts, "_begins", "_run")
    return (
        numbered.groupBy(key, "_run")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + length).alias("session_end"),
            F.sum("events").alias("events"),
            *extra,
        )
        .drop("_run")
        .withColumn("open", F.col("session_end") > settled)
    )


#: Pieces of a key that one task puts in order, by levels.
PIECES_TOGETHER = (1 << 20, 1 << 10)


def in_pieces(events: DataFrame, key: str, time: str, width: int, extra: list[Column]) -> DataFrame:
    """Events per key and piece of time: first and last of them, and how many."""
    return (
        events.filter(F.col(time).isNotNull())
        .groupBy(key, piece_of(time, width).alias("piece"))
        .agg(
            F.min(time).alias("first"),
            F.max(time).alias("last"),
            F.count(F.lit(1)).alias("events"),
            *extra,
        )
    )


def sessions(
    events: DataFrame, gap: str, delay: str = "1 hour", folder: str | None = None
) -> DataFrame:
    """Bursts of an activity's events, also those still open."""
    return bursts(events, "activity_id", "ts", gap, delay, "sessions", folder=folder)


def orphans(messages: DataFrame, attempts: DataFrame, hours: int, delay: str) -> DataFrame:
    """Messages followed by no attempt of their activity within ``hours``.

    Of the attempts of an activity in one time bucket only the first and the last decide: a
    message is answered if the last one in its own bucket is not before it, or the first one
    in the next bucket is within its time. So attempts are folded per batch and bucket, and
    each message meets two rows. A message whose time is not over is marked as open.
    """
    spark = messages.sparkSession
    asked_in, answered_in = shared_dir(spark, "asked"), shared_dir(spark, "answered")
    width = hours * 3600

    def bucket(column: str) -> Column:
        return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / width).alias("_bucket")

    def ends(rows: DataFrame, first: str, last: str) -> DataFrame:
        return rows.groupBy("activity_id", "_bucket").agg(
            F.min(first).alias("first"), F.max(last).alias("last")
        )

    def fold(batch: DataFrame, batch_id: int) -> None:
        placed = batch.select("activity_id", bucket("attempt_time"), "attempt_time")
        ends(placed, "attempt_time", "attempt_time").write.mode("overwrite").parquet(
            f"{answered_in}/rows/{BATCH}={batch_id}"
        )

    run_available(messages, asked_in)
    run_available(attempts, answered_in, fold)
    asked = read_rows(spark, asked_in).select("message_id", "activity_id", "message_time")
    answered = ends(read_rows(spark, answered_in), "first", "last")
    settled = F.least(
        _newest(spark, asked, "message_time", delay), _newest(spark, answered, "last", delay)
    )
    until = F.col("message_time") + F.expr(f"INTERVAL {hours} HOURS")
    return _unanswered(asked.withColumn("_bucket", bucket("message_time")), answered, until).select(
        "message_id", "activity_id", "message_time", (until >= settled).alias("open")
    )


def _unanswered(asked: DataFrame, answered: DataFrame, until: Column) -> DataFrame:
    """Messages that neither the last attempt of their bucket nor the first of the next answers."""
    here = answered.select("activity_id", "_bucket", F.col("last").alias("_last"))
    next_ = answered.select("activity_id", F.col("_bucket") - 1, F.col("first").alias("_first"))
    next_ = next_.toDF("activity_id", "_bucket", "_first")
    keys = ["activity_id", "_bucket"]
    met = join_unique(join_unique(asked, here, keys, "left"), next_, keys, "left")
    answer = (F.col("_last") >= F.col("message_time")) | (F.col("_first") <= until)
    return met.filter(~F.coalesce(answer, F.lit(False)))


def orphans_live(
    messages: DataFrame, attempts: DataFrame, hours: int, delay: str, span: int = 1
) -> DataFrame:
    """Messages followed by no attempt within ``hours``, each given out when its time is over.

    An outer join of both streams within their time bound: the engine keeps a message until the
    watermark (the newest time of both streams less ``delay``) has passed its time, and gives it
    out if nothing answered it; nothing older is kept or read again. Rows that come later than
    the watermark take no part. Messages whose time is not over at the end of the run are
    marked as open; for them only the hours within reach are read. ``span`` hours share a folder.
    """
    spark = messages.sparkSession
    out, asked_in, answered_in = (shared_dir(spark, n) for n in ("orphans", "asked", "answered"))
    length = f"INTERVAL {hours} HOURS"
    asked = with_event_time(messages, "message_time", delay)
    answers = with_event_time(attempts, "attempt_time", delay).withColumnRenamed("activity_id", "_activity")
    within = F.expr(
        f"activity_id = _activity AND attempt_time >= message_time AND attempt_time <= message_time + {length}"
    )
    lost = asked.join(answers, within, "leftOuter").filter("attempt_time IS NULL")
    run_available(lost.select("message_id", "activity_id", "message_time"), out)
    _keep_hours(messages, "message_time", hours, asked_in, span)
    _keep_hours(attempts, "attempt_time", hours, answered_in, span)
    asked, asked_to = _since(messages, "message_time", asked_in, delay, span)
    answered, answered_to = _since(attempts, "attempt_time", answered_in, delay, span)
    # Watermarks count whole milliseconds; without one, nothing is settled.
    settled = min(asked_to, answered_to) if asked_to and answered_to else None
    settled = settled and settled.replace(microsecond=settled.microsecond // 1000 * 1000)
    since = settled and settled - datetime.timedelta(hours=2 * hours)
    until = F.col("message_time") + F.expr(length)
    rest = asked(since).filter(F.lit(True) if settled is None else until >= F.lit(settled))
    ends = answered(since).groupBy("activity_id", "_bucket").agg(
        F.min("attempt_time").alias("first"), F.max("attempt_time").alias("last")
    )
    columns = ["message_id", "activity_id", F.col("message_time").cast("timestamp_ntz").alias("message_time")]
    still = _unanswered(rest, ends, until).select(*columns, F.lit(True).alias("open"))
    given = read_rows(spark, out).select(*columns, F.lit(False).alias("open"))
    return given.unionByName(still)


def _keep_hours(stream: DataFrame, time: str, hours: int, folder: str, span: int) -> None:
    """Keep a stream's rows by hour, with the bucket of ``hours`` that they fall in."""
    width = hours * 3_600_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.filter(F.col(time).isNotNull()).withColumn("_bucket", piece_of(time, width))
        hour = hour_of(piece_of(time, HOUR_MICROS), HOUR_MICROS, span)
        store_hours(placed.withColumn(HOUR, hour), f"{folder}/kept", batch_id)

    run_available(stream, folder, write)


def _since(stream: DataFrame, time: str, folder: str, delay: str, span: int):
    """A reader of kept rows from a time on, and the newest time of all less ``delay``."""
    spark, kept = stream.sparkSession, f"{folder}/kept"
    schema = ", ".join(f"`{c}` {kind}" for c, kind in stream.dtypes) + ", _bucket BIGINT"
    hours = kept_hours(spark, kept)
    newest = F.max(time) - F.expr(f"INTERVAL '{delay}'")
    last = read_hours(spark, kept, hours[-1:], schema).agg(newest.alias("t")).first()["t"]

    def rows(since: datetime.datetime | None) -> DataFrame:
        first = None if since is None else (since - datetime.datetime(1970, 1, 1)) // datetime.timedelta(hours=1)
        reach = [h for h in hours if first is None or h + span > first]
        return read_hours(spark, kept, reach, schema)

    return rows, last


def stuck(events: DataFrame, idle: str, delay: str) -> DataFrame:
    """Attempts that completed a stage, not the last one, and then nothing for ``idle``.

    An attempt's progress is a burst, which ends the idle time after its last event; while
    that is open the attempt may still move.
    """
    runs = bursts(events, "email_instance_id", "event_time", idle, delay, "stuck", "stage_rank")
    return runs.filter(F.col("stage_rank") < len(STAGES)).select(
        "email_instance_id", "stage_rank", F.col("session_end").alias("stuck_since"), "open"
    )
