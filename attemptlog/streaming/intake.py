"""Arriving messages: parsing, gates, duplicates and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.functions.identity import canonical_id
from attemptlog.operators.skew import join_unique, order_within, time_pieces
from attemptlog.session import exists, shared_dir
from attemptlog.streaming.tables import (
    BATCH,
    HOUR,
    hour_of,
    micros,
    piece_of,
    read_hours,
    read_rows,
    run_available,
    store_hours,
)

BODY = "activity_id STRING, subject STRING, _corrupt STRING"


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """Messages dropped as JSON lines into a folder."""
    return spark.readStream.schema(
        "message_id STRING, enqueued_date_time TIMESTAMP_NTZ, body STRING"
    ).json(path)


def intake_source(messages: DataFrame) -> DataFrame:
    """Typed messages; a body that is not JSON or names no activity is not accepted."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return messages.withColumn("_body", F.from_json("body", BODY, options)).select(
        "message_id",
        "enqueued_date_time",
        canonical_id(F.col("_body.activity_id")).alias("activity_id"),
        F.col("_body.subject").alias("subject"),
        (F.col("_body.activity_id").isNotNull() & F.col("_body._corrupt").isNull()).alias(
            "accepted"
        ),
    )


def dedupe(
    messages: DataFrame,
    key: list[str],
    time: str,
    delay: str,
    name: str,
    folder: str | None = None,
    span: int = 1,
) -> DataFrame:
    """Messages without the repeats of one key.

    A message is a repeat if the one of its key just before it, kept or not, lies no more
    than ``delay`` back; of equal times the lower hash of the row comes first. So it does not
    matter where batches end, as long as they come in the order of time. Messages without a
    key or a time are never repeats. ``folder`` goes on from earlier runs.

    Seen keys are kept by hour: per key and piece of time as long as ``delay`` the first and the
    last time. A message is met by its own piece and the one before it, so a batch opens only the
    hours of these, and a busy key meets two rows of each. ``span`` hours share a folder; where
    a batch covers days it should be longer, so that folders are fewer.
    """
    spark = messages.sparkSession
    folder = folder or shared_dir(spark, name)
    columns, known = messages.columns, [*key, time]
    if not exists(spark, f"{folder}/rows"):
        spark.createDataFrame([], messages.schema).write.parquet(f"{folder}/rows/{BATCH}=-1")
    width, reach = micros(spark, delay), F.expr(f"INTERVAL '{delay}'")
    kinds = dict(messages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in key)
    schema += f", _piece BIGINT, _first {kinds[time]}, _last {kinds[time]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        session, whole = batch.sparkSession, F.lit(True)
        for c in known:
            whole = whole & F.col(c).isNotNull()
        named = batch.filter(whole).withColumn("_tie", F.xxhash64(*columns))
        ordered = order_within(
            named, key, [time, "_tie"], time_pieces(named, time, "_tie"), "_n", {"_before": time}
        )
        alone = F.col("_before").isNull() | (F.col("_before") < F.col(time) - reach)
        placed = batch.filter(whole).withColumn("_piece", piece_of(time, width))
        back = [hour_of(F.col("_piece") - i, width, span) for i in (0, 1)]
        # As many rows as the batch touches hours.
        hours = placed.select(F.explode(F.array(*back)).alias(HOUR)).distinct().collect()
        seen = (
            read_hours(session, f"{folder}/seen", [row[HOUR] for row in hours], schema)
            .filter(F.col(BATCH) < batch_id)
            .groupBy(*key, "_piece")
            .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        )
        keys = [*key, "_piece"]
        heads = ordered.filter(alone).withColumn("_piece", piece_of(time, width))
        before = seen.select(*key, (F.col("_piece") + 1).alias("_piece"), F.col("_last").alias("_earlier"))
        met = join_unique(join_unique(heads, seen.drop("_last"), keys, "left"), before, keys, "left")
        repeat = (F.col("_first") <= F.col(time)) | (F.col("_earlier") >= F.col(time) - reach)
        kept = met.filter(~F.coalesce(repeat, F.lit(False))).select(*columns)
        kept.unionByName(batch.filter(~whole)).write.mode("overwrite").parquet(
            f"{folder}/rows/{BATCH}={batch_id}"
        )
        spans = placed.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
        store_hours(spans.withColumn(HOUR, hour_of(F.col("_piece"), width, span)), f"{folder}/seen", batch_id)

    run_available(messages, folder, write)
    return read_rows(spark, folder).drop(BATCH)


def split_late(
    stream: DataFrame, time: str, delay: str, name: str, folder: str | None = None
) -> DataFrame:
    """All rows, with the ones marked that a watermark would drop silently.

    A row is late if its time lies more than ``delay`` before the newest time of the
    batches before its own. The newest time of each batch is kept in the shared folder.
    ``folder`` goes on from earlier runs.
    """
    spark = stream.sparkSession
    first = folder is None or not exists(spark, f"{folder}/seen")
    folder = folder or shared_dir(spark, name)
    seen_schema = f"newest TIMESTAMP_NTZ, {BATCH} INT"
    if first:
        none = spark.createDataFrame([], "newest TIMESTAMP_NTZ")
        none.write.parquet(f"{folder}/seen/{BATCH}=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = session.read.schema(seen_schema).parquet(f"{folder}/seen")
        newest = seen.filter(F.col(BATCH) < batch_id).agg(
            (F.max("newest") - F.expr(f"INTERVAL '{delay}'")).alias("limit")
        )
        limit = newest.first()["limit"]
        late = F.lit(False) if limit is None else F.col(time) < F.lit(limit)
        target = f"{folder}/rows/{BATCH}={batch_id}"
        batch.withColumn("late", F.coalesce(late, F.lit(False))).write.mode("overwrite").parquet(
            target
        )
        session.read.parquet(target).agg(F.max(time).alias("newest")).write.mode(
            "overwrite"
        ).parquet(f"{folder}/seen/{BATCH}={batch_id}")

    run_available(stream, folder, write)
    return read_rows(spark, folder)
