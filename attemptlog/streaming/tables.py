"""Stream inputs, and sinks that survive a re-run batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attemptlog.session import children, exists, shared_dir
from attemptlog.sources.schemas import EVENTS

BATCH = "batch_id"


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None):
    """``events`` as a stream, with ``ts`` usable as event time."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/events*.parquet")


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Zone-less times cannot carry a watermark: read them as UTC instants."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def run_available(
    stream: DataFrame,
    folder: str,
    write: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
) -> None:
    """Process everything available.

    Without ``write`` every batch goes to ``folder/rows/batch_id=N``. Writing a batch
    again replaces its own folder, so a batch repeated after a failure changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write or store)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def arriving(
    rows: DataFrame, part: Column, parts: int, name: str
) -> Iterator[DataFrame]:
    """A stream over a folder into which ``rows`` come in parts, each before the next yield."""
    spark = rows.sparkSession
    folder = shared_dir(spark, name)
    for i in range(parts):
        rows.filter(part == i).write.mode("append").parquet(folder)
        yield spark.readStream.schema(rows.schema).parquet(folder)


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all batches, with the batch they came in."""
    return spark.read.option("mergeSchema", "false").parquet(f"{folder}/rows")


def micros(spark: SparkSession, interval: str) -> int:
    """The length of an interval such as ``1 hour``."""
    start = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    row = spark.sql(f"SELECT unix_micros(CAST({start} + INTERVAL '{interval}' AS TIMESTAMP)) AS n").first()
    return row["n"]


def piece_of(time: str, width: int) -> Column:
    """Which piece of ``width`` microseconds a time falls in."""
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(width)).cast("long")


HOUR = "hour"
HOUR_MICROS = 3_600_000_000


def hour_of(piece: Column, width: int, span: int = 1) -> Column:
    """The folder in which the rows of a piece of time are kept: its first hour of ``span``."""
    return (F.floor(piece * F.lit(width) / F.lit(span * HOUR_MICROS)) * span).cast("long")


def store_hours(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Keep rows with an ``hour`` in folders by hour, then batch; writing a batch again replaces it.

    Rebalancing writes one file an hour, more where an hour is large.
    """
    (
        rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .hint("rebalance", HOUR)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(HOUR, BATCH)
        .parquet(folder)
    )


def kept_hours(spark: SparkSession, folder: str) -> list[int]:
    """The hours that a folder has rows of, in order: as many as hours have passed."""
    names = [name.partition("=") for name in children(spark, folder)]
    return sorted(int(value) for key, _, value in names if key == HOUR)


def read_hours(spark: SparkSession, folder: str, hours: Iterable[int], schema: str) -> DataFrame:
    """The rows of some hours; folders of other hours are not listed."""
    paths = [path for h in sorted(set(hours)) if exists(spark, path := f"{folder}/{HOUR}={h}")]
    reader = spark.read.schema(f"{schema}, {HOUR} BIGINT, {BATCH} BIGINT").option("basePath", folder)
    if not paths:
        return spark.createDataFrame([], f"{schema}, {HOUR} BIGINT, {BATCH} BIGINT")
    return reader.parquet(*paths)


def collect_appended(stream: DataFrame, name: str) -> DataFrame:
    """Rows an append-mode stream emits."""
    spark = stream.sparkSession
    folder = shared_dir(spark, name)
    run_available(stream, folder)
    return read_rows(spark, folder).drop(BATCH)


def collect_updated(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The newest version of every row of an update-mode stream."""
    spark = stream.sparkSession
    folder = shared_dir(spark, name)
    run_available(stream, folder, mode="update")
    rows = read_rows(spark, folder)
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    return rows.groupBy(*keys).agg(*[F.max_by(v, BATCH).alias(v) for v in values])
