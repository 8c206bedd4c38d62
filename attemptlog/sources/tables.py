"""Typed reads, appends and default values of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from attemptlog.functions.identity import canonical_id, instance_id, named_id
from attemptlog.functions.stages import (
    CASE_CREATED,
    FAILED,
    RECEIVED,
    STAGES,
    canonical_name,
    status_code_of,
)
from attemptlog.plans.status_view import with_derived
from attemptlog.session import materialize
from attemptlog.sources.schemas import (
    DEFAULTS,
    EMAIL_INSTANCE,
    LAYOUTS,
    ONLY_OLDER,
    OTHER_LAYOUTS,
    TABLES,
)

DAY = "created_day"
WITH_OLDER = StructType([*EMAIL_INSTANCE.fields, *ONLY_OLDER.fields])
ID_COLUMNS = (
    "email_instance_id",
    "activity_id",
    "previous_email_instance_id",
    "correlation_id",
    "crm_case_id",
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Give ``df`` the columns and types of ``schema``; missing columns are NULL."""
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in df.columns else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS {f.name}"
            for f in schema
        ]
    )


def canonical(df: DataFrame) -> DataFrame:
    """Ids and stage names in their one spelling, for rows that come in from outside."""
    spelled = {c: canonical_id(F.col(c)) for c in ID_COLUMNS if c in df.columns}
    if "last_completed_stage" in df.columns:
        stage = F.col("last_completed_stage")
        spelled["last_completed_stage"] = canonical_name(stage, STAGES)
    return df.withColumns(spelled) if spelled else df


# A status of the tracking table stands for one of the codes it was collapsed from.
TRACKING_CODE = f"""CASE lower(rtrim({{}})) WHEN 'inprogress' THEN {RECEIVED}
WHEN 'completed' THEN {CASE_CREATED} WHEN 'failed' THEN {FAILED} END"""


def to_canonical(df: DataFrame, version: str) -> DataFrame:
    """Rows of any layout as attempts of the current one, tagged with their version."""
    layout = LAYOUTS[version]
    present = {c: old for c, old in layout.columns.items() if old in df.columns}
    if not layout.per_attempt:
        present["attempt_number"] += " + 1"
    if layout.status != "code":
        present["status_text"] = layout.columns["status_code"]
    if layout.status == "tracking":
        present["status_code"] = TRACKING_CODE.format(present["status_code"])
    named = canonical(df.selectExpr(*[f"{v} AS {c}" for c, v in present.items()]))
    if layout.status == "name":
        named = named.withColumn("status_code", status_code_of(F.col("status_code")))
    if "email_instance_id" not in present:
        own = instance_id(F.col("activity_id"), F.col("attempt_number").cast("int"))
        named = named.withColumn("email_instance_id", own)
    return conform(named, WITH_OLDER).withColumn("schema_version", F.lit(version))


def other_union(frames: dict[str, DataFrame], table: str) -> DataFrame:
    """One table of queue items or attachments from frames in several layouts."""
    parts = []
    for version, df in frames.items():
        columns = OTHER_LAYOUTS[table][version]
        named = df.selectExpr(*[f"{old} AS {c}" for c, old in columns.items() if old in df.columns])
        typed = conform(canonical(named), TABLES[table])
        parts.append(typed.withColumn("schema_version", F.lit(version)))
    return reduce(DataFrame.unionByName, parts)


def version_union(frames: dict[str, DataFrame]) -> DataFrame:
    """One attempt log from tables of several layouts."""
    first, *rest = [to_canonical(df, version) for version, df in frames.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


def scan(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed read of a current-layout table, ids and stages in their one spelling."""
    schema = TABLES[table]
    return canonical(spark.read.schema(schema).parquet(path).select(*schema.names))


def scan_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Read a log written in any layout, conformed."""
    return to_canonical(spark.read.parquet(path), version)


def apply_defaults(
    df: DataFrame, table: str, id_parts: list[str] | None = None, now: str | None = None
) -> DataFrame:
    """Fill the columns an insert left out; explicit NULLs stay.

    Ids are named after ``id_parts``, the columns that identify the row.
    """
    clock = F.current_timestamp() if now is None else F.lit(now)
    fills = {}
    for column, value in DEFAULTS[table].items():
        if column in df.columns:
            continue
        if value == "id":
            fills[column] = named_id(*[F.col(p) for p in id_parts])
        elif value == "now":
            fills[column] = clock.cast("timestamp_ntz")
        else:
            fills[column] = F.lit(value)
    return df.withColumns(fills) if fills else df


def insertable(new_rows: DataFrame, now: str | None = None) -> DataFrame:
    """New attempts as full log rows with defaults and computed columns."""
    filled = apply_defaults(new_rows, "email_instance", ["activity_id", "attempt_number"], now)
    return with_derived(conform(filled, EMAIL_INSTANCE))


def append(df: DataFrame, path: str) -> None:
    """Append to a log laid out by creation day, so that audit ranges prune.

    Rebalancing writes few files per day and cuts the days that are large.
    """
    (
        df.withColumn(DAY, F.to_date("created_date_time"))
        .hint("rebalance", DAY)
        .write.mode("append")
        .partitionBy(DAY)
        .parquet(path)
    )


def scan_range(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Attempts created in ``[start, end)``; only the days of the range are read."""
    low, high = (F.lit(bound).cast("timestamp_ntz") for bound in (start, end))
    schema = StructType([*EMAIL_INSTANCE.fields, StructField(DAY, DateType())])
    created, day = F.col("created_date_time"), F.col(DAY)
    return (
        spark.read.schema(schema)
        .parquet(path)
        .filter((day >= low.cast("date")) & (day <= high.cast("date")))
        .filter((created >= low) & (created < high))
        .drop(DAY)
        .transform(canonical)
    )


def replace_days(rows: DataFrame, path: str) -> None:
    """Replace, in a log laid out by creation day, the days that ``rows`` fall in.

    ``rows`` holds all rows of these days. They are written to the shared folder first, so
    the log is never overwritten while it is read; then each day is swapped for its new
    files. Repeating it changes nothing.
    """
    staged = materialize(rows.withColumn(DAY, F.to_date("created_date_time")), "days")
    (
        staged.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def rows_of_days(log: DataFrame, changed: DataFrame) -> DataFrame:
    """All rows of the days on which ``changed`` has a row."""
    days = changed.select(F.to_date("created_date_time").alias("_day")).distinct()
    return log.join(days, F.to_date("created_date_time") == F.col("_day"), "left_semi")
