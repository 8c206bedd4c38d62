"""JSON documents held as text: validity, scalar access and typed parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.functions.stages import normalise_stage

CONTAINER = "^(OBJECT|ARRAY)<"
# Fixed value: the longest scalar, in UTF-16 units, that the lookup gives back.
SCALAR_LIMIT = 4000

# One schema for both shapes of a diagnostic document.
DETAILS_SCHEMA = """
    failed_stage STRING, error_code STRING, error_message STRING, http_status INT,
    occurred_at TIMESTAMP, attempt_number INT,
    attempts ARRAY<STRUCT<attempt: INT, failed_stage: STRING, error_code: STRING,
                          occurred_at: TIMESTAMP>>,
    _corrupt STRING
"""


def _listed(text: Column) -> Column:
    """The text parsed as an element of an array."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def is_json(text: Column) -> Column:
    """True for text that is one JSON object or array; NULL for NULL.

    The parser alone accepts trailing text, so the text must parse as the only element of
    an array and as a member value.
    """
    listed = _listed(text)
    member = F.try_parse_json(F.concat(F.lit('{"w":'), text, F.lit("}")))
    shape = F.schema_of_variant(F.try_variant_get(listed, "$[0]", "variant"))
    whole = (
        listed.isNotNull()
        & member.isNotNull()
        & F.try_variant_get(listed, "$[1]", "variant").isNull()
        & shape.rlike(CONTAINER)
    )
    return F.when(text.isNotNull(), F.coalesce(whole, F.lit(False)))


def json_value(text: Column, path: str) -> Column:
    """Scalar at ``path`` as text; NULL if absent, a container, too long or not JSON.

    Numbers come in their shortest form: 1.50 as 1.5.
    """
    node = F.try_variant_get(_listed(text), f"$[0]{path[1:]}", "variant")
    value = F.get_json_object(text, path)
    units = F.octet_length(F.encode(value, "UTF-16BE")) / 2
    return F.when(
        is_json(text) & ~F.schema_of_variant(node).rlike(CONTAINER) & (units <= SCALAR_LIMIT),
        value,
    )


def failed_stage(status_details: Column) -> Column:
    """The stage a diagnostic document blames."""
    return json_value(status_details, "$.failed_stage")


def details_typed(df: DataFrame, column: str = "status_details") -> DataFrame:
    """Add ``details``: the typed document, with the raw text in ``_corrupt`` if unreadable."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return df.withColumn("details", F.from_json(column, DETAILS_SCHEMA, options))


def status_details_rows(df: DataFrame, key: str, column: str = "status_details") -> DataFrame:
    """One row per recorded failure, from documents of either shape."""
    single = F.array(
        F.struct(
            F.col("details.attempt_number").alias("attempt"),
            F.col("details.failed_stage").alias("failed_stage"),
            F.col("details.error_code").alias("error_code"),
            F.col("details.occurred_at").alias("occurred_at"),
        )
    )
    parsed = details_typed(df.filter(F.col(column).isNotNull()), column).filter(
        F.col("details._corrupt").isNull()
    )
    return parsed.select(
        key,
        F.col("details.error_message").alias("error_message"),
        F.col("details.http_status").alias("http_status"),
        F.explode(F.coalesce(F.col("details.attempts"), single)).alias("failure"),
    ).select(
        key,
        F.col("failure.attempt").alias("attempt"),
        normalise_stage(F.col("failure.failed_stage")).alias("failed_stage"),
        F.col("failure.error_code").alias("error_code"),
        "error_message",
        "http_status",
        F.col("failure.occurred_at").cast("timestamp_ntz").alias("occurred_at"),
    )


def json_project(df: DataFrame, key: str, column: str, fields: dict[str, str]) -> DataFrame:
    """Rows of a JSON list with chosen members renamed: ``{alias: member}``."""
    schema = "ARRAY<STRUCT<" + ", ".join(f"`{m}`: STRING" for m in fields.values()) + ">>"
    listed = df.select(key, F.explode(F.from_json(column, schema)).alias("item"))
    return listed.select(key, *(F.col(f"item.{m}").alias(a) for a, m in fields.items()))


def json_path_by_kind(
    text: Column, kind_path: str, paths: dict[str, str], other: str
) -> Column:
    """Scalar whose path depends on the document's kind."""
    kind = F.get_json_object(text, kind_path)
    picked = F.get_json_object(text, other)
    for name, path in paths.items():
        picked = F.when(kind == name, F.get_json_object(text, path)).otherwise(picked)
    return picked
