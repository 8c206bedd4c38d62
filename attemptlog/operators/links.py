"""Joins between the log, its queue items, its attachments and itself.

The right side of every join is unique on its key. Both come from a shuffle of the
join's own, so adaptive execution can split a busy key on the left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.operators.latest import latest_attempt
from attemptlog.operators.skew import id_key, join_unique, spread_nulls
from attemptlog.session import materialize


def activities(df: DataFrame) -> DataFrame:
    """Distinct activities."""
    return df.select("activity_id").distinct()


def orphans(queue_items: DataFrame, log: DataFrame) -> DataFrame:
    """Queued activities that never reached the log."""
    return activities(queue_items).join(activities(log), "activity_id", "left_anti")


def lineage_parent(log: DataFrame) -> DataFrame:
    """Each attempt with the attempt it was retried from.

    First attempts have no previous id; they are spread over all tasks.
    """
    child = log.withColumn(
        "_parent", spread_nulls(F.col("previous_email_instance_id"), F.col("email_instance_id"))
    )
    parent = log.select(
        id_key(F.col("email_instance_id")).alias("_parent"),
        F.col("attempt_number").alias("parent_attempt_number"),
        F.col("status_code").alias("parent_status_code"),
        F.col("last_completed_stage").alias("parent_stage"),
    )
    return child.join(parent, "_parent", "left").drop("_parent")


def lineage_chain(log: DataFrame) -> DataFrame:
    """Root and depth of every attempt, following previous ids wherever they lead.

    Every round joins each open row to the furthest ancestor found so far and adopts
    what that one knows, so a chain of n attempts takes log2(n) rounds. Each round is
    written once to the shared folder. A missing parent ends the chain. A round that
    closes no row has only cycles left; their rows get no root.
    """
    step = materialize(
        log.select(
            F.col("email_instance_id").alias("id"),
            F.col("email_instance_id").alias("root"),
            F.lit(0).cast("long").alias("hops"),
            F.col("previous_email_instance_id").alias("next"),
        ),
        "lineage",
    )
    closed, is_open = [], F.col("next").isNotNull()
    left, before = step.filter(is_open).count(), None
    while left and left != before:
        closed.append(step.filter(~is_open))
        known = step
        for part in closed[:-1]:
            known = known.unionByName(part)
        far = known.select(
            F.col("id").alias("next"),
            F.col("root").alias("far_root"),
            F.col("hops").alias("far_hops"),
            F.col("next").alias("far_next"),
        )
        moved = (
            step.filter(is_open)
            .join(far, "next", "left")
            .select(
                "id",
                F.coalesce("far_root", "root").alias("root"),
                (F.col("hops") + F.coalesce(F.col("far_hops") + 1, F.lit(0))).alias("hops"),
                F.col("far_next").alias("next"),
            )
        )
        step = materialize(moved, "lineage")
        before, left = left, step.filter(is_open).count()
    for part in closed:
        step = step.unionByName(part)
    return step.select(
        F.col("id").alias("email_instance_id"),
        F.when(~is_open, F.col("root")).alias("root_email_instance_id"),
        F.when(~is_open, F.col("hops") + 1).alias("depth"),
    )


def lineage_chain_clean(log: DataFrame) -> DataFrame:
    """Root and depth where attempts are known to count up from 1: no iteration."""
    root = log.groupBy("activity_id").agg(
        F.min_by("email_instance_id", "attempt_number").alias("root_email_instance_id")
    )
    return join_unique(log, root, ["activity_id"], "left").select(
        "email_instance_id",
        "root_email_instance_id",
        F.col("attempt_number").cast("long").alias("depth"),
    )


def queue_latest(queue_items: DataFrame, log: DataFrame) -> DataFrame:
    """Queue items with the latest attempt of their activity."""
    latest = latest_attempt(
        log.select(
            "activity_id", "email_instance_id", "attempt_number", "status_code",
            "last_completed_stage",
        )
    )
    return join_unique(queue_items, latest, ["activity_id"], "left")


def attachment_latest(attachments: DataFrame, log: DataFrame) -> DataFrame:
    """Attachments per activity with its latest attempt; counted before the join."""
    counted = attachments.groupBy("activity_id").agg(
        F.count(F.lit(1)).alias("attachments"), F.min("file_name").alias("first_file_name")
    )
    latest = latest_attempt(
        log.select("activity_id", "email_instance_id", "attempt_number", "status_code")
    )
    return counted.join(latest, "activity_id", "left")
