"""Keys: canonical text form and name-based ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(value: Column) -> Column:
    """GUIDs compare without case and padding."""
    return F.lower(F.trim(value.cast("string")))


def named_id(*parts: Column) -> Column:
    """GUID-shaped id computed from the row's own key.

    Unlike a random id it is the same when a lost task is run again, so a retried
    write cannot mint a second row for one attempt.
    """
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def instance_id(activity_id: Column, attempt_number: Column) -> Column:
    """Id of the n-th attempt of an activity."""
    return named_id(activity_id, attempt_number)
