"""Append-only attempt logs on Spark: latest state, retries, recovery, quality and reports."""
