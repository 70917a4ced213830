"""Crawl states as Structured Streaming: the latest state of each record, and counts by window.

An extra over the batch operators, with the same results once a stream has run dry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_states(events: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The latest row of each key so far: an update-mode aggregate whose state is a row for each key."""
    rest = [c for c in events.columns if c not in keys]
    best = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("__r"))
    return best.select(*[F.col(c) if c in keys else F.col("__r")[c].alias(c) for c in events.columns])


def window_counts(events: DataFrame, at: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, key, n): counts in tumbling windows; rows later than the watermark are left out and state is dropped."""
    out = events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), key, "n")
