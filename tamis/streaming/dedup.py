"""Streams of documents: row filters and exact deduplication with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.operators.clean import CleanOptions, filtered


def clean_stream(docs: DataFrame, time: str, late: str = "1 hour", o: CleanOptions = CleanOptions(scrub=True), content: str = "content", license_: str | None = "license") -> DataFrame:
    """Kept documents of a stream: the row filters, then the first of each content within the
    watermark (rows later than ``late`` are dropped, and state is cleared behind it)."""
    live = filtered(docs, o, content, license_).where("drop_reason is null").drop("drop_reason", "redactions")
    return live.withWatermark(time, late).withColumn("content_hash", F.sha2(content, 256)).dropDuplicatesWithinWatermark(["content_hash"])


def reasons_by_window(docs: DataFrame, time: str, window: str = "10 minutes", late: str = "1 hour", o: CleanOptions = CleanOptions(), content: str = "content", license_: str | None = "license") -> DataFrame:
    """Counts of drop reasons by tumbling window (kept rows have a null reason)."""
    return filtered(docs, o, content, license_).withWatermark(time, late).groupBy(F.window(time, window), "drop_reason").agg(F.count("*").alias("rows"))
