"""Structured Streaming over block completions. An extension: there is no batch original for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def completions(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Distinct completions (block_id, ts), late ones beyond ``delay`` dropped with their state."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["block_id"])


def per_window(events: DataFrame, width: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """(start, n): tumbling counts."""
    counted = events.withWatermark("ts", delay).groupBy(F.window("ts", width)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), "n")


def seeds(queue: DataFrame, step: Callable[[DataFrame], None], checkpoint: str):
    """Run ``step`` on each batch of new seeds (a growth server); the checkpoint makes it resume where it was."""
    return queue.writeStream.foreachBatch(lambda batch, _: step(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
