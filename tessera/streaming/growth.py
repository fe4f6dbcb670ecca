"""A growth server: a stream over a queue of segments that feeds its own queue.

Entries (block, segment) are files in ``<folder>/queue``. State keyed by block remembers the segments that it has seen, so an
entry counts once however often it is put in. A batch writes its new segments to ``<folder>/done/batch=<number>`` and their
continuations (what an edge joins them to in other blocks) to ``<folder>/queue/batch=<number>``, which a later batch takes. A batch that is run again after
a crash has the same state and input, and replaces what its first try wrote: each segment is done exactly once. State is
in RocksDB under ``<folder>/checkpoint``; a new stream over the folder goes on where the last one ended, however that was.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

ENTRY = "block bigint, segment bigint"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Seen(StatefulProcessor):
    """Lets a block's segment through the first time."""

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "segment bigint", "there boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        import pandas as pd

        new = set()
        for part in rows:
            for segment in part.segment.unique().tolist():
                if segment not in new and not self.seen.containsKey((segment,)):
                    self.seen.updateValue((segment,), (True,))
                    new.add(segment)
        yield pd.DataFrame({"block": [key[0]] * len(new), "segment": sorted(new)}).astype("int64")

    def close(self) -> None:
        pass


def put(entries: DataFrame, folder: str) -> None:
    """Append (block, segment) rows to the queue."""
    entries.select("block", "segment").write.mode("append").parquet(f"{folder}/queue/put")


def server(spark: SparkSession, folder: str, cross: DataFrame, **trigger) -> StreamingQuery:
    """Start the stream; ``cross`` has (a, block, segment): a segment and one that growth goes on to. It must be a written table.

    ``trigger`` is Spark's; the default takes what is in the queue now and ends.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.createDataFrame([], ENTRY).write.mode("append").parquet(f"{folder}/queue/put")
    queue = spark.readStream.schema(ENTRY).option("recursiveFileLookup", "true").parquet(f"{folder}/queue")
    fresh = queue.groupBy("block").transformWithStateInPandas(_Seen(), ENTRY, "Append", "None")

    def step(batch: DataFrame, number: int) -> None:
        own = f"{folder}/done/batch={number}"
        batch.write.mode("overwrite").parquet(own)
        taken = spark.read.schema(ENTRY).parquet(own)
        following = cross.join(taken.select(F.col("segment").alias("a")), "a").select("block", "segment").distinct()
        following.write.mode("overwrite").parquet(f"{folder}/queue/batch={number}")

    writer = fresh.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def drained(spark: SparkSession, folder: str, cross: DataFrame, most: int = 1000) -> int:
    """Run streams until the queue holds nothing new; the number of streams that had entries."""
    for n in range(most):
        query = server(spark, folder, cross)
        query.awaitTermination()
        if not sum(p["numInputRows"] for p in query.recentProgress):
            return n
    raise RuntimeError("growth did not end")


def done(spark: SparkSession, folder: str) -> DataFrame:
    """(block, segment, batch) of all segments taken so far."""
    return spark.read.option("basePath", f"{folder}/done").schema(f"{ENTRY}, batch bigint").parquet(f"{folder}/done")
