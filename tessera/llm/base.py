"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.skew import SALTS, for_salts, hot_keys, salted
from tessera.session import materialize

__all__ = ["SALTS", "batches", "claim", "for_salts", "hot_keys", "named", "placed", "release", "salted", "slices", "small_batches", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


#: Rows of the list of (range, group) up to which it is sent to every executor; beyond it, a shuffled join.
SMALL_STARTS = 100_000


def placed(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``index`` (from 0, by ``order`` within its group) and ``n``, the rows of the group.

    Rows are dealt by ranges of (group, order) and sorted there; only one row a (range, group) is counted, so that
    a group with most of all rows is not one task. Group columns are not null.
    """
    spread = rows.repartitionByRange(*[F.col(c) for c in (*group, *order)]).sortWithinPartitions(*group, *order)
    spread = materialize(spread.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)), "placed")
    starts = spread.groupBy(*group, "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = W.partitionBy(*group)
    before = F.sum("rows").over(own.orderBy("range")) - F.col("rows")
    starts = materialize(starts.select(*group, "range", (before - F.col("first")).alias("shift"), F.sum("rows").over(own).alias("n")), "placed-starts")
    small = F.broadcast(starts) if starts.count() <= SMALL_STARTS else starts
    return spread.join(small, [*group, "range"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("index"), "n")


#: For rows of megabytes: few of them in a batch.
SMALL_BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": "128", "spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> SparkSession:
    """A session over the same context that reads and sends rows in small batches; the caller's settings stay as they are."""
    reading = spark.newSession()
    for key, value in SMALL_BATCHES.items():
        reading.conf.set(key, value)
    return reading


def batches(rows, schema, size: int = 4096):
    """Arrow batches of an iterator of tuples."""
    import pyarrow as pa

    def made(held):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield made(held)
            held = []
    if held:
        yield made(held)


def slices(stream, size: int = 2000):
    """Arrow batches cut to at most ``size`` rows."""
    for batch in stream:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


#: Caches of this worker process by owner; a worker outlives its tasks and serves several operators.
_caches: dict = {}


def claim(owner: str, cache):
    """Register an operator's cache (anything with ``clear``) and empty those of the others."""
    _caches[owner] = cache
    release(owner)
    return cache


def release(owner: str) -> None:
    """Empty the caches of all operators but ``owner`` in this worker process."""
    for name, cache in _caches.items():
        if name != owner:
            cache.clear()
