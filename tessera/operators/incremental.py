"""Resumable block work: what is done, what is due, what must be done again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.geometry import Roi


def pending(blocks: DataFrame, completion: DataFrame, key: str = "block_id") -> DataFrame:
    """Blocks without a completion row."""
    return blocks.join(completion.select(key).distinct(), key, "left_anti")


def pending_by_output(blocks: DataFrame, completion: DataFrame, empty: DataFrame, key: str = "block_id") -> DataFrame:
    """Blocks that are neither logged as done nor have output that is not empty; ``empty`` has the key and a flag for each block with output."""
    return pending(blocks, completion, key).join(empty.filter("not empty").select(key), key, "left_anti")


def without_output(blocks: DataFrame, path: str, key: str = "block_id") -> DataFrame:
    """Blocks that have no partition of ``key`` under a path; all of them if it is not there."""
    from tessera.sources.datasets import _exists

    spark = blocks.sparkSession
    if not _exists(spark, path):
        return blocks
    return pending(blocks, spark.read.parquet(path).select(F.col(key).cast("bigint").alias(key)), key)


def cached(spark, folder: str, config: dict, build, overwrite: bool = False) -> DataFrame:
    """The table that ``build()`` makes, kept under a hash of its configuration; made again if it is not there or on request."""
    from tessera.plans.steps import config_hash
    from tessera.sources.datasets import _exists

    path = f"{folder.rstrip('/')}/{config_hash(config)}"
    if overwrite or not _exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def queue_updated(queue: DataFrame, done: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """A work queue without what is done and with what is new, each entry once."""
    return queue.select(key).union(new.select(key)).distinct().join(done.select(key), key, "left_anti")


def forced(blocks: DataFrame, completion: DataFrame, sections: Roi | None = None, mask: DataFrame | None = None, key: str = "block_id") -> DataFrame:
    """Pending blocks, and done ones that a section range or a mask of keys calls again."""
    due = pending(blocks, completion, key)
    again = blocks.filter(sections.contains()) if sections is not None else blocks.limit(0)
    if mask is not None:
        again = again.union(blocks.join(mask.select(key), key, "left_semi"))
    return due.union(again).distinct()


def log_completion(done: DataFrame, path: str, task: str) -> None:
    """Append completion rows (block_id, duration_ms)."""
    done.select(F.lit(task).alias("task"), "block_id", "duration_ms").write.mode("append").partitionBy("task").parquet(path)


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; others of both stay."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def insert_only(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``old`` and ``new``; fails if a key is in both."""
    if not new.join(old.select(key), key, "left_semi").isEmpty():
        raise ValueError("a key exists already")
    return old.unionByName(new)


def update_only(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """As ``upsert``, but fails if a key is not in ``old``."""
    if not new.join(old.select(key), key, "left_anti").isEmpty():
        raise ValueError("a key does not exist")
    return upsert(old, new, key)
