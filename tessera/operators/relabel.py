"""Label look-up tables (src -> dst) applied to voxels, points and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def relabel(values: DataFrame, lut: DataFrame, column: str = "value", out: str | None = None) -> DataFrame:
    """Replace ``column`` by the table's dst; unmapped values stay. Spark broadcasts a small table by its size."""
    pairs = lut.select(F.col("src").alias("__src"), F.col("dst").alias("__dst"))
    joined = values.join(pairs, F.col(column) == F.col("__src"), "left")
    return joined.withColumn(out or column, F.coalesce("__dst", column)).drop("__src", "__dst")


def relabel_chain(values: DataFrame, luts: list[DataFrame], column: str = "value") -> DataFrame:
    """Several tables in order, such as fragment -> local -> global."""
    for lut in luts:
        values = relabel(values, lut, column)
    return values


def relabel_inner(points: DataFrame, luts: list[DataFrame], column: str = "value") -> DataFrame:
    """As ``relabel_chain``, but background (0) and unmapped values go."""
    points = points.filter(F.col(column) != 0)
    for lut in luts:
        pairs = lut.select(F.col("src").alias("__src"), F.col("dst").alias("__dst"))
        points = points.join(pairs, F.col(column) == F.col("__src")).withColumn(column, F.col("__dst")).drop("__src", "__dst")
    return points


def relabel_edges(edges: DataFrame, lut: DataFrame) -> DataFrame:
    """Both ends of (u, v)."""
    return relabel(relabel(edges, lut, "u"), lut, "v")


def without_identity(lut: DataFrame) -> DataFrame:
    return lut.filter("src <> dst")


def running_total(rows: DataFrame, order: str, value: str) -> DataFrame:
    """Rows (a unique ``order``) with ``before``: the sum of ``value`` over all rows that come before, without sorting all rows in one task.

    Rows are dealt by range; a part starts from the sum of the parts before it, one row of which reaches the driver.
    """
    from pyspark.sql import Window as W

    parts = materialize(rows.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "running")
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.sum(value).alias("n")).collect())
    bases, total = [], 0
    for part, n in sizes:
        bases.append((part, total))
        total += n
    base = parts.sparkSession.createDataFrame(bases, "part int, base bigint")
    upto = F.sum(value).over(W.partitionBy("part").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return parts.withColumn("upto", upto).join(F.broadcast(base), "part").withColumn("before", (F.col("base") + F.col("upto") - F.col(value)).cast("bigint")).drop("part", "base", "upto")


def compact_labels(labels: DataFrame, column: str = "label", start: int = 1) -> DataFrame:
    """(label, compact): dense numbers in label order, without sorting all labels in one task."""
    own = labels.select(F.col(column).alias("label")).filter("label is not null").distinct().withColumn("one", F.lit(1))
    return running_total(own, "label", "one").select("label", (F.col("before") + start).cast("bigint").alias("compact"))
