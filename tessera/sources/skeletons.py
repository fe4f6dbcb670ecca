"""Skeleton scans: nested JSON documents and positional CSV files to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JSON = (
    "skeletons map<string, struct<"
    "treenodes: map<string, struct<location: array<double>, parent_id: bigint>>, "
    "connectors: map<string, struct<location: array<double>, presynaptic_to: array<bigint>, postsynaptic_to: array<bigint>>>>>"
)
CSV = "skeleton_id bigint, treenode_id bigint, parent_id bigint, x double, y double, z double, r double"


def _documents(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", JSON).alias("d")).select(F.explode("d.skeletons").alias("skeleton_id", "s"))


def treenodes_json(spark: SparkSession, path: str, least: int = 2) -> DataFrame:
    """treenode_id, skeleton_id, parent_id, z, y, x (whole units) of skeletons with at least ``least`` nodes."""
    own = _documents(spark, path).filter(F.size("s.treenodes") >= least)
    nodes = own.select(F.col("skeleton_id").cast("bigint").alias("skeleton_id"), F.explode("s.treenodes").alias("treenode_id", "n"))
    at = lambda i: F.get("n.location", F.lit(i)).cast("bigint")
    return nodes.select(F.col("treenode_id").cast("bigint").alias("treenode_id"), "skeleton_id", "n.parent_id", at(2).alias("z"), at(1).alias("y"), at(0).alias("x"))


def connectors_json(spark: SparkSession, path: str) -> DataFrame:
    """conn_id, skeleton_id, z, y, x, pre_ids, post_ids."""
    own = _documents(spark, path).select(F.col("skeleton_id").cast("bigint").alias("skeleton_id"), F.explode("s.connectors").alias("conn_id", "c"))
    at = lambda i: F.get("c.location", F.lit(i)).cast("bigint")
    none = F.array().cast("array<bigint>")
    return own.select(F.col("conn_id").cast("bigint").alias("conn_id"), "skeleton_id", at(2).alias("z"), at(1).alias("y"), at(0).alias("x"), F.coalesce("c.presynaptic_to", none).alias("pre_ids"), F.coalesce("c.postsynaptic_to", none).alias("post_ids"))


def site_edges(connectors: DataFrame) -> DataFrame:
    """Distinct (conn_id, pre_id, post_id): every pre node of a connector with every post node of it."""
    pre = connectors.select("conn_id", F.explode("pre_ids").alias("pre_id")).distinct()
    post = connectors.select("conn_id", F.explode("post_ids").alias("post_id")).distinct()
    return pre.join(post, "conn_id")


def treenodes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The seven columns by place; a header line is left out."""
    return spark.read.schema(CSV).option("header", True).option("enforceSchema", True).option("ignoreLeadingWhiteSpace", True).csv(path)
