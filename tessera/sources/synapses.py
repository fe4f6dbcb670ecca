"""The synapse store: documents in a folder tree by block of the postsynaptic place, superfragments and neurons by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi

POINTS = [f"{k}{a}" for k in ("", "pre_", "post_") for a in AXES]


def documents(synapses: DataFrame) -> DataFrame:
    """The store's columns: id and places as whole numbers, score and both superfragments if known, and props, which every row has."""
    known = set(synapses.columns)
    column = lambda c, kind: (F.col(c) if c in known else F.lit(None)).cast(kind).alias(c)
    props = F.coalesce(F.col("props"), F.create_map()).cast("map<string,string>") if "props" in known else F.create_map().cast("map<string,string>")
    return synapses.select(F.col("id").cast("bigint").alias("id"), *[column(c, "bigint") for c in POINTS], column("score", "double"), column("id_superfrag_pre", "bigint"), column("id_superfrag_post", "bigint"), props.alias("props"))


def append_tree(synapses: DataFrame, path: str, size: tuple[int, int, int]) -> None:
    """Append documents under z0 / y0 / x0, the begin of the block that holds the postsynaptic place."""
    begins = [(F.floor(F.col(f"post_{a}") / F.lit(n)) * n).cast("bigint").alias(f"{a}0") for a, n in zip(AXES, size)]
    documents(synapses).select("*", *begins).write.mode("append").partitionBy("z0", "y0", "x0").parquet(path)


def read_tree(spark: SparkSession, path: str, roi: Roi, size: tuple[int, int, int], score: float = -1.0) -> DataFrame:
    """Documents whose postsynaptic place is in a box, with a score above ``score``; blocks outside are pruned by their folders."""
    rows, grid = spark.read.parquet(path), roi.snap_to_grid(size)
    for a, lo, hi in zip(AXES, grid.begin, grid.end):
        rows = rows.filter((F.col(f"{a}0") >= lo) & (F.col(f"{a}0") < hi))
    return rows.filter(roi.contains("post_")).filter(F.col("score") > score).drop("z0", "y0", "x0")


def by_ids(rows: DataFrame, ids: DataFrame | None = None, score: float | None = None, key: str | list[str] = "id") -> DataFrame:
    """Rows with one of ``ids`` (key, or several that together name a row), all without; score strictly above ``score``. Serves synapses and superfragments."""
    if ids is not None:
        rows = rows.join(ids.select(key).distinct(), key, "left_semi")
    return rows if score is None else rows.filter(F.col("score") > score)


def neurons_by_name(neurons: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The neurons of some names, or all of them."""
    return neurons if names is None else neurons.filter(F.col("neuron").isin(*names))
