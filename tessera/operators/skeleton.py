"""Skeleton trees: edges, interpolation, pruning, glia, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import connected_components
from tessera.operators.relabel import running_total
from tessera.session import materialize


def edges(treenodes: DataFrame) -> DataFrame:
    """(u, v, error_type): node to parent."""
    return treenodes.filter("parent_id is not null").select(F.col("treenode_id").alias("u"), F.col("parent_id").alias("v"), F.lit("").alias("error_type"))


def interpolated(treenodes: DataFrame, step: int) -> DataFrame:
    """Nodes put between a node and its parent where their z differ by more than ``step``: one each step.

    (child_id, k, z, y, x), k from 1 at the parent's side; places are linear, truncated to whole units.
    """
    parent = treenodes.select(F.col("treenode_id").alias("parent_id"), *[F.col(a).alias(f"p{a}") for a in "zyx"])
    both = treenodes.join(parent, "parent_id").withColumn("steps", F.floor(F.abs(F.col("z") - F.col("pz")) / step))
    between = both.filter("steps > 1").select("treenode_id", "z", "y", "x", "pz", "py", "px", "steps", F.explode(F.sequence(F.lit(1), (F.col("steps") - 1).cast("int"))).alias("k"))
    place = [(F.col(f"p{a}") + ((F.col(a) - F.col(f"p{a}")) * F.col("k") / F.col("steps")).cast("bigint")).alias(a) for a in "zyx"]
    return between.select(F.col("treenode_id").alias("child_id"), "k", *place)


def rechained(treenodes: DataFrame, step: int, first_id: int | None = None) -> DataFrame:
    """treenode_id, skeleton_id, parent_id, z, y, x with new nodes wherever a node and its parent are more than ``step`` apart in z.

    From the node on, a new node follows at each ``step`` of z until the parent's z is reached or passed; each has the next one as its
    parent, and the last has the old parent. New ids count up from ``first_id`` (one more than the largest id), by node and place.
    """
    base = (treenodes.agg(F.max("treenode_id")).first()[0] or 0) + 1 if first_id is None else first_id
    parent = treenodes.select(F.col("treenode_id").alias("parent_id"), *[F.col(a).alias(f"p{a}") for a in "zyx"])
    both = treenodes.join(parent, "parent_id", "left").withColumn("gap", F.abs(F.col("pz") - F.col("z")))
    n = F.when(F.col("gap") > step, F.greatest(F.lit(2), F.ceil(F.col("gap") / step))).otherwise(0).cast("bigint")
    both = materialize(both.withColumn("n", n), "rechain")
    start = running_total(both.filter("n > 0").select("treenode_id", "n"), "treenode_id", "n")
    own = both.join(start.select("treenode_id", "before"), "treenode_id", "left").withColumn("first", F.col("before") + base)
    old = own.select("treenode_id", "skeleton_id", F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("parent_id")).alias("parent_id"), *[F.col(a).cast("double").alias(a) for a in "zyx"])
    new = own.filter("n > 0").select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("k"))
    place = [(F.col(a) + F.col("k") * step * (F.col(f"p{a}") - F.col(a)) / F.col("gap")).alias(a) for a in "zyx"]
    following = F.when(F.col("k") < F.col("n"), F.col("first") + F.col("k")).otherwise(F.col("parent_id"))
    return old.union(new.select((F.col("first") + F.col("k") - 1).alias("treenode_id"), "skeleton_id", following.alias("parent_id"), *place))


def between_sections(pairs: DataFrame, section: int = 40) -> DataFrame:
    """(a, b, k, z, y, x): whole places at each section between two nodes (a, b, their z, y, x as a_z, b_z and so on); z must be on sections, else an error."""
    off = pairs.filter((F.col("a_z") % section != 0) | (F.col("b_z") % section != 0))
    if not off.isEmpty():
        raise ValueError(f"z is not a multiple of {section}")
    own = pairs.withColumn("steps", F.floor(F.abs(F.col("b_z") - F.col("a_z")) / section)).filter("steps > 1")
    own = own.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("steps") - 1)).alias("k"))
    return own.select("a", "b", "k", *[(F.col(f"a_{c}") + F.col("k") * ((F.col(f"b_{c}") - F.col(f"a_{c}")).cast("double") / F.col("steps"))).cast("bigint").alias(c) for c in "zyx"])


def in_box(treenodes: DataFrame, begin: tuple[int, int, int], end: tuple[int, int, int], offset: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """All nodes of the skeletons with a node in a half-open box, places less ``offset``."""
    from tessera.geometry import Roi

    touched = treenodes.filter(Roi(begin, end).contains()).select("skeleton_id").distinct()
    own = treenodes.join(touched, "skeleton_id", "left_semi")
    return own.withColumns({a: F.col(a) - o for a, o in zip("zyx", offset)})


def pruned(nodes: DataFrame, links: DataFrame, depth: int) -> DataFrame:
    """(id) left after taking away nodes of degree one or less, ``depth`` times."""
    left, now = nodes.select("id").distinct(), links.select("u", "v")
    for _ in range(depth):
        degree = now.select(F.col("u").alias("id")).union(now.select("v")).groupBy("id").count().filter("count > 1")
        left = materialize(left.join(degree, "id", "left_semi"), "pruned")
        now = now.join(left.select(F.col("id").alias("u")), "u", "left_semi").join(left.select(F.col("id").alias("v")), "v", "left_semi").select("u", "v")
    return left


def glia(treenodes: DataFrame, children: int = 5) -> DataFrame:
    """(skeleton_id) with a node of more than ``children`` children of which more than as many are leaves."""
    kids = treenodes.filter("parent_id is not null").select("treenode_id", "parent_id", "skeleton_id")
    parents = kids.select(F.col("parent_id").alias("treenode_id")).distinct().withColumn("inner", F.lit(True))
    counted = kids.join(parents, "treenode_id", "left").groupBy("skeleton_id", "parent_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("inner").isNull()).alias("leaves"))
    return counted.filter((F.col("n") > children) & (F.col("leaves") > children)).select("skeleton_id").distinct()


def components(treenodes: DataFrame) -> DataFrame:
    """(id, component) over parent edges."""
    return connected_components(treenodes.select(F.col("treenode_id").alias("id")), edges(treenodes))


def large(treenodes: DataFrame, least: int) -> DataFrame:
    """Nodes of skeletons with at least ``least`` nodes."""
    return treenodes.join(treenodes.groupBy("skeleton_id").count().filter(F.col("count") >= least).select("skeleton_id"), "skeleton_id", "left_semi")
