"""Region-graph operators: scans, block hierarchy, seeds, growth, maps between thresholds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.geometry import Roi, threshold_key
from tessera.operators.components import component_edges, connected_components
from tessera.operators.relabel import relabel_edges
from tessera.session import counted, drop_table, materialize, scratch_path


def under_threshold(edges: DataFrame, threshold: float) -> DataFrame:
    """Edges with score <= threshold; a null score never merges."""
    return edges.filter(F.col("merge_score") <= threshold)


def in_roi(nodes: DataFrame, edges: DataFrame, roi: Roi) -> tuple[DataFrame, DataFrame]:
    """Nodes with a position in the box, and the edges whose u is one of them."""
    own = nodes.filter("center_z is not null").filter(roi.contains("center_"))
    return own, edges.join(own.select(F.col("id").alias("u")), "u", "left_semi").select("u", "v", "merge_score")


def segments(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(id, component) at a threshold."""
    return connected_components(nodes, under_threshold(edges, threshold))


def contracted(edges: DataFrame, lut: DataFrame) -> DataFrame:
    """Edges (u, v, merge_score) between the components of a table (src, dst), each once with its least score."""
    moved = relabel_edges(edges.select("u", "v", "merge_score"), lut).filter("u <> v")
    return moved.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.min("merge_score").alias("merge_score"))


def segment_sweep(nodes: DataFrame, edges: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, id, component) for rising thresholds; each starts from the components of the one before, and edges from what it left of them."""
    out, steps = None, sorted(thresholds)
    held = nodes.select("id").distinct().withColumn("component", F.col("id"))
    for t in steps:
        step = materialize(component_edges(under_threshold(edges, t).select("u", "v")).select(F.col("node").alias("src"), F.col("component").alias("dst")), "sweep")
        held = materialize(held.join(step, F.col("component") == F.col("src"), "left").select("id", F.coalesce("dst", "component").alias("component")), "sweep-ids")
        found = held.select(F.lit(threshold_key(t)).alias("threshold"), "id", "component")
        out = found if out is None else out.union(found)
        if t != steps[-1]:
            edges = materialize(contracted(under_threshold(edges, steps[-1]), step), "sweep-edges")
    return out


def with_blocks(nodes: DataFrame, edges: DataFrame, columns: tuple[str, ...] = ("block_id",)) -> DataFrame:
    """Edges with u_<column> and v_<column> of their ends."""
    for side in ("u", "v"):
        edges = edges.join(nodes.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return edges


def local_lut(nodes: DataFrame, edges: DataFrame, threshold: float, block: str = "block_id") -> DataFrame:
    """(block, src, dst): components of the edges inside each block; a block without edges keeps its fragments."""
    placed = with_blocks(nodes, under_threshold(edges, threshold), (block,)).filter(F.col(f"u_{block}") == F.col(f"v_{block}"))
    found = component_edges(placed)
    return nodes.join(found, F.col("id") == F.col("node"), "left").select(block, F.col("id").alias("src"), F.coalesce("component", "id").alias("dst"))


def slicewise_segments(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(id, center_z, component): segments that stay within a section."""
    return local_lut(nodes, edges, threshold, "center_z").select(F.col("src").alias("id"), "center_z", F.col("dst").alias("component"))


def outward_edges(nodes: DataFrame, edges: DataFrame, lut: DataFrame, threshold: float, block: str = "block_id") -> DataFrame:
    """(block, local, fragment): edges that leave a block, the inner end as its local segment, from both sides."""
    out = with_blocks(nodes, under_threshold(edges, threshold), (block,)).filter(F.col(f"u_{block}") != F.col(f"v_{block}"))
    both = out.select(F.col(f"u_{block}").alias(block), F.col("u").alias("inner"), F.col("v").alias("fragment")).union(
        out.select(F.col(f"v_{block}"), "v", "u")
    )
    return both.join(lut.select(F.col("src").alias("inner"), F.col("dst").alias("local")), "inner").select(block, "local", "fragment").distinct()


def neighbour_blocks(blocks: DataFrame) -> DataFrame:
    """(block_id, neighbour): blocks that share a face, from bz, by, bx; outside the table there are none."""
    steps = [(s * (i == 0), s * (i == 1), s * (i == 2)) for i in range(3) for s in (-1, 1)]
    moved = blocks.select("block_id", F.explode(F.array(*[F.struct(*[(F.col(f"b{a}") + d).alias(f"b{a}") for a, d in zip("zyx", step)]) for step in steps])).alias("n")).select("block_id", "n.*")
    return moved.join(blocks.withColumnRenamed("block_id", "neighbour"), ["bz", "by", "bx"]).select("block_id", "neighbour")


def resolve_outward(outward: DataFrame, nodes: DataFrame, lut: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block_id, u, v): outward edges whose far end is in a face neighbour, both ends as local segments.

    Far ends elsewhere stay fragments, as when only the six neighbours' tables are consulted.
    """
    far = outward.join(nodes.select(F.col("id").alias("fragment"), F.col("block_id").alias("far")), "fragment")
    near = neighbour_blocks(blocks).withColumnRenamed("neighbour", "far").withColumn("is_near", F.lit(True))
    far = far.join(near, ["block_id", "far"], "left").join(lut.select(F.col("src").alias("fragment"), F.col("dst")), "fragment", "left")
    return far.select("block_id", F.col("local").alias("u"), F.when(F.col("is_near"), F.coalesce("dst", "fragment")).otherwise(F.col("fragment")).alias("v")).distinct()


def global_lut(local_nodes: DataFrame, local_edges: DataFrame) -> DataFrame:
    """(src, dst) of local segments: components without scores."""
    return connected_components(local_nodes.select(F.col("dst").alias("id")), local_edges).withColumnsRenamed({"id": "src", "component": "dst"})


def super_block(column: str, factor: int) -> Column:
    return F.floor(F.col(column) / F.lit(factor)).cast("bigint")


def super_edges(resolved: DataFrame, super_lut: DataFrame, node_set: DataFrame) -> DataFrame:
    """(u, v) between different super segments; both ends must be in the node set."""
    edges = relabel_edges(resolved.select("u", "v"), super_lut).filter("u <> v")
    for side in ("u", "v"):
        edges = edges.join(node_set.select(F.col("id").alias(side)), side, "left_semi")
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def between_thresholds(base: DataFrame, target: DataFrame) -> DataFrame:
    """(segment, parts): target segments that join more than one base segment, with those; both are (id, component)."""
    both = base.select("id", F.col("component").alias("part")).join(target.select("id", F.col("component").alias("segment")), "id")
    return both.groupBy("segment").agg(F.sort_array(F.collect_set("part")).alias("parts")).filter(F.size("parts") > 1)


def joined_segments(nodes: DataFrame, edges: DataFrame, low: float, high: float) -> DataFrame:
    """``between_thresholds`` of the segments at two thresholds: those of the lower one are linked by what is left of the edges, so only they are gone through again."""
    lut = materialize(component_edges(under_threshold(edges, low).select("u", "v")).select(F.col("node").alias("src"), F.col("component").alias("dst")), "between-low")
    links = contracted(under_threshold(edges, high), lut)
    parts = component_edges(links.select("u", "v")).select(F.col("node").alias("part"), F.col("component").alias("segment"))
    # of parts, those that a node is in: ends of edges may be no nodes
    held = nodes.select("id").join(lut, F.col("id") == F.col("src"), "left").select(F.coalesce("dst", "id").alias("part"))
    both = parts.join(held, "part", "left_semi")
    return both.groupBy("segment").agg(F.sort_array(F.collect_set("part")).alias("parts")).filter(F.size("parts") > 1)


def seed_component(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id) of all nodes that the seeds reach. By components: a walk would take as many rounds as the longest path."""
    found = component_edges(edges.select("u", "v"))
    of_seeds = found.join(seeds.select(F.col("id").alias("node")), "node", "left_semi").select("component").distinct()
    return found.join(of_seeds, "component", "left_semi").select(F.col("node").alias("id")).union(seeds.select("id")).distinct()


def _rounds(spark, name: str, schema: str) -> tuple[str, Callable[[], DataFrame]]:
    """A folder that rounds are appended to, and the table of all of them: its plan stays as it is, however many there are."""
    path = scratch_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(path)
    return path, lambda: spark.read.schema(schema).parquet(path)


def grow(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(id, hop): nodes within a number of hops of the seeds, and the least one."""
    both = materialize(edges.select("u", "v").union(edges.select("v", "u")).distinct(), "grow-edges")
    path, reached = _rounds(edges.sparkSession, "grow", "id bigint, hop int")
    seeds.select(F.col("id").cast("bigint").alias("id")).distinct().withColumn("hop", F.lit(0)).write.mode("append").parquet(path)
    for hop in range(1, hops + 1):
        front = reached().filter(F.col("hop") == hop - 1).select(F.col("id").alias("u"))
        new = both.join(front, "u").select(F.col("v").alias("id")).distinct().join(reached(), "id", "left_anti")
        new, some, _ = counted(new.withColumn("hop", F.lit(hop)), "grow-step")
        if some:
            new.write.mode("append").parquet(path)
        drop_table(new)
        if not some:
            break
    drop_table(both)
    return reached()


def grow_loop(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, threshold: float, block: str = "block_id", most: int | None = None, max_rounds: int = 1000) -> DataFrame:
    """(id, round) of all nodes that growth from the seeds (id) reaches, block by block, with the round in which its block segment was taken.

    A work queue holds block segments. A round takes all of it (or the ``most`` least), labels their nodes, and puts in
    for each face and segment beyond it one continuation, if it is not labelled yet.
    """
    lut, cross = block_segments(nodes, edges, threshold, block)
    queue = materialize(seeds.select("id").join(lut.select(F.col("src").alias("id"), F.col("dst").alias("segment")), "id").select("segment").distinct(), "grow-queue")
    path, done = _rounds(nodes.sparkSession, "grow-done", "segment bigint, round int")
    for number in range(max_rounds):
        taken = queue if most is None else first_n(queue, "segment", most)
        step, some, _ = counted(taken.select("segment", F.lit(number).alias("round")), "grow-step")
        if not some:
            break
        step.write.mode("append").parquet(path)
        found = cross.join(step.select(F.col("segment").alias("a")), "a").select(F.col("b").alias("segment"))
        rest = queue.join(step, "segment", "left_anti")
        following = materialize(rest.union(found).distinct().join(done(), "segment", "left_anti"), "grow-queue")
        drop_table(queue, step)
        queue = following
    else:
        raise RuntimeError("growth did not end")
    drop_table(queue, cross)
    return lut.join(done(), F.col("dst") == F.col("segment")).select(F.col("src").alias("id"), "round")


def block_segments(nodes: DataFrame, edges: DataFrame, threshold: float, block: str = "block_id") -> tuple[DataFrame, DataFrame]:
    """Written tables (src, dst) of each node's segment in its block, and (a, b) of the segments that an edge joins across blocks, both ways."""
    lut = materialize(local_lut(nodes, edges, threshold, block), "grow-local")
    segment = lambda c, n: lut.select(F.col("src").alias(c), F.col("dst").alias(n))
    own = under_threshold(edges, threshold).select("u", "v")
    cross = own.join(segment("u", "a"), "u").join(segment("v", "b"), "v").filter("a <> b").select("a", "b").distinct()
    return lut, materialize(cross.union(cross.select("b", "a")).distinct(), "grow-cross")


def first_n(queue: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` least entries of a queue."""
    return queue.orderBy(column).limit(n)


def continuations(nodes: DataFrame, edges: DataFrame, segments_: DataFrame) -> DataFrame:
    """(component, dz, dy, dx, node): for each segment and face direction one node through which growth goes on.

    The least fragment of the neighbouring block that an edge from the segment reaches.
    """
    from pyspark.sql import Window as W

    both = edges.select("u", "v").union(edges.select("v", "u"))
    placed = with_blocks(nodes, both, ("bz", "by", "bx"))
    steps = [(F.col(f"v_b{a}") - F.col(f"u_b{a}")).alias(f"d{a}") for a in "zyx"]
    cross = placed.select("u", "v", *steps).filter("abs(dz) + abs(dy) + abs(dx) = 1")
    own = cross.join(segments_.select(F.col("id").alias("u"), "component"), "u")
    w = W.partitionBy("component", "dz", "dy", "dx").orderBy("v")
    return own.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("component", "dz", "dy", "dx", F.col("v").alias("node"))


def quantile_scores(pairs: DataFrame, quantile: float) -> DataFrame:
    """(u, v, merge_score) from affinity samples (u, v, aff): one minus the interpolated quantile."""
    return pairs.groupBy("u", "v").agg((1 - F.percentile("aff", F.lit(quantile))).alias("merge_score"))


def histogram_quantile_scores(pairs: DataFrame, quantile: float, bins: int = 256) -> DataFrame:
    """The same on a fixed histogram of affinities, whose state is bounded for any number of samples."""
    from pyspark.sql import Window as W

    binned = pairs.groupBy("u", "v", F.least(F.floor(F.col("aff") * (bins - 1)), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("u", "v")
    ranked = binned.withColumn("below", F.sum("n").over(w.orderBy("bin"))).withColumn("total", F.sum("n").over(w))
    return ranked.filter(F.col("below") >= F.col("total") * quantile).groupBy("u", "v").agg((1 - F.min("bin") / F.lit(bins - 1)).alias("merge_score"))


def mean_scores(pairs: DataFrame) -> DataFrame:
    """One minus the mean affinity."""
    return pairs.groupBy("u", "v").agg((1 - F.avg("aff")).alias("merge_score"))


def init_max_scores(pairs: DataFrame, bins: int = 256) -> DataFrame:
    """One minus the largest affinity, on the histogram's bins: the first score of the variants that start from the maximum."""
    most = F.least(F.floor(F.max("aff") * (bins - 1)), F.lit(bins - 1))
    return pairs.groupBy("u", "v").agg((1 - most / F.lit(bins - 1)).alias("merge_score"))


def edge_scores(pairs: DataFrame, name: str) -> DataFrame:
    """Scores by function name: ``mean``, ``hist_quant_<q>`` or ``hist_quant_<q>_initmax``."""
    if name == "mean":
        return mean_scores(pairs)
    head, _, rest = name.partition("hist_quant_")
    quantile, _, variant = rest.partition("_")
    if head or not quantile.isdigit() or variant not in ("", "initmax"):
        raise ValueError(name)
    return init_max_scores(pairs) if variant else histogram_quantile_scores(pairs, int(quantile) / 100)


def merge_segments(segments_: DataFrame, points: DataFrame) -> DataFrame:
    """Segments (id, component) after merges made by hand: ``points`` (a, b) are fragments; the least segment id stays, and only touched segments are gone through."""
    side = lambda c: segments_.select(F.col("id").alias(c), F.col("component").alias(f"{c}_s"))
    links = points.select("a", "b").join(side("a"), "a").join(side("b"), "b").select(F.col("a_s").alias("u"), F.col("b_s").alias("v"))
    lut = component_edges(links).select(F.col("node").alias("component"), F.col("component").alias("top"))
    return segments_.join(lut, "component", "left").select("id", F.coalesce("top", "component").alias("component"))


def existing(nodes: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Nodes that an outside set (a table of mesh ids, say) has."""
    return nodes.join(ids.select(F.col(key)).distinct(), key, "left_semi")


def add_user_merges(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """Append (u, v) merges made by hand with score 0; the edge of least score counts."""
    ordered = merges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").withColumn("merge_score", F.lit(0.0))
    return edges.select("u", "v", "merge_score").union(ordered).groupBy("u", "v").agg(F.min("merge_score").alias("merge_score"))


def split_neighbours(edges: DataFrame, local: DataFrame, top: DataFrame) -> DataFrame:
    """(u, v) edges whose ends share a segment of ``local`` (id, component) but not of ``top``: likely split errors."""
    for name, lut in (("local", local), ("top", top)):
        for side in ("u", "v"):
            edges = edges.join(lut.select(F.col("id").alias(side), F.col("component").alias(f"{side}_{name}")), side)
    return edges.filter("u_local = v_local and u_top <> v_top").select("u", "v")


def associated(touches: DataFrame) -> DataFrame:
    """(segment, skeleton, fragments): sorted fragments by which a skeleton touches a segment; ``touches`` has those three."""
    return touches.groupBy("segment", "skeleton").agg(F.sort_array(F.collect_set("fragment")).alias("fragments"))


def next_label(labels: DataFrame, column: str = "label") -> DataFrame:
    """(next): one more than the largest label, 1 if there is none."""
    return labels.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("next"))
