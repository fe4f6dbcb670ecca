"""Segmentation against skeletons: split, breaking and merge errors, contingency, Rand, variation of information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.components import component_edges
from tessera.session import counted, drop_table, materialize


def split_errors(links: DataFrame, labels: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """(u, v, u_label, v_label): edges between different labels; edges whose u is in an ignored skeleton are left out.

    ``labels`` has id, label, skeleton_id.
    """
    ends = links.join(labels.select(F.col("id").alias("u"), F.col("label").alias("u_label"), "skeleton_id"), "u").join(labels.select(F.col("id").alias("v"), F.col("label").alias("v_label")), "v")
    if ignored is not None:
        ends = ends.join(ignored, "skeleton_id", "left_anti")
    return ends.filter("u_label <> v_label").select("u", "v", "u_label", "v_label")


def breaking_nodes(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label): nodes whose label no neighbour has, while all of two or more neighbours share one label.

    Such a node only interrupts its neighbours' segment: its split edges are one break, not a split.
    """
    both = links.select(F.col("u").alias("id"), F.col("v").alias("other")).union(links.select("v", "u"))
    near = both.join(labels.select(F.col("id").alias("other"), F.col("label").alias("near")), "other")
    found = near.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("least"), F.max("near").alias("most"))
    return found.filter("n >= 2 and least = most").join(labels.select("id", "label"), "id").filter("label <> least").select("id", "label")


def breaking_edges(links: DataFrame, labels: DataFrame, most: int = 1) -> DataFrame:
    """(u, v), u < v: split edges that only interrupt a segment, by breaks of at most ``most`` steps.

    From a split edge (a, b), tried both ways, a break grows from b through neighbours whose label is not a's. If all nodes at
    its border have a's label, its border edges and the split edges within it are breaks. Neighbours come by joins, a step each.
    """
    of = lambda c: labels.select(F.col("id").alias(c), F.col("label").alias(f"l{c}"))
    both = links.select(F.col("u").alias("a"), F.col("v").alias("b")).union(links.select("v", "u")).distinct()
    both = materialize(both.join(of("a"), "a").join(of("b"), "b").select("a", "b", "la", "lb"), "break-links")
    split = both.filter("la <> lb")
    inside = split.select(F.col("a").alias("e"), F.col("b").alias("f"), F.col("la").alias("label"), F.col("b").alias("node"))
    for _ in range(most - 1):
        more = inside.join(both, F.col("node") == F.col("a")).filter("lb <> label").select("e", "f", "label", F.col("b").alias("node"))
        inside = materialize(inside.union(more).distinct(), "break-inside")
    around = inside.join(both, F.col("node") == F.col("a")).select("e", "f", "label", "a", "b", "la", "lb")
    around = around.join(inside.select("e", "f", F.col("node").alias("b"), F.lit(True).alias("within")), ["e", "f", "b"], "left")
    around = materialize(around.withColumn("border", F.col("within").isNull()), "break-around")
    whole = around.groupBy("e", "f").agg(F.count_if("border").alias("n"), F.count_if(F.col("border") & (F.col("lb") != F.col("label"))).alias("other")).filter("n > 0 and other = 0")
    marked = around.join(whole.select("e", "f"), ["e", "f"]).filter("border or la <> lb")
    return marked.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def segment_clusters(links: DataFrame, nodes: DataFrame, same_skeleton: bool = True) -> DataFrame:
    """(id, label, cluster): pieces of skeletons within each segment label; label -1 is none. The cluster is its least node.

    Nodes are joined by edges inside a label, and with ``same_skeleton`` also all pieces of a skeleton in a label.
    """
    own = nodes.filter("label <> -1").select("id", "label", "skeleton_id")
    side = lambda c: own.select(F.col("id").alias(c), F.col("label").alias(f"{c}_label"))
    inner = links.select("u", "v").join(side("u"), "u").join(side("v"), "v").filter("u_label = v_label").select("u", "v")
    if same_skeleton:
        first = own.groupBy("label", "skeleton_id").agg(F.min("id").alias("v"))
        inner = inner.union(own.join(first, ["label", "skeleton_id"]).select(F.col("id").alias("u"), "v"))
    found = component_edges(inner)
    return own.join(found, F.col("id") == F.col("node"), "left").select("id", "label", F.coalesce("component", "id").alias("cluster"))


def classified(errors: DataFrame, breaking: DataFrame) -> DataFrame:
    """Split errors with error_type: breaking if an end is a breaking node, else split."""
    marks = breaking.select("id").withColumn("mark", F.lit(True))
    out = errors
    for end in ("u", "v"):
        out = out.join(marks.withColumnsRenamed({"id": end, "mark": f"{end}_mark"}), end, "left")
    return out.select("u", "v", "u_label", "v_label", F.when(F.col("u_mark") | F.col("v_mark"), "breaking").otherwise("split").alias("error_type"))


def merged_labels(labels: DataFrame) -> DataFrame:
    """(label, n_skeletons): labels that touch more than one skeleton; label -1 is none."""
    return labels.filter("label <> -1").groupBy("label").agg(F.countDistinct("skeleton_id").alias("n_skeletons")).filter("n_skeletons > 1")


#: Pairs of nodes for each node beyond which cells are halved once more, and how often at most.
NODE_PAIRS, MOST_LEVELS = 8, 24


def merge_sites(nodes: DataFrame, z_weight: int = 1) -> DataFrame:
    """(label, skeleton_a, skeleton_b, a, b, d): the closest pair of nodes for each two skeletons in a label.

    Squared distance, z times ``z_weight``; ties by node ids. ``nodes`` has id, skeleton_id, label, z, y, x; to pair
    clusters, give their ids as skeleton_id.

    Two skeletons' nodes are not all paired. Their boxes are halved together, level by level: of two boxes neither the
    nearest pair can be nearer than the gap between them, nor need it be farther than two of their nodes are; pairs of boxes
    whose gap is more than the least such distance go. What is left when few pairs of nodes remain is paired.
    """
    nodes = nodes.select("id", "skeleton_id", "label", (F.col("z") * z_weight).alias("z"), "y", "x")
    bad = materialize(nodes.join(merged_labels(nodes).select("label"), "label", "left_semi"), "near-nodes")
    ends = bad.agg(F.count(F.lit(1)), *[f(c) for c in "zyx" for f in (F.min, F.max)]).first()
    keys, axes = ["label", "skeleton_id"], "zyx"
    low = dict(zip(axes, ends[1::2])) if ends[0] else dict.fromkeys(axes, 0)
    width = max([1, *[hi - lo + 1 for lo, hi in zip(ends[1::2], ends[2::2])]]) if ends[0] else 1
    deepest = min(MOST_LEVELS, int(width).bit_length())
    square = lambda c: c * c

    def cells(level: int) -> DataFrame:
        """Boxes of each skeleton's nodes by cell, with their least node."""
        at = [F.shiftright((F.col(c) - low[c]).cast("bigint"), deepest - level).alias(f"c{c}") for c in axes]
        first = F.min(F.struct("id", *axes)).alias("one")
        return bad.select(*keys, "id", *axes, *at).groupBy(*keys, *[f"c{c}" for c in axes]).agg(first, F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{e}{c}") for c in axes for e, f in (("lo", F.min), ("hi", F.max))])

    def side(boxes: DataFrame, s: str) -> DataFrame:
        return boxes.select("label", *[F.col(c).alias(f"{c}_{s}") for c in boxes.columns if c != "label"])

    def bounded(pairs: DataFrame) -> DataFrame:
        """Pairs of boxes that may hold the nearest nodes."""
        gap = sum((square(F.greatest(F.lit(0), F.col(f"lo{c}_a") - F.col(f"hi{c}_b"), F.col(f"lo{c}_b") - F.col(f"hi{c}_a"))) for c in axes), F.lit(0))
        seen = sum((square(F.col(f"one_a.{c}") - F.col(f"one_b.{c}")) for c in axes), F.lit(0))
        pairs = pairs.withColumns({"gap": gap, "seen": seen})
        best = F.min("seen").over(W.partitionBy("label", "skeleton_id_a", "skeleton_id_b"))
        return pairs.withColumn("best", best).filter("gap <= best").drop("best", "seen", "gap")

    top = materialize(cells(0), "near-cells")
    pairs = bounded(side(top, "a").join(side(top, "b"), "label").filter("skeleton_id_a < skeleton_id_b"))
    pairs, at_level = materialize(pairs, "near-boxes"), 0
    for level in range(1, deepest + 1):
        if (pairs.agg(F.sum(F.col("n_a") * F.col("n_b"))).first()[0] or 0) <= NODE_PAIRS * ends[0]:
            break
        boxes = materialize(cells(level), "near-cells")
        parents = boxes.columns
        up = boxes.select(*parents, *[F.shiftright(f"c{c}", 1).alias(f"p{c}") for c in axes])
        for s in "ab":
            place = {f"c{c}_{s}": f"q{c}_{s}" for c in axes}
            kept = [c for c in pairs.columns if not c.endswith(f"_{s}") or c in ("skeleton_id_a", "skeleton_id_b", *place)]
            old = pairs.select(*kept).withColumnsRenamed(place)
            parts = side(up, s).withColumnsRenamed({"label": "of_label", f"skeleton_id_{s}": "of_skeleton"})
            same = [F.col("label") == F.col("of_label"), F.col(f"skeleton_id_{s}") == F.col("of_skeleton"), *[F.col(f"q{c}_{s}") == F.col(f"p{c}_{s}") for c in axes]]
            pairs = old.join(parts, same).drop("of_label", "of_skeleton", *[f"q{c}_{s}" for c in axes], *[f"p{c}_{s}" for c in axes])
        pairs = materialize(bounded(pairs), "near-boxes")
        drop_table(boxes)
        at_level = level
    at = [F.shiftright((F.col(c) - low[c]).cast("bigint"), deepest - at_level).alias(f"c{c}") for c in axes]
    spots = bad.select(*keys, "id", *axes, *at)
    own = pairs.select("label", *[f"{c}_{s}" for s in "ab" for c in ("skeleton_id", "cz", "cy", "cx")])
    for s in "ab":
        own = own.join(side(spots, s), ["label", *[f"{c}_{s}" for c in ("skeleton_id", "cz", "cy", "cx")]])
    d = sum((square(F.col(f"{c}_a") - F.col(f"{c}_b")) for c in axes), F.lit(0)).cast("bigint")
    best = own.withColumn("d", d).groupBy("label", "skeleton_id_a", "skeleton_id_b").agg(F.min(F.struct("d", "id_a", "id_b")).alias("m"))
    return best.select("label", F.col("skeleton_id_a").alias("skeleton_a"), F.col("skeleton_id_b").alias("skeleton_b"), F.col("m.id_a").alias("a"), F.col("m.id_b").alias("b"), "m.d")


def minimal_sites(sites: DataFrame) -> DataFrame:
    """The sites that connect each label's skeletons at least distance: a spanning tree for each label.

    In rounds: each group of skeletons takes its least site (by distance, then ids) to another group, and groups that are
    joined are one in the next. All labels are gone through at once, and a label is no task of its own.
    """
    ends = sites.select("label", F.col("skeleton_a").alias("s")).union(sites.select("label", "skeleton_b")).distinct()
    vertices = materialize(ends.withColumn("vertex", F.monotonically_increasing_id()), "tree-vertices")
    at = lambda c, v: vertices.select("label", F.col("s").alias(f"skeleton_{c}"), F.col("vertex").alias(v))
    known = materialize(sites.join(at("a", "u"), ["label", "skeleton_a"]).join(at("b", "v"), ["label", "skeleton_b"]), "tree-sites")
    left, taken = known, []
    while True:
        order = F.min(F.struct("d", "a", "b", "skeleton_a", "skeleton_b", "label", "u", "v")).alias("s")
        named = left.groupBy(F.col("u").alias("g")).agg(order).union(left.groupBy(F.col("v").alias("g")).agg(order))
        least, some, _ = counted(named.groupBy("g").agg(F.min("s").alias("s")).select("s.*").distinct(), "tree-least")
        if not some:
            break
        taken.append(least)
        found = component_edges(least.select("u", "v"))
        of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_g"))  # noqa: E731, B023
        moved = left.join(of("u"), "u", "left").join(of("v"), "v", "left")
        moved = moved.withColumns({"u": F.coalesce("u_g", "u"), "v": F.coalesce("v_g", "v")}).drop("u_g", "v_g").filter("u <> v")
        left = materialize(moved, "tree-sites")
    out = sites.limit(0)
    for part in taken:
        out = out.unionByName(part.select(*sites.columns))
    return out


def contingency(labels: DataFrame, truth: str = "skeleton_id", found: str = "label") -> DataFrame:
    """(i, j, n): found label, true label, count; found label -1 is left out."""
    return labels.filter(F.col(found) != -1).groupBy(F.col(found).alias("i"), F.col(truth).alias("j")).agg(F.count(F.lit(1)).alias("n"))


def _sums(table: DataFrame) -> DataFrame:
    """One row of sums of n, n**2 and n log2 n over cells, rows and columns."""
    parts = [table.select(F.lit("ij").alias("kind"), "n"), table.groupBy("i").agg(F.sum("n").alias("n")).select(F.lit("i"), "n"), table.groupBy("j").agg(F.sum("n").alias("n")).select(F.lit("j"), "n")]
    long = parts[0].union(parts[1]).union(parts[2])
    pick = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    n = F.col("n").cast("double")
    return long.agg(
        pick("ij", n).alias("total"),
        *[pick(k, n * n).alias(f"sq_{k}") for k in ("ij", "i", "j")],
        *[pick(k, n * F.log2(n)).alias(f"nl_{k}") for k in ("ij", "i", "j")],
    )


def rand(table: DataFrame) -> DataFrame:
    """(rand_split, rand_merge): one minus the share of pairs of one truth (found) that stay together."""
    return _sums(table).select((1 - F.col("sq_ij") / F.col("sq_j")).alias("rand_split"), (1 - F.col("sq_ij") / F.col("sq_i")).alias("rand_merge"))


def voi(table: DataFrame) -> DataFrame:
    """(voi_split, voi_merge) in bits: H(found | truth), H(truth | found)."""
    s = _sums(table)
    return s.select(((F.col("nl_j") - F.col("nl_ij")) / F.col("total")).alias("voi_split"), ((F.col("nl_i") - F.col("nl_ij")) / F.col("total")).alias("voi_merge"))


def voi_per_cluster(table: DataFrame) -> DataFrame:
    """(j, voi_split): each true cluster's part of the split entropy."""
    of_j = table.groupBy("j").agg(F.sum("n").alias("n_j"))
    total = table.agg(F.sum("n").alias("total"))
    both = table.join(of_j, "j").join(F.broadcast(total))
    return both.groupBy("j").agg(F.sum(-F.col("n") / F.col("total") * F.log2(F.col("n") / F.col("n_j"))).alias("voi_split"))


def split_correction(labels: DataFrame) -> DataFrame:
    """(src, dst) of segments: all segments under one skeleton, transitively, become the least of them."""
    own = labels.filter("label > 0").select("skeleton_id", "label").distinct()
    root = own.groupBy("skeleton_id").agg(F.min("label").alias("root"))
    found = component_edges(own.join(root, "skeleton_id").select(F.col("label").alias("u"), F.col("root").alias("v")))
    return found.select(F.col("node").alias("src"), F.col("component").alias("dst")).filter("src <> dst")


def weighted_sum(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of metric * weight over volumes."""
    return scores.groupBy(*keys).agg(F.sum(F.col("metric") * F.col("weight")).alias("metric"))
