"""Synapses to neuron connectivity: filters, rollups, weights, clustering, matrices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi, distance, packed_id
from tessera.operators.components import component_edges
from tessera.session import drop_table, materialize


def with_ids(synapses: DataFrame) -> DataFrame:
    """Adds the packed id of z, y, x."""
    return synapses.withColumn("id", packed_id(F.col("z"), F.col("y"), F.col("x")))


def false_positives_removed(synapses: DataFrame, pre: str, post: str) -> DataFrame:
    """Both ends labelled (not 0) and different."""
    return synapses.filter((F.col(pre) != F.col(post)) & (F.col(pre) != 0) & (F.col(post) != 0))


def owned(synapses: DataFrame, write: Roi, read: Roi) -> DataFrame:
    """Cleft in the write box and both ends in the read box: each synapse belongs to one block."""
    return synapses.filter(write.contains() & read.contains("pre_") & read.contains("post_"))


def oriented(synapses: DataFrame, mode: str) -> DataFrame:
    """Pre and post ends from location (z, y, x) and target (tz, ty, tx) by prediction mode; the cleft is the floored middle."""
    here, there = [F.col(a) for a in AXES], [F.col(f"t{a}") for a in AXES]
    ends = {"cleft_to_pre": (there, here), "pre_to_post": (here, there), "post_to_pre": (there, here)}[mode]
    out = synapses.select("*", *[c.alias(f"pre_{a}") for a, c in zip(AXES, ends[0])], *[c.alias(f"post_{a}") for a, c in zip(AXES, ends[1])])
    if mode == "cleft_to_pre":
        return out
    return out.withColumns({a: F.floor((F.col(f"pre_{a}") + F.col(f"post_{a}")) / 2).cast("bigint") for a in AXES})


def superfragments(synapses: DataFrame) -> DataFrame:
    """(id, syn_ids, pre_partners, post_partners) by one pass over both ends."""
    none = F.lit(None).cast("bigint")
    ends = synapses.select(F.col("id_superfrag_pre").alias("sf"), "id", none.alias("pre"), F.col("id_superfrag_post").alias("post")).union(
        synapses.select("id_superfrag_post", "id", "id_superfrag_pre", none)
    )
    return ends.groupBy("sf").agg(F.sort_array(F.collect_set("id")).alias("syn_ids"), F.sort_array(F.collect_set("pre")).alias("pre_partners"), F.sort_array(F.collect_set("post")).alias("post_partners")).withColumnRenamed("sf", "id")


def segment_map(neurons: DataFrame) -> DataFrame:
    """(sf, neuron) from neurons with an array of segments; the last neuron by name wins a segment named twice."""
    return neurons.select("neuron", F.explode("segments").alias("sf")).groupBy("sf").agg(F.max("neuron").alias("neuron"))


def neuron_synapses(synapses: DataFrame, mapping: DataFrame, min_score: float | None = None) -> DataFrame:
    """Synapses whose two ends are in different known neurons: adds pre and post; score strictly above ``min_score``."""
    if min_score is not None:
        synapses = synapses.filter(F.col("score") > min_score)
    for end in ("pre", "post"):
        synapses = synapses.join(mapping.select(F.col("sf").alias(f"id_superfrag_{end}"), F.col("neuron").alias(end)), f"id_superfrag_{end}")
    return synapses.filter("pre <> post")


def weights_of(edge_list: DataFrame, weights_: DataFrame) -> DataFrame:
    """(pre, post, weight) of a list of edges (pre, post); edges without synapses are left out."""
    return edge_list.select("pre", "post").distinct().join(weights_, ["pre", "post"])


def debug_edges(edges: DataFrame, pre: DataFrame, post: DataFrame) -> DataFrame:
    """Edges from one of ``pre`` to one of ``post`` (neuron): the two lists need no product."""
    return adjacency(edges, pre, post)


def graph(neurons: DataFrame, edges: DataFrame, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(neuron, attributes, in_degree, out_degree) and (pre, post, weight): a weighted directed graph. Neurons that only edges name have null attributes."""
    ends = edges.select(F.col("pre").alias("neuron"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("post", F.lit(0), F.lit(1)))
    degrees = ends.groupBy("neuron").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    nodes = neurons.select("neuron", *attributes).join(degrees, "neuron", "full_outer").fillna(0, ["in_degree", "out_degree"])
    return nodes.select("neuron", *attributes, "in_degree", "out_degree"), edges.select("pre", "post", "weight")


def checked_ids(synapses: DataFrame) -> DataFrame:
    """(n, n_ids, out_of_range): ids are sound if the first two are equal and the last is 0 (coordinates beyond 21 bits or below zero)."""
    bad = ~(F.col("z").between(0, (1 << 21) - 1) & F.col("y").between(0, (1 << 21) - 1) & F.col("x").between(0, (1 << 21) - 1))
    return with_ids(synapses).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), F.count_if(bad).alias("out_of_range"))


def sorted_ids(rows: DataFrame, column: str = "neuron") -> DataFrame:
    """Distinct values in order."""
    return rows.select(column).distinct().orderBy(column)


def partner_edges(rollup: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct (pre, post) neuron pairs from superfragments' partner lists."""
    near = mapping.select(F.col("sf").alias("id"), "neuron")
    far = mapping.select(F.col("sf").alias("partner"), F.col("neuron").alias("other"))
    own = rollup.join(near, "id")
    out = own.select("neuron", F.explode("post_partners").alias("partner")).join(far, "partner").select(F.col("neuron").alias("pre"), F.col("other").alias("post"))
    back = own.select("neuron", F.explode("pre_partners").alias("partner")).join(far, "partner").select(F.col("other").alias("pre"), F.col("neuron").alias("post"))
    return out.union(back).filter("pre <> post").distinct()


def weights(pairs: DataFrame, mode: str = "count", soma: DataFrame | None = None) -> DataFrame:
    """(pre, post, weight): number, summed length or summed area (thousands), each divided by the distance to the soma if given."""
    value: Column = F.lit(1.0)
    if mode == "length":
        value = distance("pre_", "post_")
    elif mode == "area":
        value = F.col("area") / 1000
    if soma is not None:
        pairs = pairs.join(soma.select(F.col("neuron").alias("post"), "soma_z", "soma_y", "soma_x"), "post")
        value = value / F.greatest(distance("post_", "soma_"), F.lit(1.0))
    return pairs.groupBy("pre", "post").agg(F.sum(value).alias("weight"))


def locations(pairs: DataFrame) -> DataFrame:
    """(pre, post, locations): sorted cleft points of each pair."""
    return pairs.groupBy("pre", "post").agg(F.sort_array(F.collect_list(F.struct("z", "y", "x"))).alias("locations"))


def without_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with no end among ``nodes`` (neuron)."""
    for end in ("pre", "post"):
        edges = edges.join(nodes.select(F.col("neuron").alias(end)), end, "left_anti")
    return edges


def excluded(neurons: DataFrame, names: list[str] = (), by_type: dict[str, list[str]] | None = None) -> DataFrame:
    """Neurons to leave out: by name, or by cell type with one of some tags."""
    rule = F.col("neuron").isin(*names) if names else F.lit(False)
    for kind, tags in (by_type or {}).items():
        rule = rule | ((F.col("cell_type") == kind) & F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    return neurons.filter(rule).select("neuron")


def without_pairs(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    return edges.join(pairs, ["pre", "post"], "left_anti")


def without_locations(synapses: DataFrame, points: DataFrame) -> DataFrame:
    """All listed exact points go."""
    return synapses.join(points.select("x", "y", "z"), ["x", "y", "z"], "left_anti")


def renamed(neurons: DataFrame, rules: list[tuple[str, str, str, str]], direct: dict[str, str] | None = None) -> DataFrame:
    """(neuron, name): rules (prefix, attribute, value, new prefix) in order, later ones win; direct names last."""
    name = F.col("neuron")
    for prefix, attribute, value, new in rules:
        fits = F.col("neuron").startswith(prefix) & (F.col(attribute).cast("string") == value)
        name = F.when(fits, F.concat(F.lit(new), F.substr("neuron", F.lit(len(prefix) + 1)))).otherwise(name)
    for old, new in (direct or {}).items():
        name = F.when(F.col("neuron") == old, new).otherwise(name)
    return neurons.select("neuron", name.alias("name"))


def rename_edges(edges: DataFrame, names: DataFrame) -> DataFrame:
    for end in ("pre", "post"):
        edges = edges.join(names.select(F.col("neuron").alias(end), F.col("name").alias("__n")), end, "left").withColumn(end, F.coalesce("__n", end)).drop("__n")
    return edges


def adjacency(edges: DataFrame, pre: DataFrame | None = None, post: DataFrame | None = None, least: float | None = None) -> DataFrame:
    """(pre, post, weight) in long form, of chosen rows and columns; weights of ``least`` or less are dropped as zeros."""
    if pre is not None:
        edges = edges.join(pre.select(F.col("neuron").alias("pre")), "pre", "left_semi")
    if post is not None:
        edges = edges.join(post.select(F.col("neuron").alias("post")), "post", "left_semi")
    return edges if least is None else edges.filter(F.col("weight") > least)


def dense(edges: DataFrame, columns: list[str]) -> DataFrame:
    """A matrix with one row for each pre and a column for each named post; missing pairs are 0."""
    return edges.groupBy("pre").pivot("post", columns).agg(F.sum("weight")).fillna(0)


def clustered(pairs: DataFrame, reach: float, fuse: str = "mean", with_equal_points: bool = False) -> DataFrame:
    """Synapses of a (pre, post) pair whose post ends are within ``reach`` of each other are one.

    Points of a pair are cut into cells of side ``reach`` / 2, whose points are all within ``reach`` of each other, and from there on cells are linked, not
    points: a pair with very many synapses is not compared all with all. Points that coincide are linked only on request, else through a third one: a
    cell with a single place links its points only if another cell's are near. ``mean`` averages the post ends, ``max_score`` takes the best one's (ties: least id).
    """
    ends, key = [f"post_{a}" for a in AXES], ["pre", "post", *[f"c{a}" for a in AXES]]
    cell = [F.floor(F.col(c) / F.lit(reach / 2)).cast("bigint").alias(f"c{a}") for c, a in zip(ends, AXES)]
    points = materialize(pairs.select("id", "pre", "post", *ends, "score", *cell), "cluster-points")
    box = [f for c, a in zip(ends, AXES) for f in (F.min(c).alias(f"low_{a}"), F.max(c).alias(f"high_{a}"))]
    place = F.struct(*ends)
    cells = points.groupBy(*key).agg(*box, F.min(place).alias("first"), F.max(place).alias("last"))
    cells = materialize(cells.withColumn("cell", F.monotonically_increasing_id()), "cluster-cells")
    roots = _cell_components(points, cells, key, reach)
    tied = cells.join(roots, F.col("cell") == F.col("node"), "left")
    if not with_equal_points:
        tied = tied.filter("node is not null or first <> last")
    held = points.join(tied.select(*key, F.coalesce("component", "cell").alias("root")), key).select("id", "root").distinct()
    held = materialize(held, "cluster-held")
    # ids are not unique: one that is in several clusters makes them one
    least = held.groupBy("id").agg(F.min("root").alias("root"), F.max("root").alias("most"))
    several = least.filter("root <> most").select("id", F.col("root").alias("v"))
    tops = component_edges(held.join(several, "id").select(F.col("root").alias("u"), "v"))
    least = least.join(tops, F.col("root") == F.col("node"), "left").select("id", F.coalesce("component", "root").alias("top"))
    least = materialize(least, "cluster-ids")
    groups = least.join(least.groupBy("top").agg(F.min("id").alias("least")), "top").select("id", "least")
    joined = points.join(groups, "id", "left").withColumn("cluster", F.coalesce("least", "id"))
    if fuse == "mean":
        fused = [F.avg(c).alias(c) for c in ends]
    else:
        best = lambda c: F.max_by(c, F.struct(F.col("score"), -F.col("id")))
        fused = [best(c).cast("double").alias(c) for c in ends]
    drop_table(cells, roots, held)
    return joined.groupBy("cluster", "pre", "post").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"), *fused)


def _cell_components(points: DataFrame, cells: DataFrame, key: list[str], reach: float) -> DataFrame:
    """A written table (node, component) of the cells that have points within ``reach`` of another's; cells that others link already are not compared.

    Boxes and two points of each cell tell of nearly all cells. Points are only compared for those of which they do not, and which are in different
    components of what is known then.
    """
    axes = [f"c{a}" for a in AXES]
    other = cells.select("pre", "post", *[F.col(c).alias(f"o_{c}") for c in [*axes, *[f"{e}_{a}" for a in AXES for e in ("low", "high")], "first", "last", "cell"]])
    length = lambda parts: F.sqrt(reduce(lambda p, q: p + q, [F.pow(d.cast("double"), F.lit(2.0)) for d in parts]))
    gap = length([F.greatest(F.col(f"low_{a}") - F.col(f"o_high_{a}"), F.col(f"o_low_{a}") - F.col(f"high_{a}"), F.lit(0)) for a in AXES])
    span = length([F.greatest(F.col(f"high_{a}") - F.col(f"o_low_{a}"), F.col(f"o_high_{a}") - F.col(f"low_{a}")) for a in AXES])
    between = lambda p, q: length([F.col(f"{p}.post_{a}") - F.col(f"{q}.post_{a}") for a in AXES])
    sure = reduce(lambda p, q: p | q, [d <= reach for d in (span, *[between(p, f"o_{q}") for p in ("first", "last") for q in ("first", "last")])])

    # faces first: where points lie densely, these join all cells there are
    faces = F.explode(F.array(*[F.struct(*[(F.col(f"o_{c}") - int(c == axis)).alias(c) for c in axes]) for axis in axes]))
    beside = cells.join(other.withColumn("at", faces).select("*", *[f"at.{c}" for c in axes]).drop("at"), key)
    near = materialize(beside.filter(sure).select(F.col("cell").alias("u"), F.col("o_cell").alias("v")), "cluster-near")
    found = materialize(component_edges(near), "cluster-found")
    root = lambda df, c: df.join(found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_root")), c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))

    # then all cells at most two apart, which are in the same or neighbouring blocks of two; pairs of neurons with one component have nothing left to link
    rest = materialize(root(cells, "cell"), "cluster-rest")
    several = rest.groupBy("pre", "post").agg(F.min("cell_root").alias("a"), F.max("cell_root").alias("b")).filter("a <> b").select("pre", "post")
    left = rest.join(several, ["pre", "post"], "left_semi")
    block = [F.floor(F.col(c) / 2).cast("bigint").alias(f"b{c}") for c in axes]
    after = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) >= (0, 0, 0)]
    to = F.explode(F.array(*[F.struct(*[(F.col(f"b{c}") + d).alias(f"b{c}") for c, d in zip(axes, step)], F.lit(step == (0, 0, 0)).alias("same")) for step in after]))
    own, keys = left.select("*", *block), ["pre", "post", *[f"b{c}" for c in axes]]
    far = own.select("pre", "post", *[F.col(c).alias(f"o_{c}") for c in rest.columns if c not in ("pre", "post")], to.alias("to")).select("*", "to.*").drop("to")
    met = own.join(far, keys).filter("not same or cell < o_cell").filter("cell_root <> o_cell_root").filter(gap <= reach)
    met = materialize(met.withColumn("sure", sure).select("pre", "post", *axes, *[f"o_{c}" for c in axes], "cell", "o_cell", "sure"), "cluster-met")
    links = near.union(met.filter("sure").select("cell", "o_cell"))

    # and the points of cells that are still apart
    now = materialize(component_edges(links), "cluster-now")
    top = lambda df, c: df.join(now.select(F.col("node").alias(c), F.col("component").alias(f"{c}_top")), c, "left").withColumn(f"{c}_top", F.coalesce(f"{c}_top", c))
    doubt = top(top(met.filter("not sure"), "cell"), "o_cell").filter("cell_top <> o_cell_top")
    here = points.select(*key, *[f"post_{a}" for a in AXES]).distinct()
    there = here.select("pre", "post", *[F.col(c).alias(f"o_{c}") for c in axes], *[F.col(f"post_{a}").alias(f"o_{a}") for a in AXES])
    compared = doubt.join(here, key).join(there, ["pre", "post", *[f"o_{c}" for c in axes]]).filter(distance("post_", "o_") <= reach)
    roots = materialize(component_edges(links.union(compared.select("cell", "o_cell").distinct())), "cluster-roots")
    drop_table(near, found, rest, met, now)
    return roots
