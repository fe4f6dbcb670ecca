"""Queries over the region graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.geometry import Roi
from tessera.operators import agglomeration, kernels, rag, relabel
from tessera.operators.components import connected_components
from tessera.plans.fixtures import SQL, Views, components_cte, with_views
from tessera.session import materialize

QUERIES, ORACLE = {}, {}
ROI = Roi((0, 0, 0), (40_000, 2_048, 8_192))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _cc(t: float, tail: str, edges: str = "rag_edges", nodes: str = "rag_nodes", more: dict | None = None) -> str:
    cut = {"cut": f"SELECT u, v FROM {edges} WHERE merge_score <= {t}"}
    return with_views(tail, "rag_nodes", "rag_edges", recursive=True, more=cut | components_cte("cut", nodes) | (more or {}))


@query(with_views("SELECT u, v, merge_score FROM rag_edges WHERE merge_score <= 0.5", "rag_edges"))
def rag_edge_filter(v):
    return rag.under_threshold(v.rag_edges(), 0.5)


@query(with_views("SELECT u, v FROM rag_edges WHERE merge_score IS NOT NULL AND merge_score <= 0.4", "rag_edges").replace("round(abs", "nullif(round(abs").replace("10, 1))", "10, 1), 1.0))"))
def rag_null_scores(v):
    e = v.rag_edges().withColumn("merge_score", F.when(F.col("merge_score") < 1.0, F.col("merge_score")))
    return rag.under_threshold(e, 0.4).select("u", "v")


@query(with_views("SELECT u, v, merge_score FROM rag_edges WHERE u IN (SELECT id FROM rag_nodes WHERE center_z >= 0 AND center_z < 40000 AND center_y >= 0 AND center_y < 2048 AND center_x >= 0 AND center_x < 8192)", "rag_nodes", "rag_edges"))
def rag_roi_scan(v):
    return rag.in_roi(v.rag_nodes(), v.rag_edges(), ROI)[1]


@query(with_views("SELECT block_id, count(*) AS n, min(center_z) AS z0, max(center_z) AS z1, min(id) AS least FROM rag_nodes GROUP BY block_id", "rag_nodes"))
def rag_block_stats(v):
    return v.rag_nodes().groupBy("block_id").agg(F.count(F.lit(1)).alias("n"), F.min("center_z").alias("z0"), F.max("center_z").alias("z1"), F.min("id").alias("least"))


def _components(t):
    def run(v):
        return rag.segments(v.rag_nodes(), v.rag_edges(), t)

    run.__name__ = f"components_t{round(t * 100)}"
    return run


for _t in (0.1, 0.3, 0.5, 0.9):
    query(_cc(_t, "SELECT id, component FROM cc"))(_components(_t))


@query(_cc(0.5, "SELECT component, count(*) AS size FROM cc GROUP BY component"))
def component_sizes(v):
    return rag.segments(v.rag_nodes(), v.rag_edges(), 0.5).groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def _sweep_sql() -> str:
    more, parts = {}, []
    for t in (10, 30, 50):
        more |= {f"cut{t}": f"SELECT u, v FROM rag_edges WHERE merge_score <= {t / 100}"} | components_cte(f"cut{t}", "rag_nodes", f"cc{t}")
        parts.append(f"SELECT {t} AS threshold, count(DISTINCT component) AS n, max(size) AS largest FROM (SELECT component, count(*) AS size FROM cc{t} GROUP BY 1)")
    return with_views(" UNION ALL ".join(parts), "rag_nodes", "rag_edges", recursive=True, more=more)


@query(_sweep_sql())
def component_sweep(v):
    found = rag.segment_sweep(v.rag_nodes(), materialize(rag.under_threshold(v.rag_edges(), 0.5), "sweep-edges"), [0.1, 0.3, 0.5])
    sizes = found.groupBy("threshold", "component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("threshold").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("largest"))


def _lut(v, t):
    return materialize(rag.segments(v.rag_nodes(), v.rag_edges(), t).withColumnsRenamed({"id": "src", "component": "dst"}), "lut")


@query(_cc(0.3, "SELECT coalesce(component, l_orderkey) AS value, count(*) AS n FROM lineitem LEFT JOIN cc ON id = l_orderkey GROUP BY 1"))
def relabel_fragments(v):
    return relabel.relabel(v.fragments(), _lut(v, 0.3)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


_LOCAL = {
    "inside": "SELECT u, v FROM rag_edges JOIN rag_nodes a ON a.id = u JOIN rag_nodes b ON b.id = v WHERE merge_score <= 0.3 AND a.block_id = b.block_id",
    **components_cte("inside", "rag_nodes", "local"),
}
_OUT = _LOCAL | {
    "crossing": "SELECT u, v, a.block_id AS ub, b.block_id AS vb FROM rag_edges JOIN rag_nodes a ON a.id = u JOIN rag_nodes b ON b.id = v WHERE merge_score <= 0.3 AND a.block_id <> b.block_id",
    "outward": "SELECT DISTINCT block_id, component AS local, fragment FROM (SELECT ub AS block_id, u AS inn, v AS fragment FROM crossing UNION ALL SELECT vb, v, u FROM crossing) JOIN local ON local.id = inn",
}
_RESOLVED = _OUT | {
    "blocks": 'SELECT DISTINCT block_id, bz, "by", bx FROM rag_nodes',
    "near": 'SELECT a.block_id AS one, b.block_id AS two FROM blocks a JOIN blocks b ON abs(a.bz - b.bz) + abs(a."by" - b."by") + abs(a.bx - b.bx) = 1',
    "resolved": """SELECT DISTINCT o.block_id, o.local AS u, CASE WHEN near.one IS NOT NULL THEN local.component ELSE o.fragment END AS v
        FROM outward o JOIN rag_nodes f ON f.id = o.fragment JOIN local ON local.id = o.fragment LEFT JOIN near ON near.one = o.block_id AND near.two = f.block_id""",
}


def _cte(tail: str, more: dict) -> str:
    return with_views(tail, "rag_nodes", "rag_edges", recursive=True, more=more)


def _local(v, block="block_id"):
    return materialize(rag.local_lut(v.rag_nodes(), v.rag_edges(), 0.3, block), "local")


def _resolved(v):
    nodes, edges = v.rag_nodes(), materialize(rag.under_threshold(v.rag_edges(), 0.3), "resolve-edges")
    lut = materialize(rag.local_lut(nodes, edges, 0.3), "local")
    out = rag.outward_edges(nodes, edges, lut, 0.3)
    return lut, rag.resolve_outward(out, nodes, lut, nodes.select("block_id", "bz", "by", "bx").distinct())


@query(_cte("SELECT block_id, local.id AS src, component AS dst FROM local JOIN rag_nodes ON rag_nodes.id = local.id", _LOCAL))
def block_local_lut(v):
    return rag.local_lut(v.rag_nodes(), v.rag_edges(), 0.3)


@query(_cte("SELECT * FROM outward", _OUT))
def block_outward_edges(v):
    return rag.outward_edges(v.rag_nodes(), v.rag_edges(), _local(v), 0.3)


@query(_cte("SELECT * FROM resolved", _RESOLVED))
def block_local2local(v):
    return _resolved(v)[1]


_GLOBAL = _RESOLVED | {"locals": "SELECT DISTINCT component AS id FROM local", "kept": "SELECT u, v FROM resolved"} | components_cte("kept", "locals", "top")


@query(_cte("SELECT id AS src, component AS dst FROM top WHERE id IN (SELECT id FROM locals)", _GLOBAL))
def global_from_local(v):
    lut, edges = _resolved(v)
    return rag.global_lut(lut, edges)


@query(_cte("SELECT coalesce(t.component, l.component, l_orderkey) AS value, count(*) AS n FROM lineitem LEFT JOIN local l ON l.id = l_orderkey LEFT JOIN top t ON t.id = l.component GROUP BY 1", _GLOBAL))
def relabel_two_hop(v):
    lut, edges = _resolved(v)
    top = rag.global_lut(lut, edges)
    return relabel.relabel_chain(v.fragments(), [lut, top]).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(_cte("SELECT t.component AS value, count(*) AS n FROM lineitem JOIN local l ON l.id = l_orderkey JOIN top t ON t.id = l.component WHERE l_orderkey <> 0 GROUP BY 1", _GLOBAL))
def relabel_points_inner(v):
    lut, edges = _resolved(v)
    return relabel.relabel_inner(v.fragments(), [lut, rag.global_lut(lut, edges)]).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(_cc(0.3, "SELECT id AS src, component AS dst FROM cc WHERE id <> component"))
def lut_no_identity(v):
    return relabel.without_identity(_lut(v, 0.3))


@query(_cc(0.3, "SELECT component AS label, dense_rank() OVER (ORDER BY component) AS compact FROM (SELECT DISTINCT component FROM cc)"))
def lut_label_compact(v):
    return relabel.compact_labels(_lut(v, 0.3), "dst")


@query(_cc(0.3, "SELECT DISTINCT least(a.component, b.component) AS u, greatest(a.component, b.component) AS v FROM rag_edges e JOIN cc a ON a.id = e.u JOIN cc b ON b.id = e.v"))
def relabel_edge_ends(v):
    e = relabel.relabel_edges(v.rag_edges().select("u", "v"), _lut(v, 0.3))
    return e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


_SUPER = {
    "placed": "SELECT id, floor(bz / 2)::BIGINT AS sb FROM rag_nodes",
    "inside": "SELECT u, v FROM rag_edges JOIN placed a ON a.id = u JOIN placed b ON b.id = v WHERE merge_score <= 0.3 AND a.sb = b.sb",
    **components_cte("inside", "rag_nodes", "sup"),
}
_BY_Y = {
    "inside": 'SELECT u, v FROM rag_edges JOIN rag_nodes a ON a.id = u JOIN rag_nodes b ON b.id = v WHERE merge_score <= 0.3 AND a."by" = b."by"',
    **components_cte("inside", "rag_nodes", "sup"),
}


@query(_cte("SELECT sb, sup.id AS src, component AS dst FROM sup JOIN placed ON placed.id = sup.id", _SUPER))
def super_local_lut(v):
    nodes = v.rag_nodes().withColumn("sb", rag.super_block("bz", 2))
    return rag.local_lut(nodes, v.rag_edges(), 0.3, "sb")


@query(_cte("SELECT DISTINCT least(a.component, b.component) AS u, greatest(a.component, b.component) AS v FROM rag_edges e JOIN sup a ON a.id = e.u JOIN sup b ON b.id = e.v WHERE merge_score <= 0.3 AND a.component <> b.component", _BY_Y))
def super_edges(v):
    lut = materialize(rag.local_lut(v.rag_nodes(), v.rag_edges(), 0.3, "by"), "super")
    return rag.super_edges(rag.under_threshold(v.rag_edges(), 0.3), lut, lut.select(F.col("dst").alias("id")).distinct())


def _inter_sql() -> str:
    more: dict = {}
    for t in (10, 30):
        more |= {f"cut{t}": f"SELECT u, v FROM rag_edges WHERE merge_score <= {t / 100}"} | components_cte(f"cut{t}", "rag_nodes", f"cc{t}")
    tail = "SELECT b.component AS segment, list_sort(list(DISTINCT a.component)) AS parts FROM cc10 a JOIN cc30 b USING (id) GROUP BY 1 HAVING count(DISTINCT a.component) > 1"
    return with_views(tail, "rag_nodes", "rag_edges", recursive=True, more=more)


@query(_inter_sql())
def interthreshold_map(v):
    edges = materialize(rag.under_threshold(v.rag_edges(), 0.3), "between-edges")
    return rag.joined_segments(v.rag_nodes(), edges, 0.1, 0.3)


def _reach(hops: int, tail: str) -> str:
    more = {
        "both_": "SELECT u AS a, v AS b FROM rag_edges WHERE merge_score <= 0.3 UNION SELECT v, u FROM rag_edges WHERE merge_score <= 0.3",
        "walk(id, hop)": f"SELECT id, 0 FROM seeds UNION SELECT b, hop + 1 FROM walk JOIN both_ ON a = id WHERE hop < {hops}",
    }
    return with_views(tail, "rag_edges", "seeds", recursive=True, more=more)


def _seeds(v):
    return materialize(rag.under_threshold(v.rag_edges(), 0.3), "grow-cut"), v.seeds()


_SEEDED = {"seeds": SQL["seeds"]}
_GROWN = "SELECT id FROM cc WHERE component IN (SELECT component FROM cc WHERE id IN (SELECT id FROM seeds))"


@query(_cc(0.3, _GROWN, more=_SEEDED))
def seed_component(v):
    return rag.seed_component(*_seeds(v))


@query(_cc(0.3, _GROWN, more=_SEEDED))
def growth_loop(v):
    nodes, edges = v.rag_nodes(), materialize(v.rag_edges(), "grow-edges")
    return rag.grow_loop(nodes, edges, v.seeds(), 0.3).select("id")


@query(_reach(3, "SELECT id, min(hop) AS hop FROM walk GROUP BY id"))
def grow_frontier(v):
    return rag.grow(*_seeds(v), 3)


@query(_cc(0.3, """SELECT component, dz, dy, dx, min(v) AS node FROM (
    SELECT e.u, e.v, b.bz - a.bz AS dz, b."by" - a."by" AS dy, b.bx - a.bx AS dx FROM (SELECT u, v FROM rag_edges UNION ALL SELECT v, u FROM rag_edges) e
    JOIN rag_nodes a ON a.id = e.u JOIN rag_nodes b ON b.id = e.v) JOIN cc ON cc.id = u WHERE abs(dz) + abs(dy) + abs(dx) = 1 GROUP BY ALL"""))
def growth_continuations(v):
    return rag.continuations(v.rag_nodes(), v.rag_edges(), rag.segments(v.rag_nodes(), v.rag_edges(), 0.3))


@query(with_views("SELECT u, v, min(merge_score) AS merge_score FROM (SELECT u, v, merge_score FROM rag_edges UNION ALL SELECT id, id + 1, 0 FROM rag_nodes WHERE id % 100 = 3 AND id + 1 IN (SELECT id FROM rag_nodes)) GROUP BY 1, 2", "rag_nodes", "rag_edges"))
def user_merges(v):
    n = v.rag_nodes().select("id")
    pairs = n.filter("id % 100 = 3").select((F.col("id") + 1).alias("u"), F.col("id").alias("v")).join(n.select(F.col("id").alias("u")), "u", "left_semi")
    return rag.add_user_merges(v.rag_edges(), pairs)


_AFF = "SELECT l_partkey AS u, l_suppkey AS v, l_discount * 10 AS aff FROM lineitem"


def _samples(v):
    return v.table("lineitem").select(F.col("l_partkey").alias("u"), F.col("l_suppkey").alias("v"), (F.col("l_discount") * 10).alias("aff"))


@query(f"SELECT u, v, round(1 - quantile_cont(aff, 0.75), 6) AS merge_score FROM ({_AFF}) GROUP BY 1, 2")
def rag_quantile_scores(v):
    return rag.quantile_scores(_samples(v), 0.75).withColumn("merge_score", F.round("merge_score", 6))


@query(f"""SELECT u, v, round(1 - min(bin) / 255, 6) AS merge_score FROM (
    SELECT u, v, least(floor(aff * 255), 255) AS bin, count(*) OVER (PARTITION BY u, v ORDER BY least(floor(aff * 255), 255)) AS below, count(*) OVER (PARTITION BY u, v) AS total FROM ({_AFF}))
    WHERE below >= total * 0.5 GROUP BY 1, 2""")
def rag_histogram_scores(v):
    return rag.histogram_quantile_scores(_samples(v), 0.5).withColumn("merge_score", F.round("merge_score", 6))


@query(f"SELECT u, v, round(1 - avg(aff), 6) AS merge_score FROM ({_AFF}) GROUP BY 1, 2")
def rag_mean_scores(v):
    return rag.edge_scores(_samples(v), "mean").withColumn("merge_score", F.round("merge_score", 6))


@query(f"SELECT u, v, round(1 - least(floor(max(aff) * 255), 255) / 255, 6) AS merge_score FROM ({_AFF}) GROUP BY 1, 2")
def rag_init_max_scores(v):
    return rag.edge_scores(_samples(v), "hist_quant_50_initmax").withColumn("merge_score", F.round("merge_score", 6))


_SLICES = {
    "inside": "SELECT u, v FROM rag_edges JOIN rag_nodes a ON a.id = u JOIN rag_nodes b ON b.id = v WHERE merge_score <= 0.3 AND a.center_z = b.center_z",
    **components_cte("inside", "rag_nodes", "local"),
}


@query(_cte("SELECT local.id, center_z, component FROM local JOIN rag_nodes ON rag_nodes.id = local.id", _SLICES))
def slicewise_segments(v):
    return rag.slicewise_segments(v.rag_nodes(), v.rag_edges(), 0.3)


_BY_HAND = {
    "hand": "SELECT id AS u, id + 1 AS v FROM rag_nodes WHERE id % 100 = 3 AND id + 1 IN (SELECT id FROM rag_nodes)",
    "cut": "SELECT u, v FROM rag_edges WHERE merge_score <= 0.3 UNION ALL SELECT u, v FROM hand",
    **components_cte("cut", "rag_nodes"),
}


@query(_cte("SELECT id, component FROM cc", _BY_HAND))
def user_merge_regrow(v):
    n = v.rag_nodes().select("id")
    points = n.filter("id % 100 = 3").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = materialize(rag.segments(n, v.rag_edges(), 0.3), "regrow")
    return rag.merge_segments(found, points)


def _volumes_sql() -> str:
    more, parts = {}, []
    for t in (10, 30):
        more |= {f"cut{t}": f"SELECT u, v FROM rag_edges WHERE merge_score <= {t / 100}"} | components_cte(f"cut{t}", "rag_nodes", f"cc{t}")
        parts.append(f"SELECT {t} AS threshold, coalesce(component, l_orderkey) AS segment, count(*) AS n FROM lineitem LEFT JOIN cc{t} ON id = l_orderkey GROUP BY 2")
    return with_views(" UNION ALL ".join(parts), "rag_nodes", "rag_edges", recursive=True, more=more)


@query(_volumes_sql())
def segment_volumes(v):
    from tessera.operators.volume import segment_volumes as f

    own = v.table("lineitem").select(F.col("l_orderkey").cast("bigint").alias("value"), F.col("l_orderkey").alias("z"), F.col("l_linenumber").alias("y"), F.lit(0).alias("x"))
    found = rag.segment_sweep(v.rag_nodes(), materialize(v.rag_edges(), "volume-edges"), [0.1, 0.3])
    return f(own, found).groupBy("threshold", "segment").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("SELECT u, v, merge_score FROM rag_edges WHERE u IN (SELECT id FROM rag_nodes WHERE id % 10 <> 0 AND center_z >= 0 AND center_z < 40000 AND center_y >= 0 AND center_y < 2048 AND center_x >= 0 AND center_x < 8192)", "rag_nodes", "rag_edges"))
def rag_unplaced_nodes(v):
    n = v.rag_nodes().withColumn("center_z", F.when(F.col("id") % 10 != 0, F.col("center_z")))
    return rag.in_roi(n, v.rag_edges(), ROI)[1]


@query(with_views("SELECT id, block_id FROM rag_nodes WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)", "rag_nodes"))
def existing_fragments(v):
    meshes = v.table("lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").cast("bigint").alias("id"))
    return rag.existing(v.rag_nodes().select("id", "block_id"), meshes)


@query()
def merge_history_blocks(v):
    return kernels.merge_history(v.rag_nodes(), v.rag_edges(), 0.5)


def _pins(v):
    return v.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("bigint").alias("id"), (F.col("o_custkey") % 7).alias("skeleton"))


@query()
def merge_correction(v):
    edges = materialize(rag.under_threshold(v.rag_edges(), 0.3), "correct-edges")
    found = materialize(rag.segments(v.rag_nodes(), edges, 0.3), "correct-segments")
    return kernels.merge_correction(edges, found, _pins(v))[0]


@query()
def reagglomerate_apart(v):
    edges = materialize(rag.under_threshold(v.rag_edges(), 0.3), "apart-edges")
    found = materialize(rag.segments(v.rag_nodes(), edges, 0.3), "apart-segments")
    ends = found.groupBy("component").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    return kernels.reagglomerate(edges, found, ends.select("a", "b"), 0.3)


_SPLIT = {
    **{f"cut{t}": f"SELECT u, v FROM rag_edges WHERE merge_score <= {t / 100}" for t in (10, 30)},
    **components_cte("cut10", "rag_nodes", "cc10"),
    **components_cte("cut30", "rag_nodes", "cc30"),
}


@query(_cte("SELECT e.u, e.v FROM rag_edges e JOIN cc30 a ON a.id = e.u JOIN cc30 b ON b.id = e.v JOIN cc10 c ON c.id = e.u JOIN cc10 d ON d.id = e.v WHERE a.component = b.component AND c.component <> d.component", _SPLIT))
def rag_split_neighbours(v):
    n, e = v.rag_nodes(), materialize(v.rag_edges(), "split-edges")
    return rag.split_neighbours(e.select("u", "v"), rag.segments(n, e, 0.3), rag.segments(n, e, 0.1))


@query(_cc(0.3, "SELECT component AS segment, o_custkey % 50 AS skeleton, list_sort(list(DISTINCT id)) AS fragments FROM cc JOIN orders ON o_orderkey = id GROUP BY 1, 2"))
def segment_skeletons(v):
    o = v.table("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).alias("skeleton"))
    found = rag.segments(v.rag_nodes(), v.rag_edges(), 0.3).join(o, "id")
    return rag.associated(found.select(F.col("component").alias("segment"), "skeleton", F.col("id").alias("fragment")))


@query(_cc(0.3, "SELECT id, component FROM cc"))
def components_by_stars(v):
    """By star rounds to the end: no list is short enough for one task."""
    from tessera.operators.components import component_edges

    found = component_edges(rag.under_threshold(v.rag_edges(), 0.3).select("u", "v"), small=0)
    return v.rag_nodes().select("id").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("component"))


@query(with_views("SELECT u AS a, v AS b, round(any_value(merge_score), 6) AS score FROM near GROUP BY u, v HAVING count(*) = 2", "rag_edges", more={
    "own": "SELECT * FROM rag_edges WHERE merge_score <= 0.5",
    "near": "SELECT * FROM (SELECT u AS g, * FROM own UNION ALL SELECT v, * FROM own) QUALIFY row_number() OVER (PARTITION BY g ORDER BY merge_score, u, v) = 1",
}))
def agglomerate_first_round(v):
    scores = agglomeration.scored(agglomeration.state_of_scores(v.rag_edges()), "mean").withColumn("score", F.round("score", 6))
    return agglomeration.mutual(scores, 0.5)


@query()
def agglomerate_mean(v):
    """The whole graph, without blocks."""
    history = agglomeration.agglomerate(agglomeration.state_of_scores(v.rag_edges()), "mean", 0.5)
    return agglomeration.segments(v.rag_nodes(), history)


@query()
def agglomerate_hist_quant(v):
    """Merge tree by the median of affinity histograms, which are added as regions merge."""
    samples = _samples(v).withColumn("v", F.col("v") + 10_000_000)  # parts and suppliers are different regions
    return agglomeration.agglomerate(agglomeration.edge_state(samples, "hist_quant_50"), "hist_quant_50", 0.5)
