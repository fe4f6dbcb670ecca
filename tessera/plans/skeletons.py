"""Queries over skeleton trees, evaluation and site matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.geometry import Roi
from tessera.operators import evaluate, sites, skeleton
from tessera.plans.fixtures import Views, with_views
from tessera.session import materialize

QUERIES, ORACLE = {}, {}
BOX = Roi((0, 0, 0), (60_000, 3_000, 6_000))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(tail: str, more: dict | None = None, recursive: bool = False) -> str:
    return with_views(tail, "treenodes", more=more, recursive=recursive)


def _labels(v):
    return v.treenodes().withColumnRenamed("treenode_id", "id")


@query(_t("SELECT treenode_id AS u, parent_id AS v, '' AS error_type FROM treenodes WHERE parent_id IS NOT NULL"))
def skeleton_edges(v):
    return skeleton.edges(v.treenodes())


@query(_t("""SELECT child_id, k::INTEGER AS k, pz + trunc((z - pz) * k / steps)::BIGINT AS z, py + trunc((y - py) * k / steps)::BIGINT AS y, px + trunc((x - px) * k / steps)::BIGINT AS x
    FROM (SELECT c.treenode_id AS child_id, c.z, c.y, c.x, p.z AS pz, p.y AS py, p.x AS px, floor(abs(c.z - p.z) / 400)::BIGINT AS steps, unnest(generate_series(1, floor(abs(c.z - p.z) / 400)::BIGINT - 1)) AS k
    FROM treenodes c JOIN treenodes p ON p.treenode_id = c.parent_id)"""))
def skeleton_interpolated(v):
    return skeleton.interpolated(v.treenodes(), 400)


_CHAIN = {
    "gaps": "SELECT c.*, p.z AS pz, p.y AS py, p.x AS px, abs(p.z - c.z) AS gap FROM treenodes c LEFT JOIN treenodes p ON p.treenode_id = c.parent_id",
    "sized": "SELECT *, CASE WHEN gap > 400 THEN greatest(2, ceil(gap / 400)) ELSE 0 END::BIGINT AS n FROM gaps",
    "firsts": "SELECT *, (SELECT max(treenode_id) FROM treenodes) + 1 + sum(n) OVER (ORDER BY treenode_id) - n AS first FROM sized",
}


@query(_t("""SELECT treenode_id::BIGINT AS treenode_id, skeleton_id, (CASE WHEN n > 0 THEN first ELSE parent_id END)::BIGINT AS parent_id, z::DOUBLE AS z, y::DOUBLE AS y, x::DOUBLE AS x FROM firsts
    UNION ALL SELECT (first + k - 1)::BIGINT, skeleton_id, (CASE WHEN k < n THEN first + k ELSE parent_id END)::BIGINT, round(z + k * 400 * (pz - z) / gap, 6), round(y + k * 400 * (py - y) / gap, 6), round(x + k * 400 * (px - x) / gap, 6)
    FROM (SELECT *, unnest(generate_series(1, n)) AS k FROM firsts WHERE n > 0)""", _CHAIN))
def skeleton_rechained(v):
    return skeleton.rechained(v.treenodes(), 400).withColumns({a: F.round(a, 6) for a in "zyx"})


@query(_t("""SELECT a, b, k, az + trunc(k * ((bz - az) / steps))::BIGINT AS z, trunc(ay + k * ((b_y - ay) / steps))::BIGINT AS y, trunc(ax + k * ((bx - ax) / steps))::BIGINT AS x
    FROM (SELECT c.treenode_id AS a, p.treenode_id AS b, c.z AS az, c.y AS ay, c.x AS ax, p.z AS bz, p.y AS b_y, p.x AS bx, floor(abs(p.z - c.z) / 40)::BIGINT AS steps, unnest(generate_series(1, floor(abs(p.z - c.z) / 40)::BIGINT - 1)) AS k
    FROM treenodes c JOIN treenodes p ON p.treenode_id = c.parent_id)"""))
def skeleton_between(v):
    t = v.treenodes()
    side = lambda c, own: t.select(F.col("treenode_id").alias(c), *([F.col("parent_id").alias("b")] if own else []), *[F.col(x).alias(f"{c}_{x}") for x in "zyx"])
    return skeleton.between_sections(side("a", True).join(side("b", False), "b"))


@query(_t("SELECT treenode_id, skeleton_id, z - 40 AS z, y - 4 AS y, x - 8 AS x FROM treenodes WHERE skeleton_id IN (SELECT skeleton_id FROM treenodes WHERE z >= 0 AND z < 200 AND y >= 0 AND y < 500 AND x >= 0 AND x < 600)"))
def skeleton_in_box(v):
    return skeleton.in_box(v.treenodes(), (0, 0, 0), (200, 500, 600), (40, 4, 8)).select("treenode_id", "skeleton_id", "z", "y", "x")


_PRUNE = {
    "e0": "SELECT treenode_id AS u, parent_id AS v FROM treenodes WHERE parent_id IS NOT NULL",
    "n1": "SELECT id FROM (SELECT u AS id FROM e0 UNION ALL SELECT v FROM e0) GROUP BY id HAVING count(*) > 1",
    "e1": "SELECT u, v FROM e0 WHERE u IN (SELECT id FROM n1) AND v IN (SELECT id FROM n1)",
    "n2": "SELECT id FROM (SELECT u AS id FROM e1 UNION ALL SELECT v FROM e1) GROUP BY id HAVING count(*) > 1",
}


@query(_t("SELECT id FROM n2", _PRUNE))
def skeleton_pruned(v):
    t = v.treenodes()
    return skeleton.pruned(t.select(F.col("treenode_id").alias("id")), skeleton.edges(t), 2)


_GLIA = "SELECT DISTINCT skeleton_id FROM (SELECT c.skeleton_id, c.parent_id, count(*) AS n, count(*) FILTER (c.treenode_id NOT IN (SELECT parent_id FROM treenodes WHERE parent_id IS NOT NULL)) AS leaves FROM treenodes c WHERE c.parent_id IS NOT NULL GROUP BY 1, 2) WHERE n > 5 AND leaves > 5"


@query(_t(_GLIA))
def skeleton_glia(v):
    return skeleton.glia(v.treenodes())


@query(_t("SELECT treenode_id AS id, min(treenode_id) OVER (PARTITION BY skeleton_id) AS component FROM treenodes"))
def skeleton_components(v):
    return skeleton.components(v.treenodes())


@query(_t("SELECT treenode_id FROM treenodes WHERE skeleton_id IN (SELECT skeleton_id FROM treenodes GROUP BY 1 HAVING count(*) >= 60)"))
def skeleton_large(v):
    return skeleton.large(v.treenodes(), 60).select("treenode_id")


_ERR = {
    "glia": _GLIA,
    "errs": "SELECT c.treenode_id AS u, p.treenode_id AS v, c.label AS u_label, p.label AS v_label FROM treenodes c JOIN treenodes p ON p.treenode_id = c.parent_id WHERE c.label <> p.label AND c.skeleton_id NOT IN (SELECT skeleton_id FROM glia)",
}
_BREAK = _ERR | {
    "sides": "SELECT treenode_id AS id, parent_id AS other FROM treenodes WHERE parent_id IS NOT NULL UNION ALL SELECT parent_id, treenode_id FROM treenodes WHERE parent_id IS NOT NULL",
    "breaks": "SELECT s.id FROM sides s JOIN treenodes o ON o.treenode_id = s.other JOIN treenodes me ON me.treenode_id = s.id GROUP BY s.id, me.label HAVING count(*) >= 2 AND min(o.label) = max(o.label) AND min(o.label) <> me.label",
}


@query(_t("SELECT * FROM errs", _ERR))
def split_errors(v):
    return evaluate.split_errors(skeleton.edges(v.treenodes()), _labels(v), skeleton.glia(v.treenodes()))


@query(_t("SELECT *, CASE WHEN u IN (SELECT id FROM breaks) OR v IN (SELECT id FROM breaks) THEN 'breaking' ELSE 'split' END AS error_type FROM errs", _BREAK))
def breaking_errors(v):
    e = skeleton.edges(v.treenodes())
    return evaluate.classified(evaluate.split_errors(e, _labels(v), skeleton.glia(v.treenodes())), evaluate.breaking_nodes(e, _labels(v)))


_WIDE = {
    "ends": "SELECT treenode_id AS a, parent_id AS b FROM treenodes WHERE parent_id IS NOT NULL UNION SELECT parent_id, treenode_id FROM treenodes WHERE parent_id IS NOT NULL",
    "both_": "SELECT a, b, p.label AS la, q.label AS lb FROM ends JOIN treenodes p ON p.treenode_id = a JOIN treenodes q ON q.treenode_id = b",
    "starts": "SELECT a AS e, b AS f, la AS label FROM both_ WHERE la <> lb",
    "inside": "SELECT e, f, label, f AS node FROM starts UNION SELECT e, f, label, b FROM starts JOIN both_ ON a = f WHERE lb <> label",
    "around": "SELECT i.e, i.f, i.label, a, b, la, lb, (e, f, b) NOT IN (SELECT (e, f, node) FROM inside) AS border FROM inside i JOIN both_ ON a = i.node".replace("(e, f, b) NOT IN (SELECT (e, f, node) FROM inside)", "NOT EXISTS (SELECT 1 FROM inside j WHERE j.e = i.e AND j.f = i.f AND j.node = b)"),
    "whole": "SELECT e, f FROM around GROUP BY e, f HAVING count(*) FILTER (border) > 0 AND count(*) FILTER (border AND lb <> label) = 0",
}


@query(_t("SELECT DISTINCT least(a, b) AS u, greatest(a, b) AS v FROM around JOIN whole USING (e, f) WHERE border OR la <> lb", _WIDE))
def breaking_edges(v):
    return evaluate.breaking_edges(skeleton.edges(v.treenodes()), _labels(v), 2)


@query(_t("SELECT treenode_id AS id, label, min(treenode_id) OVER (PARTITION BY label, skeleton_id) AS cluster FROM treenodes WHERE label <> -1"))
def segment_clusters(v):
    return evaluate.segment_clusters(skeleton.edges(v.treenodes()), _labels(v))


_PIECES = {
    "inner_": "SELECT c.treenode_id AS u, p.treenode_id AS v FROM treenodes c JOIN treenodes p ON p.treenode_id = c.parent_id WHERE c.label = p.label AND c.label <> -1",
    "sides_": "SELECT u AS a, v AS b FROM inner_ UNION ALL SELECT v, u FROM inner_",
    "walk(id, cluster)": "SELECT treenode_id, treenode_id FROM treenodes WHERE label <> -1 UNION SELECT b, cluster FROM walk JOIN sides_ ON a = walk.id WHERE cluster < b",
}


@query(_t("SELECT id, label, min(cluster) AS cluster FROM walk JOIN treenodes ON treenode_id = id GROUP BY id, label", _PIECES, recursive=True))
def segment_pieces(v):
    return evaluate.segment_clusters(skeleton.edges(v.treenodes()), _labels(v), False)


@query(_t("""SELECT label, cluster_a, cluster_b, a, b, d FROM (SELECT *, row_number() OVER (PARTITION BY label, cluster_a, cluster_b ORDER BY d, a, b) AS rn FROM (
    SELECT p.label, p.cluster AS cluster_a, q.cluster AS cluster_b, p.treenode_id AS a, q.treenode_id AS b, (4 * (p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))::BIGINT AS d
    FROM own p JOIN own q ON p.label = q.label AND p.cluster < q.cluster)) WHERE rn = 1""", {"own": "SELECT *, min(treenode_id) OVER (PARTITION BY label, skeleton_id) AS cluster FROM treenodes WHERE label <> -1"}))
def merge_cluster_sites(v):
    n = _labels(v)
    found = evaluate.segment_clusters(skeleton.edges(v.treenodes()), n).select("id", F.col("cluster").alias("skeleton_id"))
    return evaluate.merge_sites(n.drop("skeleton_id").join(found, "id"), 2).withColumnsRenamed({"skeleton_a": "cluster_a", "skeleton_b": "cluster_b"})


@query(_t("""SELECT label, skeleton_a, skeleton_b, a, b, d FROM (SELECT *, row_number() OVER (PARTITION BY label, skeleton_a, skeleton_b ORDER BY d, a, b) AS rn FROM (
    SELECT p.label, p.skeleton_id AS skeleton_a, q.skeleton_id AS skeleton_b, p.treenode_id AS a, q.treenode_id AS b, (p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x) AS d
    FROM treenodes p JOIN treenodes q ON p.label = q.label AND p.skeleton_id < q.skeleton_id WHERE p.label <> -1)) WHERE rn = 1"""))
def merge_candidates(v):
    return evaluate.merge_sites(_labels(v))


@query()
def merge_minimal(v):
    return evaluate.minimal_sites(evaluate.merge_sites(_labels(v)))


_TABLE = {
    "c": "SELECT label AS i, skeleton_id AS j, count(*)::DOUBLE AS n FROM treenodes WHERE label <> -1 GROUP BY 1, 2",
    "ci": "SELECT i, sum(n) AS n FROM c GROUP BY 1", "cj": "SELECT j, sum(n) AS n FROM c GROUP BY 1",
}


def _table(v):
    return evaluate.contingency(_labels(v))


@query(_t("SELECT i, j, n::BIGINT AS n FROM c", _TABLE))
def contingency(v):
    return _table(v)


@query(_t("SELECT round(1 - (SELECT sum(n * n) FROM c) / (SELECT sum(n * n) FROM cj), 9) AS rand_split, round(1 - (SELECT sum(n * n) FROM c) / (SELECT sum(n * n) FROM ci), 9) AS rand_merge", _TABLE))
def rand_index(v):
    return evaluate.rand(_table(v)).select(*[F.round(x, 9).alias(x) for x in ("rand_split", "rand_merge")])


@query(_t("""SELECT round(-sum(c.n / t * log2(c.n / cj.n)), 9) AS voi_split, round(-sum(c.n / t * log2(c.n / ci.n)), 9) AS voi_merge FROM c JOIN cj USING (j) JOIN ci USING (i), (SELECT sum(n) AS t FROM c)""", _TABLE))
def voi(v):
    return evaluate.voi(_table(v)).select(*[F.round(x, 9).alias(x) for x in ("voi_split", "voi_merge")])


@query(_t("SELECT c.j, round(sum(-c.n / t * log2(c.n / cj.n)), 9) + 0.0 AS voi_split FROM c JOIN cj USING (j), (SELECT sum(n) AS t FROM c) GROUP BY 1", _TABLE))
def voi_per_cluster(v):
    return evaluate.voi_per_cluster(_table(v)).select("j", (F.round("voi_split", 9) + 0.0).alias("voi_split"))


_FIX = {
    "own": "SELECT DISTINCT skeleton_id, label FROM treenodes WHERE label > 0",
    "both_": "SELECT DISTINCT a.label AS a, b.label AS b FROM own a JOIN own b USING (skeleton_id)",
    "walk(id, component)": "SELECT DISTINCT label, label FROM own UNION SELECT b, component FROM walk JOIN both_ ON a = id WHERE component < b",
}


@query(_t("SELECT id AS src, min(component) AS dst FROM walk GROUP BY id HAVING id <> min(component)", _FIX, recursive=True))
def split_correction_lut(v):
    return evaluate.split_correction(_labels(v))


@query(_t("SELECT label, count(DISTINCT skeleton_id) AS n_skeletons FROM treenodes WHERE label <> -1 GROUP BY 1 HAVING count(DISTINCT skeleton_id) > 1"))
def multi_skeleton_segments(v):
    return evaluate.merged_labels(_labels(v))


def _s(tail: str, more: dict | None = None) -> str:
    return with_views(tail, "sites_pred", "sites_gt", more=more)


def _d(end: str) -> str:
    return f"sqrt(pow(g.{end}_z - p.{end}_z, 2) + pow(g.{end}_y - p.{end}_y, 2) + pow(g.{end}_x - p.{end}_x, 2))"


_MET = {
    "met": f"""SELECT g.u AS gt_u, g.v AS gt_v, p.u AS pred_u, p.v AS pred_v, {_d('pre')} AS pre_d, {_d('post')} AS post_d FROM sites_gt g JOIN sites_pred p ON g.pre_label = p.pre_label AND g.post_label = p.post_label
        WHERE {_d('pre')} <= 2000 AND {_d('post')} <= 2000""",
}


def _met(v):
    return sites.matches(v.sites("gt"), v.sites("pred"), 2000.0)


@query(_s("SELECT gt_u, gt_v, pred_u, pred_v, round(pre_d, 6) AS pre_d, round(post_d, 6) AS post_d FROM met", _MET))
def site_match_edges(v):
    return _met(v).withColumns({"pre_d": F.round("pre_d", 6), "post_d": F.round("post_d", 6)})


@query(_s(f"SELECT g.u AS gt_u, g.v AS gt_v, p.u AS pred_u, p.v AS pred_v, round({_d('post')}, 6) AS d FROM sites_gt g JOIN sites_pred p ON g.post_label = p.post_label WHERE {_d('post')} <= 500"))
def site_match_nodes(v):
    return sites.node_matches(v.sites("gt"), v.sites("pred"), 500.0).withColumn("d", F.round("d", 6))


@query(_s("SELECT gt_u, gt_v, pred_u, pred_v, round(d, 6) AS d FROM (SELECT *, pre_d AS d, row_number() OVER (PARTITION BY gt_u, gt_v ORDER BY pre_d, pred_u, pred_v) AS rn FROM met) WHERE rn = 1", _MET))
def site_best_match(v):
    return sites.best(_met(v)).withColumn("d", F.round("d", 6))


@query(_s("""SELECT tp, n_gt - tp AS fn, n_pred - tp AS fp, n_pred - used AS fp_distinct FROM (SELECT count(DISTINCT (gt_u, gt_v)) AS tp, count(DISTINCT (pred_u, pred_v)) AS used FROM met),
    (SELECT count(*) AS n_gt FROM sites_gt), (SELECT count(*) AS n_pred FROM sites_pred)""", _MET))
def site_errors(v):
    return sites.errors(v.sites("gt"), v.sites("pred"), _met(v))


_NODES = {"met": f"SELECT g.u AS gt_u, g.v AS gt_v, p.u AS pred_u, p.v AS pred_v FROM sites_gt g JOIN sites_pred p ON g.post_label = p.post_label WHERE {_d('post')} <= 500"}


@query(_s("""SELECT tp, n_gt - tp AS fn, n_pred - used AS fp FROM (SELECT count(DISTINCT (gt_u, gt_v)) AS tp, count(DISTINCT (pred_u, pred_v)) AS used FROM met),
    (SELECT count(*) AS n_gt FROM sites_gt), (SELECT count(*) AS n_pred FROM sites_pred)""", _NODES))
def site_node_errors(v):
    return sites.node_errors(v.sites("gt"), v.sites("pred"), sites.node_matches(v.sites("gt"), v.sites("pred"), 500.0))


_MODELS = _MET | {
    "models": "SELECT *, 'a' AS model, 1 AS min_inf, score AS one, (u % 10) / 10 AS two FROM sites_pred UNION ALL SELECT *, 'b', 2, score, (v % 10) / 10 FROM sites_pred WHERE u % 2 = 0",
    "long": "SELECT model, min_inf, u, v, 'one' AS metric, one AS s FROM models UNION ALL SELECT model, min_inf, u, v, 'two', two FROM models",
    "grid": "SELECT * FROM (SELECT unnest([0.5, 0.7]::DOUBLE[]) AS threshold), (SELECT unnest([500.0, 2000.0]::DOUBLE[]) AS reach)",
}


@query(_s("""SELECT model, min_inf, metric, threshold, reach, coalesce(tp, 0) AS tp, n_pred - coalesce(tp, 0) AS fp, (SELECT count(*) FROM sites_gt) - coalesce(tp, 0) AS fn
    FROM (SELECT model, min_inf, metric, threshold, reach, count(*) FILTER (s > threshold) AS n_pred FROM long, grid GROUP BY ALL)
    LEFT JOIN (SELECT model, min_inf, metric, threshold, reach, count(DISTINCT (gt_u, gt_v)) AS tp FROM met JOIN long ON u = pred_u AND v = pred_v, grid WHERE s > threshold AND pre_d <= reach AND post_d <= reach GROUP BY ALL) USING (model, min_inf, metric, threshold, reach)""", _MODELS))
def site_full_sweep(v):
    p = v.sites("pred").withColumn("one", F.col("score"))
    a = p.select("*", F.lit("a").alias("model"), F.lit(1).alias("min_inf"), (F.col("u") % 10 / 10).alias("two"))
    b = p.filter("u % 2 = 0").select("*", F.lit("b"), F.lit(2), (F.col("v") % 10 / 10).alias("two"))
    return sites.full_sweep(v.sites("gt"), a.union(b), ["one", "two"], [0.5, 0.7], [500.0, 2000.0])


_FAR = _MET | {
    "missed": "SELECT * FROM sites_gt g WHERE NOT EXISTS (SELECT 1 FROM met WHERE gt_u = g.u AND gt_v = g.v)",
    "others": f"SELECT g.u AS gt_u, g.v AS gt_v, p.u, p.v, {_d('post')} AS d FROM missed g JOIN sites_pred p ON g.post_label = p.post_label AND g.pre_label <> p.pre_label",
}


@query(_s("SELECT m.u AS gt_u, m.v AS gt_v, coalesce(list_sort(list([o.u, o.v]) FILTER (d <= 2000)), []) AS near, count(o.u) AS far FROM missed m LEFT JOIN others o ON o.gt_u = m.u AND o.gt_v = m.v GROUP BY 1, 2", _FAR))
def site_near_far(v):
    stored = materialize(v.sites_all().drop("z", "y", "x"), "sites")
    gt, pred = v.sites("gt", stored), v.sites("pred", stored)
    return sites.near_far(gt, pred, sites.matches(gt, pred, 2000.0), 2000.0)


@query(_s("SELECT u, v FROM sites_pred WHERE u NOT IN (SELECT n FROM low) AND v NOT IN (SELECT n FROM low)", {"low": "SELECT unnest([v, -v]) AS n FROM sites_pred WHERE score <= 0.7"}))
def site_low_nodes(v):
    p = v.sites("pred")
    return sites.without_low_nodes(p, p.select(F.col("v").alias("id"), "score"), 0.7).select("u", "v")


_ENDS = {"ends": "SELECT u AS id FROM sites_gt UNION SELECT v FROM sites_gt"}


@query(_s("SELECT id FROM ends WHERE id NOT IN (SELECT u FROM sites_gt)", _ENDS))
def site_nodes_without_pre(v):
    g = v.sites("gt")
    return sites.nodes_without(g.select(F.col("u").alias("id")).union(g.select("v")).distinct(), g, "presyn")


@query(_s("SELECT u, v FROM sites_gt WHERE u IN (SELECT v FROM sites_gt)", _ENDS))
def site_postsynaptic(v):
    g = v.sites("gt")
    return sites.postsynaptic(g.select(F.col("u").alias("id")).union(g.select("v")).distinct(), g)[1].select("u", "v")


@query(_s("""SELECT min_score, reach, coalesce(tp, 0) AS tp, n_pred - coalesce(tp, 0) AS fp, n_gt - coalesce(tp, 0) AS fn FROM (SELECT unnest([0.5, 0.7, 0.9]) AS min_score) s, (SELECT unnest([500.0, 2000.0])::DOUBLE AS reach) r,
    LATERAL (SELECT count(*) AS n_pred FROM sites_pred WHERE score > min_score) a, (SELECT count(*) AS n_gt FROM sites_gt) b,
    LATERAL (SELECT count(DISTINCT (gt_u, gt_v)) AS tp FROM met JOIN sites_pred p ON p.u = pred_u AND p.v = pred_v WHERE p.score > min_score AND pre_d <= reach AND post_d <= reach) c""", _MET).replace("[0.5, 0.7, 0.9]", "[0.5, 0.7, 0.9]::DOUBLE[]"))
def site_error_sweep(v):
    return sites.error_sweep(v.sites("gt"), v.sites("pred"), [0.5, 0.7, 0.9], [500.0, 2000.0])


_BAD = {"bad": "SELECT u AS n FROM sites_gt WHERE pre_label = post_label UNION SELECT v FROM sites_gt WHERE pre_label = post_label"}


@query(_s("SELECT u, v FROM sites_gt WHERE u NOT IN (SELECT n FROM bad) AND v NOT IN (SELECT n FROM bad)", _BAD))
def site_intra_removed(v):
    return sites.intra_removed(v.sites("gt")).select("u", "v")


@query(_s("SELECT u, v FROM sites_gt WHERE least(pre_z, post_z) >= 0 AND greatest(pre_z, post_z) < 60000 AND greatest(pre_y, post_y) < 3000 AND greatest(pre_x, post_x) < 6000"))
def site_roi_removed(v):
    return sites.in_roi(v.sites("gt"), BOX).select("u", "v")


@query(_s("SELECT u, v FROM sites_pred WHERE score > 0.7"))
def site_score_filter(v):
    return sites.above_score(v.sites("pred"), 0.7).select("u", "v")


@query(_s("SELECT pre_label, post_label, list_sort(list(id)) AS ids FROM sites_gt GROUP BY 1, 2"))
def site_pair_map(v):
    return v.sites("gt").groupBy("pre_label", "post_label").agg(F.sort_array(F.collect_list("id")).alias("ids"))


@query(_s("SELECT DISTINCT post_label AS label FROM sites_gt"))
def site_post_labels(v):
    return v.sites("gt").select(F.col("post_label").alias("label")).distinct()
