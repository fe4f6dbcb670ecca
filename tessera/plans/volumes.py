"""Queries over volumes, statistics, incremental work and kernels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import incremental, kernels, stats, volume
from tessera.plans.fixtures import Views, with_views

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _v(tail: str, more: dict | None = None, recursive: bool = False) -> str:
    return with_views(tail, "label_voxels", more=more, recursive=recursive)


_BESIDE = """(SELECT *, lag(z) OVER wz AS lz, lag({c}) OVER wz AS vz, lag(y) OVER wy AS ly, lag({c}) OVER wy AS vy, lag(x) OVER wx AS lx, lag({c}) OVER wx AS vx,
    lead(z) OVER wz AS hz, lead({c}) OVER wz AS nz, lead(y) OVER wy AS hy, lead({c}) OVER wy AS ny, lead(x) OVER wx AS hx, lead({c}) OVER wx AS nx
    FROM {t} WINDOW wz AS (PARTITION BY y, x ORDER BY z), wy AS (PARTITION BY z, x ORDER BY y), wx AS (PARTITION BY z, y ORDER BY x))"""


def _beside(t: str, c: str) -> str:
    return _BESIDE.format(t=t, c=c)


@query(_v("SELECT z, y, x, CASE WHEN value < 120 THEN 0 ELSE value END AS value FROM voxels"))
def volume_threshold(v):
    return volume.to_zero(v.voxels(), 120)


@query(_v("SELECT z, y, x, CASE WHEN value < 120 THEN 0 ELSE 255 END::BIGINT AS value FROM voxels"))
def volume_clamp(v):
    return volume.clamped(v.voxels(), 120)


@query(_v("SELECT z, y, x, CASE WHEN label = 0 THEN 7 ELSE value END AS value FROM (SELECT v.*EXCLUDE (label), l.label FROM voxels v JOIN label_voxels l USING (z, y, x))"))
def volume_mask(v):
    return volume.masked(v.voxels(), v.label_voxels().withColumnRenamed("label", "mask"), "set", 7)


@query(_v("SELECT z, y, x, value * (CASE WHEN label = 0 THEN 0 ELSE 1 END) AS value FROM (SELECT v.* EXCLUDE (label), l.label FROM voxels v JOIN label_voxels l USING (z, y, x))"))
def volume_mask_multiply(v):
    mask = v.label_voxels().select("z", "y", "x", (F.col("label") != 0).cast("bigint").alias("mask"))
    return volume.masked(v.voxels(), mask, "multiply")


@query(_v("SELECT a.z, a.y, a.x, CASE WHEN a.z = 20 THEN 0 ELSE coalesce(b.value, a.value) END AS value FROM voxels a LEFT JOIN voxels b ON b.y = a.y AND b.x = a.x AND b.z = CASE a.z WHEN 10 THEN 11 WHEN 15 THEN 14 END"))
def section_replace(v):
    return volume.sections_replaced(v.voxels(), {10: 11, 15: 14}, [20]).select("z", "y", "x", "value")


@query(_v("SELECT floor(z / 2)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, avg(value) AS value FROM voxels GROUP BY 1, 2, 3"))
def volume_downsample_mean(v):
    return volume.downsampled_mean(v.voxels(), (2, 2, 2))


@query(_v("SELECT floor(z / 2)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, label FROM label_voxels WHERE z % 2 = 1 AND y % 2 = 1 AND x % 2 = 1"))
def volume_downsample_label(v):
    return volume.downsampled_labels(v.label_voxels(), (2, 2, 2))


def _pool(how):
    def run(v):
        return volume.pooled(v.voxels(), 3, how).withColumn("value", F.round(F.col("value").cast("double"), 9))

    run.__name__ = f"volume_pool_{how}"
    return run


for _how, _f in (("max", "max"), ("min", "min"), ("mean", "avg")):
    query(_v(f"SELECT z, floor(y / 3)::BIGINT AS y, floor(x / 3)::BIGINT AS x, round({_f}(value)::DOUBLE, 9) AS value FROM voxels GROUP BY 1, 2, 3"))(_pool(_how))


@query(_v(f"SELECT z, y, x, least(value, CASE WHEN lz = z - 1 THEN vz END, CASE WHEN hz = z + 1 THEN nz END) AS value FROM {_beside('voxels', 'value')}"))
def volume_erode_min(v):
    return volume.eroded_min(v.voxels(), "z")


@query(_v(f"SELECT z, y, x, least(value, coalesce(CASE WHEN lz = z - 1 THEN vz END, 255)) AS aff_z, value AS aff_y, value AS aff_x FROM {_beside('voxels', 'value')}"))
def prob_to_affs(v):
    return volume.probability_affinities(v.voxels())


@query(_v(f"SELECT z, y, x, " + ", ".join(f"CASE WHEN label <> 0 AND l{a} = {a} - 1 AND v{a} = label THEN 255 ELSE 0 END::BIGINT AS aff_{a}" for a in "zyx") + f" FROM {_beside('label_voxels', 'label')}"))
def seg_to_affs(v):
    return volume.label_affinities(v.label_voxels())


_SAME = " AND ".join(f"coalesce(CASE WHEN l{a} = {a} - 1 THEN v{a} END, label) = label AND coalesce(CASE WHEN h{a} = {a} + 1 THEN n{a} END, label) = label" for a in "zyx")


@query(_v(f"SELECT z, y, x, CASE WHEN {_SAME} THEN label ELSE 0 END AS label FROM {_beside('coarse', 'label')}", {"coarse": "SELECT z, y, x, CASE WHEN value > 100 THEN 1 ELSE 0 END::BIGINT AS label FROM voxels"}))
def grow_boundary(v):
    return volume.boundary_grown(v.voxels().select("z", "y", "x", (F.col("value") > 100).cast("bigint").alias("label")))


_MOVES = "(SELECT unnest([0, -1, 1, 0, 0, 0, 0]) AS dz, unnest([0, 0, 0, -1, 1, 0, 0]) AS dy, unnest([0, 0, 0, 0, 0, -1, 1]) AS dx)"


@query(_v(f"SELECT DISTINCT (z + dz)::BIGINT AS z, (y + dy)::BIGINT AS y, (x + dx)::BIGINT AS x FROM label_voxels, {_MOVES} WHERE label = 3"))
def dilate_mask(v):
    return volume.dilated(v.label_voxels().filter("label = 3"))


@query(_v(f"""SELECT DISTINCT p.a, p.b, p.z, p.y, p.x FROM (SELECT 2 AS a, 3 AS b, (z + dz)::BIGINT AS z, (y + dy)::BIGINT AS y, (x + dx)::BIGINT AS x FROM label_voxels, {_MOVES} WHERE label = 2) p
    JOIN (SELECT (z + dz)::BIGINT AS z, (y + dy)::BIGINT AS y, (x + dx)::BIGINT AS x FROM label_voxels, {_MOVES} WHERE label = 3) q USING (z, y, x)"""))
def ambiguous_boundary(v):
    return volume.ambiguous_boundary(v.label_voxels(), v.spark.createDataFrame([(2, 3)], "a int, b int"), 1)


_FACES = " UNION ALL ".join(
    f"SELECT label, z, y, x, '{a}' AS axis, '{side}' AS side FROM near WHERE label <> 0 AND coalesce(CASE WHEN {p}{a} = {a} {s} 1 THEN {q}{a} END <> label, true)"
    for a in "zyx" for side, p, q, s in (("low", "l", "v", "-"), ("high", "h", "n", "+"))
)


@query(_v(_FACES, {"near": f"SELECT * FROM {_beside('label_voxels', 'label')}"}))
def surface_faces(v):
    return volume.surface_faces(v.label_voxels())


_OBJECTS = {
    "on_": "SELECT z, y, x, z * 64 + y * 8 + x AS pos FROM voxels WHERE value > 160",
    "half": "SELECT a.pos AS a, b.pos AS b FROM on_ a JOIN on_ b ON b.pos = a.pos + 64 UNION ALL SELECT a.pos, b.pos FROM on_ a JOIN on_ b ON b.pos = a.pos + 8 WHERE a.y < 7 UNION ALL SELECT a.pos, b.pos FROM on_ a JOIN on_ b ON b.pos = a.pos + 1 WHERE a.x < 7",
    "both_": "SELECT a, b FROM half UNION ALL SELECT b, a FROM half",
    "walk(pos, object)": "SELECT pos, pos FROM on_ UNION SELECT b, object FROM walk JOIN both_ ON a = walk.pos WHERE object < b",
}


def _objects(v):
    return volume.labelled(v.voxels().filter("value > 160"), (8, 8))


@query(_v("SELECT o.z, o.y, o.x, min(object) AS object FROM walk JOIN on_ o USING (pos) GROUP BY 1, 2, 3", _OBJECTS, recursive=True))
def label_voxels(v):
    return _objects(v)


_PROPS = _OBJECTS | {
    "objects": "SELECT o.z, o.y, o.x, v.value, min(object) AS object FROM walk JOIN on_ o USING (pos) JOIN voxels v ON v.z = o.z AND v.y = o.y AND v.x = o.x GROUP BY 1, 2, 3, 4",
    "props": "SELECT object AS label, count(*) AS area, min(z) AS z0, max(z) + 1 AS z1, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1, round(avg(z), 9) AS cz, round(avg(y), 9) AS cy, round(avg(x), 9) AS cx, sum(value)::BIGINT AS sum, round(avg(value), 9) AS mean, max(value) AS max FROM objects WHERE object <> 0 GROUP BY 1",
}


def _props(v):
    p = volume.region_props(_objects(v).join(v.voxels(), ["z", "y", "x"]), "object")
    return p.withColumns({c: F.round(c, 9) for c in ("cz", "cy", "cx", "mean")})


@query(_v("SELECT * FROM props", _PROPS, recursive=True))
def region_props(v):
    return _props(v)


@query(_v("SELECT label, sum::DOUBLE AS score FROM props WHERE sum >= 800", _PROPS, recursive=True))
def region_scores(v):
    return volume.region_scores(_props(v), "sum", 800)


@query(_v(f"""SELECT z, y, x, value FROM voxels a WHERE value > 160 AND NOT EXISTS (SELECT 1 FROM voxels b WHERE b.value > a.value AND b.z BETWEEN a.z - 1 AND a.z + 1
    AND b.z IN (a.z - 1, a.z, a.z + 1) AND pow(b.z - a.z, 2) + pow(b.y - a.y, 2) / 4 + pow(b.x - a.x, 2) / 4 <= 1)"""))
def nms_maxima(v):
    return volume.local_maxima(v.voxels(), (1, 2, 2), 160)


@query(_v("""SELECT z, y, x, tz, ty, tx FROM (SELECT *, (round_even((z * 40 + dz * 1.5) / 40, 0) * 40)::BIGINT AS tz, (round_even((y * 4 + dy * 1.5) / 4, 0) * 4)::BIGINT AS ty, (round_even((x * 4 + dx * 1.5) / 4, 0) * 4)::BIGINT AS tx
    FROM (SELECT z, y, x, value % 97 - 48 AS dz, value % 13 - 6 AS dy, value % 7 - 3 AS dx FROM voxels)) WHERE sqrt(pow(tz - z * 40, 2) + pow(ty - y * 4, 2) + pow(tx - x * 4, 2)) >= 20"""))
def direction_targets(v):
    p = v.voxels().select((F.col("z") * 40).alias("z"), (F.col("y") * 4).alias("y"), (F.col("x") * 4).alias("x"), (F.col("value") % 97 - 48).alias("dz"), (F.col("value") % 13 - 6).alias("dy"), (F.col("value") % 7 - 3).alias("dx"))
    return volume.targets(p, 1.5, (40, 4, 4), 20).select((F.col("z") / 40).cast("bigint").alias("z"), (F.col("y") / 4).cast("bigint").alias("y"), (F.col("x") / 4).cast("bigint").alias("x"), "tz", "ty", "tx")


@query(_v("SELECT f.z, f.y, f.x, least(f.value, c.value) AS value FROM voxels f JOIN voxels c ON c.z = f.z AND c.y = floor(f.y / 2) AND c.x = floor(f.x / 2)"))
def upsample_min(v):
    coarse = v.voxels().filter("y < 4 and x < 4")
    return volume.upsampled_min(v.voxels(), coarse, (1, 2, 2))


@query(_v("SELECT l.label, count(*) AS n FROM voxels p JOIN label_voxels l USING (z, y, x) GROUP BY 1"))
def point_labels(v):
    p = v.voxels().select((F.col("z") * 40 + 13).alias("z"), (F.col("y") * 4 + 1).alias("y"), (F.col("x") * 4 + 3).alias("x"))
    return volume.points_labelled(p, v.label_voxels(), (40, 4, 4)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(_v("SELECT v.y, v.x, max(value) AS value FROM voxels v JOIN label_voxels l USING (z, y, x) WHERE l.label IN (2, 5) GROUP BY 1, 2"))
def projected_max(v):
    return volume.projected_max(v.voxels(), v.label_voxels(), v.spark.createDataFrame([(2,), (5,)], "label bigint"))


@query(_v("SELECT floor(z / 4)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, max(label) = 0 AS empty FROM label_voxels GROUP BY 1, 2, 3"))
def block_emptiness(v):
    return volume.emptiness(v.label_voxels(), (4, 2, 2), "label")


@query(_v("SELECT label, count(*) AS n FROM label_voxels GROUP BY 1"))
def label_counts(v):
    return v.label_voxels().groupBy("label").agg(F.count(F.lit(1)).alias("n"))


_HIST = "SELECT least(floor((value - 0) / 6.4), 39)::BIGINT AS bin, count(*) AS n FROM voxels WHERE value BETWEEN 0 AND 256 GROUP BY 1"


@query(_v(_HIST))
def attr_histogram(v):
    return stats.histogram(v.voxels(), "value", 40, 0, 256)


@query(_v(f"SELECT bin, n, (sum(n) OVER (ORDER BY bin))::BIGINT AS total FROM ({_HIST})"))
def cumulative_histogram(v):
    return stats.cumulative(stats.histogram(v.voxels(), "value", 40, 0, 256))


@query("""SELECT round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)), 6) AS t, na + nb - 2 AS df FROM (
    SELECT avg(o_totalprice) FILTER (o_orderstatus = 'F') AS ma, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS mb, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS va, var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS vb,
    count(*) FILTER (o_orderstatus = 'F') AS na, count(*) FILTER (o_orderstatus = 'O') AS nb FROM orders)""")
def ttest_stat(v):
    return stats.t_statistic(v.table("orders"), "o_orderstatus", "o_totalprice", "F", "O").withColumn("t", F.round("t", 6))


@query("""WITH p AS (SELECT c_acctbal AS x, (c_custkey % 97)::DOUBLE AS y FROM customer), m AS (SELECT count(*) AS n, covar_samp(x, x) * pow(count(*), -1.0 / 3) AS xx, covar_samp(x, y) * pow(count(*), -1.0 / 3) AS xy, covar_samp(y, y) * pow(count(*), -1.0 / 3) AS yy FROM p),
    s AS (SELECT *, xx * yy - xy * xy AS det FROM m), q AS (SELECT s_suppkey AS i, s_acctbal AS qx, (s_suppkey % 97)::DOUBLE AS qy FROM supplier)
    SELECT i, round(sum(exp(-(pow(qx - x, 2) * yy - 2 * (qx - x) * (qy - y) * xy + pow(qy - y, 2) * xx) / det / 2)) / (2 * pi() * sqrt(any_value(det)) * any_value(n)), 9) AS density
    FROM q, p, s GROUP BY i""")
def kde_density(v):
    points = v.table("customer").select(F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 97).cast("double").alias("y"))
    at = v.table("supplier").select(F.col("s_suppkey").alias("i"), F.col("s_acctbal").alias("x"), (F.col("s_suppkey") % 97).cast("double").alias("y"))
    return stats.density(points, at).withColumn("density", F.round("density", 9))


@query(with_views("SELECT block_id FROM completion WHERE NOT done", "completion"))
def pending_blocks(v):
    e = v.events_done()
    return incremental.pending(e.select("block_id"), e.filter("done"))


@query(with_views("SELECT block_id FROM completion WHERE NOT done OR block_id % 10 = 3", "completion"))
def forced_blocks(v):
    e = v.events_done()
    blocks = e.select("block_id")
    return incremental.forced(blocks, e.filter("done"), mask=blocks.filter("block_id % 10 = 3"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS value FROM customer UNION ALL SELECT c_custkey + 1000000, 'new' FROM customer WHERE c_custkey % 7 = 0")
def superfragment_upsert(v):
    old = v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("value"))
    new = old.filter("id % 3 = 0").select("id", F.lit("new").alias("value")).union(old.filter("id % 7 = 0").select(F.col("id") + 1_000_000, F.lit("new")))
    return incremental.upsert(old, new)


@query()
def watershed_block(v):
    return kernels.watershed(v.voxels(), (50, 8, 8), 140)


@query()
def agglomerate_block(v):
    nodes = v.rag_nodes()
    return kernels.agglomerate_blocks(nodes, v.rag_edges(), 0.5)


@query()
def mincut_split(v):
    e = v.rag_edges().filter("merge_score <= 0.3")
    from tessera.operators.rag import segments

    seg = segments(v.rag_nodes(), v.rag_edges(), 0.3)
    seeds = seg.groupBy("component").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return kernels.min_cut(e, seg, seeds)


_BALL = {
    "steps": "SELECT * FROM (SELECT unnest(generate_series(-2, 2)) AS dz), (SELECT unnest(generate_series(-2, 2)) AS dy), (SELECT unnest(generate_series(-2, 2)) AS dx) WHERE dz * dz + dy * dy + dx * dx <= 4",
    "near": "SELECT a.z, a.y, a.x, dz, dy, dx FROM label_voxels a CROSS JOIN steps JOIN label_voxels b ON b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx AND b.label = a.label WHERE a.label <> 0",
    "sums": "SELECT z, y, x, count(*)::DOUBLE AS n, avg(dz) AS mz, avg(dy) AS my, avg(dx) AS mx, avg(dz * dz) AS zz, avg(dy * dy) AS yy, avg(dx * dx) AS xx, avg(dz * dy) AS zy, avg(dz * dx) AS zx, avg(dy * dx) AS yx FROM near GROUP BY ALL",
    "spreads": "SELECT *, greatest(zz - mz * mz, 0) AS vz, greatest(yy - my * my, 0) AS vy, greatest(xx - mx * mx, 0) AS vx FROM sums",
    "found": "SELECT l.z, l.y, l.x, " + ", ".join(f"round(coalesce({c}, 0), 6) + 0.0 AS {n}" for c, n in [
        ("n", "n"), *[(f"m{a}", f"mean_{a}") for a in "zyx"], *[(f"v{a}", f"var_{a}") for a in "zyx"],
        *[(f"CASE WHEN sqrt(v{a} * v{b}) > 1e-12 THEN ({a}{b} - m{a} * m{b}) / sqrt(v{a} * v{b}) ELSE 0 END", f"r_{a}{b}") for a, b in ("zy", "zx", "yx")]]) + " FROM label_voxels l LEFT JOIN spreads s ON s.z = l.z AND s.y = l.y AND s.x = l.x",
}


@query(_v("SELECT * FROM found", _BALL))
def local_descriptors(v):
    found = kernels.descriptors(v.label_voxels(), (10, 8, 8), 2)
    return found.withColumns({c: F.round(c, 6) + 0.0 for c in found.columns if c not in "zyx"})


#: All other labels within two sections are tried: what is found there is under 3 * 40, so nothing farther off is nearer.
_DISTANCE = _v("""SELECT a.z, a.y, a.x, (SELECT min(sqrt((40 * (a.z - b.z)) ** 2 + (4 * (a.y - b.y)) ** 2 + (4 * (a.x - b.x)) ** 2))
    FROM label_voxels b WHERE b.z BETWEEN a.z - 2 AND a.z + 2 AND b.label <> a.label) AS distance FROM label_voxels a""")


@query(_DISTANCE)
def distance_transform(v):
    return kernels.edt(v.label_voxels(), (50, 8, 8), (40, 4, 4))


def _weights(sigma: float, reach: int) -> str:
    w = f"exp(-0.5 * pow(d / {sigma}, 2))"
    return f"SELECT d, {w} / sum({w}) OVER () AS w FROM (SELECT unnest(generate_series(-{reach}, {reach})) AS d)"


def _smoothed(t: str, axis: str, w: str) -> str:
    rest = [a for a in "zyx" if a != axis]
    return f"SELECT a.z, a.y, a.x, sum(b.value * w) AS value FROM {t} a CROSS JOIN {w} JOIN {t} b ON b.{axis} = a.{axis} + d AND b.{rest[0]} = a.{rest[0]} AND b.{rest[1]} = a.{rest[1]} GROUP BY ALL"


_GAUSS = {"fine": _weights(0.7, 3), "wide": _weights(1.0, 3), "along_z": _smoothed("voxels", "z", "fine"), "along_y": _smoothed("along_z", "y", "wide"), "along_x": _smoothed("along_y", "x", "wide")}


@query(_v("SELECT z, y, x, round(value, 6) AS value FROM along_x", _GAUSS))
def gaussian_smooth(v):
    return kernels.gaussian(v.voxels(), (50, 8, 8), (0.7, 1.0, 1.0)).withColumn("value", F.round("value", 6))


@query(_v("SELECT z, y, x, (CASE WHEN label IN (2, 5) THEN 1 ELSE 0 END)::BIGINT AS mask FROM label_voxels"))
def foreground_mask(v):
    return volume.mask_of_labels(v.label_voxels(), v.spark.createDataFrame([(2,), (5,)], "label bigint"))


@query(_v("SELECT z, y, x, (CASE WHEN label = 0 THEN 0 ELSE 1 END)::BIGINT AS mask FROM label_voxels"))
def unlabelled_mask(v):
    return volume.unlabelled_mask(v.label_voxels())


@query(_v("SELECT z, y, x, (CASE WHEN label <> 0 AND label IN (SELECT label FROM label_voxels WHERE z < 3) THEN 1 ELSE 0 END)::BIGINT AS mask FROM label_voxels"))
def touched_mask(v):
    points = v.voxels().filter("z < 3").select((F.col("z") * 40 + 5).alias("z"), (F.col("y") * 4 + 1).alias("y"), (F.col("x") * 4 + 2).alias("x"))
    return volume.touched_mask(v.label_voxels(), points, (40, 4, 4))


@query(_v("SELECT z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, value FROM voxels WHERE y % 2 = 0 AND x % 2 = 0"))
def volume_strided(v):
    return volume.strided(v.voxels(), (1, 2, 2))


@query(_v("SELECT z, y, x, least(greatest(trunc(value * 1.5 - 200)::BIGINT, -128), 127)::BIGINT AS value FROM voxels"))
def volume_rescaled(v):
    return volume.rescaled(v.voxels(), 1.5, -200.0, -128, 127)


@query(_v(f"SELECT z, y, x, CASE WHEN inner_ <> 0 THEN 0 ELSE value END AS value FROM (SELECT z, y, x, value, CASE WHEN {_SAME} THEN label ELSE 0 END AS inner_ FROM {_beside('coarse', 'label')})", {"coarse": "SELECT z, y, x, value, CASE WHEN value > 100 THEN 1 ELSE 0 END::BIGINT AS label FROM voxels"}))
def prediction_cleaned(v):
    return volume.cleaned(v.voxels(), v.voxels().select("z", "y", "x", (F.col("value") > 100).cast("bigint").alias("label"))).select("z", "y", "x", "value")


@query(_v("""SELECT object, z, y, x FROM (SELECT o.*, row_number() OVER (PARTITION BY o.object ORDER BY round(pow(z - mz, 2) + pow(y - my, 2) + pow(x - mx, 2), 9), z, y, x) AS rn
    FROM objects o JOIN (SELECT object, avg(z) AS mz, avg(y) AS my, avg(x) AS mx FROM objects GROUP BY 1) m ON m.object = o.object) WHERE rn = 1""", _PROPS, recursive=True))
def object_centres(v):
    return volume.object_centres(_objects(v))


@query()
def sampled_points(v):
    return volume.sampled_points(v.label_voxels().filter("label = 3"), 50)


@query(_v("SELECT max(label) + 1 AS next FROM label_voxels"))
def next_label(v):
    from tessera.operators.rag import next_label as f

    return f(v.label_voxels())


@query(_v("SELECT z, y, x, label, label * 255 AS myelin, (CASE WHEN label = 0 AND NOT ignored THEN 1 ELSE 0 END)::BIGINT AS mask FROM (SELECT z, y, x, (CASE WHEN l.label IN (0, 2, 5) THEN 0 ELSE 1 END)::BIGINT AS label, value % 4 = 1 AS ignored FROM label_voxels l JOIN voxels v USING (z, y, x))"))
def ground_truth_masks(v):
    ids = lambda *n: v.spark.createDataFrame([(i,) for i in n], "label bigint")
    fragments = v.voxels().select("z", "y", "x", (F.col("value") % 4).alias("label"))
    return volume.ground_truth(v.label_voxels(), ids(2, 5), fragments, ids(1))


_BOUNDS = " UNION ALL ".join(f"SELECT z * 2 + {int(a == 'z')} AS z, y * 2 + {int(a == 'y')} AS y, x * 2 + {int(a == 'x')} AS x FROM near WHERE h{a} = {a} + 1 AND n{a} <> label" for a in "zyx")


@query(_v(_BOUNDS, {"near": f"SELECT * FROM {_beside('label_voxels', 'label')}"}))
def boundary_map(v):
    return volume.boundary_map(v.label_voxels())


_ERODED = _OBJECTS | {
    "objects": "SELECT o.z, o.y, o.x, min(object) AS object FROM walk JOIN on_ o USING (pos) GROUP BY 1, 2, 3",
    "e1": "SELECT a.* FROM objects a WHERE (SELECT count(*) FROM objects b WHERE b.object = a.object AND b.z = a.z AND abs(b.y - a.y) + abs(b.x - a.x) = 1) = 4",
}


@query(_v("SELECT object AS label, count(*) * 16 AS area_erode0, coalesce(any_value(n), 0) * 16 AS area_erode1 FROM objects LEFT JOIN (SELECT object, count(*) AS n FROM e1 GROUP BY 1) USING (object) GROUP BY 1", _ERODED, recursive=True))
def synapse_areas(v):
    return volume.synapse_areas(_objects(v), (40, 4, 4), (0, 1))


@query()
def slice_centres(v):
    return volume.slice_centres(_objects(v))


_TOPS = _OBJECTS | {
    "on_": """SELECT z, y, x, z * 64 + y * 8 + x AS pos, value FROM voxels a WHERE value > 160 AND NOT EXISTS (SELECT 1 FROM voxels b WHERE b.value > a.value AND b.z IN (a.z - 1, a.z, a.z + 1) AND pow(b.z - a.z, 2) + pow(b.y - a.y, 2) / 4 + pow(b.x - a.x, 2) / 4 <= 1)""",
    "tops": "SELECT pos, min(object) AS object FROM walk GROUP BY 1",
}


@query(_v("SELECT object, round(avg(z), 6) AS z, round(avg(y), 6) AS y, round(avg(x), 6) AS x, count(*) AS size, max(value) AS score FROM tops JOIN on_ USING (pos) GROUP BY 1", _TOPS, recursive=True))
def nms_centres(v):
    return volume.maxima_centres(v.voxels(), (1, 2, 2), 160, (8, 8)).withColumns({a: F.round(a, 6) for a in "zyx"})


@query("""WITH s AS (SELECT max(c_custkey) AS most FROM customer), e AS (SELECT i, trunc(i * most / 12) AS low, CASE WHEN i = 11 THEN 1e18 ELSE trunc((i + 1) * most / 12) END AS high FROM s, (SELECT unnest(generate_series(0, 11)) AS i))
    SELECT i AS bin, low::DOUBLE AS low, count(*) AS n FROM customer JOIN e ON c_custkey >= low AND c_custkey < high GROUP BY 1, 2""")
def node_histogram(v):
    return stats.node_histogram(v.table("customer"), "c_custkey", 12)


_AUTO = """WITH s AS (SELECT count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high, quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS iqr FROM orders {where}),
    b AS (SELECT low, high, ceil((high - low) / least((high - low) / (log2(n) + 1), 2 * iqr / pow(n, 1.0 / 3))) AS bins FROM s),
    h AS (SELECT least(floor((o_totalprice - low) / ((high - low) / bins)), bins - 1)::BIGINT AS bin, count(*) AS n FROM orders, b {where} GROUP BY 1) """


@query(_AUTO.format(where="") + "SELECT bin, n, (sum(n) OVER (ORDER BY bin))::BIGINT AS total, round(sum(n) OVER (ORDER BY bin) / sum(n) OVER (), 9) AS share FROM h")
def auto_histogram(v):
    return stats.auto_histogram(v.table("orders"), "o_totalprice", True).withColumn("share", F.round("share", 9))


@query("SELECT 'a' AS kind, bin, n FROM (" + _AUTO.format(where="WHERE o_orderstatus = 'F'") + "SELECT * FROM h) UNION ALL SELECT 'b', bin, n FROM (" + _AUTO.format(where="WHERE o_orderstatus = 'O'") + "SELECT * FROM h)")
def paired_histograms(v):
    o = v.table("orders")
    return stats.paired_histograms(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), "o_totalprice")


@query(_v("SELECT round((SELECT count(*) FROM voxels WHERE value > 200) / sum(CASE WHEN label <> 0 THEN 1 ELSE 0 END), 9) AS density FROM label_voxels"))
def density_by_area(v):
    return stats.density_by_area(v.voxels().filter("value > 200"), volume.unlabelled_mask(v.label_voxels())).withColumn("density", F.round("density", 9))
