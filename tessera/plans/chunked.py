"""Queries over volumes in chunk rows, datasets and models on blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.geometry import Roi
from tessera.operators import chunk_labels, chunks, kernels, surface
from tessera.plans.fixtures import Views
from tessera.plans.volumes import _DISTANCE, _MOVES, _OBJECTS, _SAME, _beside, _v
from tessera.session import scratch_path
from tessera.sources import arrays, datasets, volumes

QUERIES, ORACLE = {}, {}
SIZE = (64, 4, 4)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _roi(v) -> Roi:
    """The volume's box in voxels, so that the last chunks end with it."""
    return Roi((0, 0, 0), (v.table("embeddings").agg(F.max("vec_id")).first()[0] + 1, 8, 8))


def _values(v, size=SIZE) -> DataFrame:
    return volumes.chunks_of(v.voxels(), size, roi=_roi(v))


def _labels(v, size=SIZE) -> DataFrame:
    return volumes.chunks_of(v.label_voxels(), size, "int64", "label", _roi(v))


def _rows(c: DataFrame, name: str = "value", kind: str = "bigint") -> DataFrame:
    return volumes.voxels_of(c, True, kind).withColumnRenamed("value", name)


@query(_v(f"SELECT z, y, x, least(value, CASE WHEN lz = z - 1 THEN vz END, CASE WHEN hz = z + 1 THEN nz END) AS value FROM {_beside('voxels', 'value')}"))
def chunk_erode_min(v):
    return _rows(chunks.eroded_min(_values(v), size=SIZE))


@query(_v("SELECT a.z, a.y, a.x, min(b.value) AS value FROM voxels a JOIN voxels b ON b.y = a.y AND b.x = a.x AND b.z BETWEEN a.z - 5 AND a.z + 5 GROUP BY ALL"))
def chunk_erode_wide(v):
    """A halo wider than a chunk."""
    return _rows(chunks.eroded_min(_values(v, (2, 4, 4)), steps=5, size=(2, 4, 4)))


@query(_v("SELECT floor(z / 2)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, avg(value) AS value FROM voxels GROUP BY 1, 2, 3"))
def chunk_downsample_mean(v):
    return _rows(chunks.downsampled(_values(v), (2, 2, 2)), kind="double")


@query(_v("SELECT floor(z / 2)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, label FROM label_voxels WHERE z % 2 = 1 AND y % 2 = 1 AND x % 2 = 1"))
def chunk_downsample_label(v):
    return _rows(chunks.downsampled(_labels(v), (2, 2, 2), "label"), "label")


@query(_v("SELECT z, floor(y / 3)::BIGINT AS y, floor(x / 3)::BIGINT AS x, max(value) AS value FROM voxels GROUP BY 1, 2, 3"))
def chunk_pool_max(v):
    return _rows(chunks.downsampled(_values(v, (64, 6, 6)), (1, 3, 3), "max"))


@query(_v(f"SELECT z, y, x, CASE WHEN {_SAME} THEN label ELSE 0 END AS label FROM {_beside('coarse', 'label')}", {"coarse": "SELECT z, y, x, CASE WHEN value > 100 THEN 1 ELSE 0 END::BIGINT AS label FROM voxels"}))
def chunk_grow_boundary(v):
    return _rows(chunks.boundary_grown(chunks.each(_values(v), lambda a: (a > 100).astype("uint8")), size=SIZE), "label")


@query(_v(f"SELECT DISTINCT z, y, x FROM (SELECT (z + dz)::BIGINT AS z, (y + dy)::BIGINT AS y, (x + dx)::BIGINT AS x FROM label_voxels, {_MOVES} WHERE label = 3) SEMI JOIN voxels USING (z, y, x)"))
def chunk_dilate(v):
    return volumes.voxels_of(chunks.dilated(chunks.each(_labels(v), lambda a: (a == 3).astype("uint8")), size=SIZE)).select("z", "y", "x")


_AFF = f"SELECT z, y, x, least(value, coalesce(CASE WHEN lz = z - 1 THEN vz END, 255)) AS aff_z, value AS aff_y, value AS aff_x FROM {_beside('voxels', 'value')}"
_LONG = " UNION ALL ".join(f"SELECT z, y, x, aff_{a} AS value, 'aff_{a}' AS channel FROM affs" for a in "zyx")


@query(_v(_LONG, {"affs": _AFF}))
def chunk_prob_to_affs(v):
    return volumes.voxels_of(chunks.probability_affinities(_values(v), size=SIZE), True)


_SEG = "SELECT z, y, x, " + ", ".join(f"CASE WHEN label <> 0 AND l{a} = {a} - 1 AND v{a} = label THEN 255 ELSE 0 END::BIGINT AS aff_{a}" for a in "zyx") + f" FROM {_beside('label_voxels', 'label')}"


@query(_v(_LONG, {"affs": _SEG}))
def chunk_seg_to_affs(v):
    return volumes.voxels_of(chunks.label_affinities(_labels(v), size=SIZE), True)



def _cross(axes: str) -> str:
    return "least(value, " + ", ".join(f"CASE WHEN l{a} = {a} - 1 THEN v{a} END, CASE WHEN h{a} = {a} + 1 THEN n{a} END" for a in axes) + ")"


@query(_v("SELECT * FROM m2", {
    "m0": "SELECT z, y, x, CASE WHEN value > 60 THEN 1 ELSE 0 END::BIGINT AS value FROM voxels",
    "m1": f"SELECT z, y, x, {_cross('zyx')} AS value FROM {_beside('m0', 'value')}",
    "m2": f"SELECT z, y, x, {_cross('yx')} AS value FROM {_beside('m1', 'value')}",
}))
def chunk_mask_propagated(v):
    return _rows(chunks.mask_propagated(chunks.each(_values(v), lambda a: (a > 60).astype("uint8")), 2, 1, size=SIZE))


_LEVELS = {
    "s1": "SELECT z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, avg(value) AS value FROM voxels GROUP BY 1, 2, 3",
    "s2": "SELECT floor(z / 2)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, avg(value) AS value FROM s1 GROUP BY 1, 2, 3",
}


@query(_v("SELECT 1 AS level, z, y, x, value FROM s1 UNION ALL SELECT 2, z, y, x, value FROM s2", _LEVELS))
def pyramid_levels(v):
    roi, voxel = _roi(v), (40, 4, 4)
    world = Roi(roi.begin, tuple(e * s for e, s in zip(roi.end, voxel)))
    levels = chunks.pyramid_levels(_values(v), voxel, world, SIZE, [(1, 2, 2), (2, 2, 2)])
    parts = [_rows(c, kind="double").select(F.lit(k + 1).alias("level"), "z", "y", "x", "value") for k, (_, _, c) in enumerate(levels)]
    return parts[0].union(parts[1])


@query(_v("""SELECT bz, "by", bx, (max(z) - bz * 48 + 1)::INTEGER AS nz, (max(y) - "by" * 8 + 1)::INTEGER AS ny, (max(x) - bx * 3 + 1)::INTEGER AS nx, sum(value)::BIGINT AS total
    FROM (SELECT *, floor(z / 48)::BIGINT AS bz, floor(y / 8)::BIGINT AS "by", floor(x / 3)::BIGINT AS bx FROM voxels) GROUP BY bz, "by", bx"""))
def rechunk_blocks(v):
    def run(stream):
        for rows in stream:
            yield rows[["bz", "by", "bx", "nz", "ny", "nx"]].assign(total=[int(chunks._array(r).sum()) for r in rows.itertuples(index=False)])

    return chunks.rechunked(_values(v), (48, 8, 3)).mapInPandas(run, "bz bigint, by bigint, bx bigint, nz int, ny int, nx int, total bigint")


@query(_v("SELECT z, y, x, CASE WHEN value > 127 THEN 255 ELSE 0 END::BIGINT AS value FROM voxels"))
def predicted_blocks(v):
    return _rows(chunks.predicted(_values(v), lambda a: (a > 0).astype("float32"), (2, 1, 1), size=SIZE))


@query(_v("""SELECT z, y, x, CASE WHEN m > 127.5 THEN 255 ELSE 0 END::BIGINT AS value
    FROM (SELECT z, y, x, avg(value) OVER (PARTITION BY z, y // 3, x // 3) AS m FROM voxels)"""))
def predicted_coarse(v):
    """A model that sees means over 3 x 3 pixels, which no chunk's size is a multiple of."""
    return _rows(chunks.predicted(_values(v), lambda a: (a > 0).astype("float32"), (0, 1, 1), xy_downsample=3, size=SIZE))


@query(_v("SELECT floor(z / 4)::BIGINT AS z, floor(y / 2)::BIGINT AS y, floor(x / 2)::BIGINT AS x, max(label) = 0 AS empty FROM label_voxels GROUP BY 1, 2, 3"))
def chunk_emptiness(v):
    return chunks.emptiness(_labels(v, (4, 2, 2))).select(F.col("bz").alias("z"), F.col("by").alias("y"), F.col("bx").alias("x"), "empty")


@query(_v("SELECT z, y, x, value FROM voxels WHERE z >= 3 AND z < 70 AND y >= 1 AND y < 6 AND x >= 2 AND x < 8 AND value <> 0"))
def dataset_box(v):
    folder, roi = scratch_path(v.spark, "dataset"), _roi(v)
    world = Roi(roi.begin, tuple(e * s for e, s in zip(roi.end, (40, 4, 4))))
    datasets.write(datasets.create(v.spark, folder, "volumes/raw", world, (40, 4, 4), SIZE), _values(v))
    return datasets.open_dataset(v.spark, folder, "volumes/raw").in_box(Roi((120, 4, 8), (2800, 24, 32)))


@query(_v("SELECT z, y, x, (CASE WHEN z % 128 < 64 THEN value ELSE 0 END)::BIGINT AS value FROM voxels"))
def constant_mask(v):
    """Chunks of ones and of zeros, laid over the volume."""
    from tessera.geometry import chunks as grid

    spots = grid(v.spark, _roi(v), SIZE)
    mask = chunks.constant(spots.filter("bz % 2 = 0"), SIZE, 1).union(chunks.constant(spots.filter("bz % 2 = 1"), SIZE, 0))
    return _rows(chunks.multiplied(_values(v), mask))


@query(_v("SELECT o.z, o.y, o.x, min(object) + 1 AS object FROM walk JOIN on_ o USING (pos) GROUP BY 1, 2, 3", _OBJECTS, recursive=True))
def chunk_label_voxels(v):
    found = chunk_labels.labelled(chunks.each(_values(v), lambda a: (a > 160).astype("uint8")), (8, 8))
    return volumes.voxels_of(found).withColumnRenamed("value", "object")


_LUT = "SELECT l_orderkey::BIGINT % 40 AS src, max(l_partkey)::BIGINT AS dst FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1"


def _lut(v) -> DataFrame:
    lines = v.table("lineitem").filter("l_orderkey % 3 <> 0")
    return lines.groupBy((F.col("l_orderkey") % 40).cast("bigint").alias("src")).agg(F.max("l_partkey").cast("bigint").alias("dst"))


@query(_v(f"SELECT z, y, x, CASE WHEN label = 0 THEN 0 ELSE coalesce(dst, label) END AS label FROM label_voxels LEFT JOIN ({_LUT}) ON src = label"))
def chunk_relabel(v):
    return _rows(chunk_labels.relabelled(_labels(v), _lut(v)), "label")


@query(_v("SELECT label, count(*) AS n FROM label_voxels WHERE label <> 0 GROUP BY label"))
def chunk_label_volumes(v):
    return chunk_labels.volumes(_labels(v))


@query(_v("SELECT label, count(*) AS n, " + ", ".join(f"min({a}) AS {a}0, max({a}) + 1 AS {a}1" for a in "zyx") + " FROM label_voxels WHERE label <> 0 GROUP BY label"))
def chunk_label_boxes(v):
    return chunk_labels.boxes(_labels(v))


@query(_DISTANCE)
def chunk_distances(v):
    return _rows(chunks.distances(_labels(v), (40, 4, 4), size=SIZE), "distance", "double")


@query(_v("SELECT z, y, x, value FROM voxels WHERE z >= 3 AND z < 70 AND y >= 1 AND y < 6 AND x >= 2 AND x < 8"))
def array_folder_box(v):
    """Written as a chunked array folder through the data source; the box opens only the chunks it touches."""
    v.spark.dataSource.register(arrays.ArrayFolder)
    folder, end = scratch_path(v.spark, "array"), _roi(v).end
    _values(v).write.format("array_folder").mode("append").options(shape=",".join(map(str, end)), size=",".join(map(str, SIZE))).save(folder)
    roi = Roi((3, 1, 2), (70, 6, 8))
    return volumes.voxels_of(arrays.in_box(v.spark, folder, roi), True).filter(roi.contains())


@query()
def chunk_watershed(v):
    return _rows(kernels.watershed_chunks(_values(v), SIZE, 140, context=2), "fragment")


@query()
def mesh_measures(v):
    """Closed surfaces of all labels: triangles, volume and area."""
    mesh = surface.triangles(_labels(v), SIZE)
    return surface.measures(mesh, (40.0, 4.0, 4.0)).select("label", "triangles", F.round("volume", 3).alias("volume"), F.round("area", 3).alias("area"))
