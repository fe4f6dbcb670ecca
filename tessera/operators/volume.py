"""Volumes as voxel rows (z, y, x, value): thresholds, masks, pyramids, neighbourhoods, affinities, objects.

Neighbours along an axis are found by a window over the other two axes; a gap in the
rows is no neighbour. Neighbourhood steps repeat such windows, one exchange an axis.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.components import component_edges
from tessera.session import materialize

AXES = ("z", "y", "x")
FACES = [(-1, 0, 0), (1, 0, 0), (0, -1, 0), (0, 1, 0), (0, 0, -1), (0, 0, 1)]


def to_zero(v: DataFrame, least: float, column: str = "value") -> DataFrame:
    return v.withColumn(column, F.when(F.col(column) < least, 0).otherwise(F.col(column)))


def clamped(v: DataFrame, low: float, column: str = "value") -> DataFrame:
    """Below ``low`` to 0, else 255."""
    return v.withColumn(column, F.when(F.col(column) < low, 0).otherwise(255).cast("bigint"))


def masked(v: DataFrame, mask: DataFrame, how: str = "multiply", constant: int = 0, column: str = "value", absent: int = 0) -> DataFrame:
    """By a mask (z, y, x, mask): ``multiply``, ``and`` (both non-zero), or ``set`` a constant where the mask is 0. A voxel that the mask lacks has ``absent`` there."""
    both = v.join(mask.select(*AXES, "mask"), list(AXES), "left").withColumn("mask", F.coalesce("mask", F.lit(absent)))
    value = {
        "multiply": F.col(column) * F.col("mask"),
        "and": ((F.col(column) != 0) & (F.col("mask") != 0)).cast("bigint"),
        "set": F.when(F.col("mask") == 0, constant).otherwise(F.col(column)),
    }[how]
    return both.withColumn(column, value).drop("mask")


def constant(grid: DataFrame, value: int = 0, column: str = "mask") -> DataFrame:
    """One value at every point of a grid: null, dummy and constant masks."""
    return grid.select(*AXES, F.lit(value).cast("bigint").alias(column))


def ground_truth(segments: DataFrame, background: DataFrame, fragments: DataFrame | None = None, ignored: DataFrame | None = None) -> DataFrame:
    """(z, y, x, label, myelin, mask) from segments (z, y, x, label): label 0 for background ids (label) and 0, else 1; myelin 255 times that.

    The mask is 1 on background, but for voxels whose fragment (z, y, x, label) is one of ``ignored`` (label).
    """
    ids = background.select(F.col("label").cast("bigint")).union(background.sparkSession.createDataFrame([(0,)], "label bigint"))
    out = mask_of_labels(segments, ids, 0, 1).withColumnRenamed("mask", "label")
    if ignored is None or fragments is None:
        left = out.withColumn("keep", F.lit(1))
    else:
        left = out.join(mask_of_labels(fragments, ignored, 0, 1).withColumnRenamed("mask", "keep"), list(AXES), "left").withColumn("keep", F.coalesce("keep", F.lit(1)))
    mask = ((F.col("label") == 0) & (F.col("keep") == 1)).cast("bigint")
    return left.select(*AXES, "label", (F.col("label") * 255).alias("myelin"), mask.alias("mask"))


def filled(grid: DataFrame, v: DataFrame, fill: int = 0, column: str = "value") -> DataFrame:
    """A value for every point of a grid."""
    return grid.join(v, list(AXES), "left").withColumn(column, F.coalesce(column, F.lit(fill)))


def sections_replaced(v: DataFrame, replace: dict[int, int], delete: list[int] = (), column: str = "value") -> DataFrame:
    """Sections take another section's values; deleted ones become 0. A source section that is absent changes nothing."""
    if replace:
        z_of = F.create_map(*[F.lit(int(k)) for pair in replace.items() for k in pair])
        moved = v.filter(F.col("z").isin(*set(replace.values()))).select(F.col("z").alias("from_z"), "y", "x", F.col(column).alias("__new"))
        want = v.withColumn("from_z", z_of[F.col("z").cast("int")].cast("bigint"))
        v = want.join(moved, ["from_z", "y", "x"], "left").withColumn(column, F.coalesce("__new", column)).drop("from_z", "__new")
    if delete:
        v = v.withColumn(column, F.when(F.col("z").isin(*delete), 0).otherwise(F.col(column)))
    return v


def _cells(factor: tuple[int, int, int]) -> list[Column]:
    return [F.floor(F.col(a) / F.lit(k)).cast("bigint").alias(a) for a, k in zip(AXES, factor)]


def downsampled_mean(v: DataFrame, factor: tuple[int, int, int], column: str = "value") -> DataFrame:
    return v.groupBy(*_cells(factor)).agg(F.avg(column).alias(column))


def downsampled_labels(v: DataFrame, factor: tuple[int, int, int]) -> DataFrame:
    """The voxel at index k // 2 of each block: labels have no mean. No exchange."""
    keep = reduce(lambda p, q: p & q, [F.pmod(F.col(a), F.lit(k)) == k // 2 for a, k in zip(AXES, factor)])
    rest = [c for c in v.columns if c not in AXES]
    return v.filter(keep).select(*_cells(factor), *rest)


def pyramid(v: DataFrame, factors: list[tuple[int, int, int]], labels: bool = False) -> list[DataFrame]:
    """Levels s1, s2 and so on, each made from the one before."""
    out = []
    for factor in factors:
        v = downsampled_labels(v, factor) if labels else downsampled_mean(v, factor)
        out.append(v)
    return out


def next_factor(voxel: tuple[int, int, int]) -> tuple[int, int, int]:
    """Halve the axes that are finer than the coarsest, or all once they are nearly equal."""
    most = max(voxel)
    finer = tuple(2 if 2 * s <= most else 1 for s in voxel)
    return finer if 2 in finer else (2, 2, 2)


def near_isotropic(voxel: tuple[int, ...], most: int) -> tuple[int, ...]:
    """Powers of two whose product is the least that reaches ``most``, for a chunk about as long along every axis.

    The k-th doubling of an axis starts from a length of voxel * 2**k: the product needs as many doublings as
    its exponent, and the shortest starts, over all axes, are the ones to take.
    """
    needed = max(0, most - 1).bit_length()
    starts = sorted((size << k, axis) for axis, size in enumerate(voxel) for k in range(needed))[:needed]
    return tuple(1 << sum(axis == own for _, axis in starts) for own in range(len(voxel)))


def pooled(v: DataFrame, k: int, how: str, column: str = "value") -> DataFrame:
    """max, min or mean over k x k in each section; nulls are left out and the rest at the edge is pooled too."""
    f = {"max": F.max, "min": F.min, "mean": F.avg}[how]
    return v.groupBy(*_cells((1, k, k))).agg(f(column).alias(column))


def _beside(axis: str, column: str, step: int) -> Column:
    """The value one step along an axis, null if there is no such voxel."""
    w = W.partitionBy(*[a for a in AXES if a != axis]).orderBy(axis)
    get = F.lag if step < 0 else F.lead
    return F.when(get(axis).over(w) == F.col(axis) + step, get(column).over(w))


def eroded_min(v: DataFrame, axes: str = "z", steps: int = 1, column: str = "value") -> DataFrame:
    """The least of a voxel and its neighbours along some axes, repeated; outside counts as nothing."""
    for _ in range(steps):
        for axis in axes:
            v = v.withColumn(column, F.least(column, _beside(axis, column, -1), _beside(axis, column, 1)))
    return v


def probability_affinities(v: DataFrame, with_z: bool = True, pad: int = 255, column: str = "value") -> DataFrame:
    """(z, y, x, aff_z, aff_y, aff_x): in the plane the value itself; along z the least of it and the section before."""
    along = F.least(F.col(column), F.coalesce(_beside("z", column, -1), F.lit(pad))) if with_z else F.lit(0)
    return v.select(*AXES, along.cast("bigint").alias("aff_z"), F.col(column).alias("aff_y"), F.col(column).alias("aff_x"))


def label_affinities(v: DataFrame, label: str = "label") -> DataFrame:
    """255 where a voxel has the same label, not 0, as its lower neighbour along an axis."""
    out = v
    for a in AXES:
        out = out.withColumn(f"aff_{a}", F.when((F.col(label) != 0) & (_beside(a, label, -1) == F.col(label)), 255).otherwise(0).cast("bigint"))
    return out.select(*AXES, *[f"aff_{a}" for a in AXES])


def boundary_grown(v: DataFrame, steps: int = 1, axes: str = "zyx", label: str = "label") -> DataFrame:
    """Labels shrink: a voxel with a neighbour of another label becomes 0; beyond the border counts as the same."""
    for _ in range(steps):
        sides = [(a, s) for a in axes for s in (-1, 1)]
        for i, (a, s) in enumerate(sides):
            v = v.withColumn(f"__n{i}", F.coalesce(_beside(a, label, s), F.col(label)))
        same = reduce(lambda p, q: p & q, [F.col(f"__n{i}") == F.col(label) for i in range(len(sides))])
        v = v.withColumn(label, F.when(same, F.col(label)).otherwise(0)).drop(*[f"__n{i}" for i in range(len(sides))])
    return v


def dilated(mask: DataFrame, steps_3d: int = 1, steps_2d: int = 0) -> DataFrame:
    """Distinct (z, y, x) of a mask and its face neighbours, in space and then in the plane."""
    points = mask.select(*AXES)
    for moves in [FACES] * steps_3d + [FACES[2:]] * steps_2d:
        near = F.array(*[F.struct(*[(F.col(a) + d).cast("bigint").alias(a) for a, d in zip(AXES, m)]) for m in [(0, 0, 0), *moves]])
        points = points.select(F.explode(near).alias("p")).select("p.*").distinct()
    return points


def ambiguous_boundary(v: DataFrame, pairs: DataFrame, steps: int, label: str = "label") -> DataFrame:
    """Distinct (a, b, z, y, x) within ``steps`` of both fragments of a pair (a, b)."""
    def grown(side: str) -> DataFrame:
        points = v.join(pairs.select("a", "b", F.col(side).alias(label)), label).select("a", "b", *AXES)
        for _ in range(steps):
            near = F.array(*[F.struct(*[(F.col(c) + d).cast("bigint").alias(c) for c, d in zip(AXES, m)]) for m in [(0, 0, 0), *FACES]])
            points = points.select("a", "b", F.explode(near).alias("p")).select("a", "b", "p.*").distinct()
        return points

    return grown("a").join(grown("b"), ["a", "b", *AXES], "left_semi")


def surface_faces(v: DataFrame, label: str = "label") -> DataFrame:
    """(label, z, y, x, axis, side): faces between a labelled voxel and another label or nothing."""
    out = v
    for a in AXES:
        for side, s in (("low", -1), ("high", 1)):
            out = out.withColumn(f"{a}_{side}", F.coalesce(_beside(a, label, s) != F.col(label), F.lit(True)))
    open_ = F.array(*[F.when(F.col(f"{a}_{side}"), F.struct(F.lit(a).alias("axis"), F.lit(side).alias("side"))) for a in AXES for side in ("low", "high")])
    return out.filter(F.col(label) != 0).select(F.col(label).alias("label"), *AXES, F.explode(F.array_compact(open_)).alias("f")).select("label", *AXES, "f.axis", "f.side")


def _linear(shape: tuple[int, int]) -> Column:
    return (F.col("z") * shape[0] + F.col("y")) * shape[1] + F.col("x")


def labelled(v: DataFrame, shape: tuple[int, int], label: str | None = None) -> DataFrame:
    """(z, y, x, object): face-connected voxels of ``v`` (of one label, if named); the object is its least linear index.

    ``shape`` is the extent in y and x. Runs along x are contracted before components are sought.
    """
    same = [label] if label else []
    rows = v.select(*AXES, *same).withColumn("at", _linear(shape))
    w = W.partitionBy("z", "y", *same).orderBy("x")
    first = F.when(F.lag("x").over(w) == F.col("x") - 1, None).otherwise(F.col("at"))
    runs = rows.withColumn("first", first).withColumn("run", F.last("first", ignorenulls=True).over(w)).drop("first")
    runs = materialize(runs, "runs")
    links = None
    for a in ("z", "y"):
        below = runs.select(*[(F.col(c) + int(c == a)).alias(c) for c in AXES], *same, F.col("run").alias("v"))
        own = runs.join(below, [*AXES, *same]).select(F.col("run").alias("u"), "v").distinct()
        links = own if links is None else links.union(own)
    found = component_edges(links)
    return runs.join(found, F.col("run") == F.col("node"), "left").select(*AXES, *same, F.coalesce("component", "run").alias("object"))


def region_props(v: DataFrame, label: str = "label", value: str = "value") -> DataFrame:
    """Box (half-open), area, centre and value statistics of each label but 0."""
    ends = [f for a in AXES for f in (F.min(a).alias(f"{a}0"), (F.max(a) + 1).alias(f"{a}1"), F.avg(a).alias(f"c{a}"))]
    return v.filter(F.col(label) != 0).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("area"), *ends, F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def region_scores(props: DataFrame, kind: str, least: float) -> DataFrame:
    """(label, score) by sum, mean, max or count; below ``least`` is dropped."""
    return props.select("label", F.col("area" if kind == "count" else kind).cast("double").alias("score")).filter(F.col("score") >= least)


def local_maxima(v: DataFrame, radius: tuple[float, float, float], least: float, column: str = "value") -> DataFrame:
    """(z, y, x, value) above ``least`` that no voxel in the ellipsoid around exceeds. Candidates are spread, not all voxels."""
    reach = [int(r) for r in radius]
    moves = [(i, j, k) for i in range(-reach[0], reach[0] + 1) for j in range(-reach[1], reach[1] + 1) for k in range(-reach[2], reach[2] + 1)]
    inside = [m for m in moves if sum((c / r) ** 2 if r else 0 for c, r in zip(m, radius)) <= 1]
    strong = v.filter(F.col(column) > least)
    near = F.array(*[F.struct(*[(F.col(a) + d).cast("bigint").alias(a) for a, d in zip(AXES, m)]) for m in inside])
    spread = strong.select(F.col(column).alias("other"), F.explode(near).alias("p")).select("p.*", "other").groupBy(*AXES).agg(F.max("other").alias("most"))
    return strong.join(spread, list(AXES)).filter(F.col("most") <= F.col(column)).select(*AXES, column)


def maxima_centres(v: DataFrame, radius: tuple[float, float, float], least: float, shape: tuple[int, int], column: str = "value") -> DataFrame:
    """(object, z, y, x, size, score): the mean place, number of voxels and value of each face-connected plateau of maxima."""
    top = local_maxima(v, radius, least, column)
    objects = labelled(top, shape).join(top, list(AXES))
    return objects.groupBy("object").agg(*[F.avg(a).alias(a) for a in AXES], F.count(F.lit(1)).alias("size"), F.max(column).alias("score"))


def targets(points: DataFrame, scale: float, voxel_size: tuple[int, int, int], least: float, without_z: bool = False) -> DataFrame:
    """Adds tz, ty, tx: location plus scaled direction (dz, dy, dx), snapped to voxels with ties to even; nearer than ``least`` is dropped."""
    moved = {}
    for a, s in zip(AXES, voxel_size):
        step = F.lit(0.0) if a == "z" and without_z else F.col(f"d{a}") * scale
        moved[f"t{a}"] = (F.bround((F.col(a) + step) / s) * s).cast("bigint")
    out = points.withColumns(moved)
    d = F.sqrt(sum(((F.col(f"t{a}") - F.col(a)).cast("double") * (F.col(f"t{a}") - F.col(a)).cast("double") for a in AXES), F.lit(0.0)))
    return out.withColumn("distance", d).filter(F.col("distance") >= least)


def upsampled_min(fine: DataFrame, coarse: DataFrame, factor: tuple[int, int, int], column: str = "value") -> DataFrame:
    """The least of a fine voxel and the coarse voxel it lies in."""
    cells = [F.floor(F.col(a) / F.lit(k)).cast("bigint").alias(f"c{a}") for a, k in zip(AXES, factor)]
    low = coarse.select(*[F.col(a).alias(f"c{a}") for a in AXES], F.col(column).alias("__low"))
    both = fine.select("*", *cells).join(low, [f"c{a}" for a in AXES], "left")
    return both.withColumn(column, F.least(column, "__low")).drop("__low", *[f"c{a}" for a in AXES])


def points_labelled(points: DataFrame, labels: DataFrame, voxel_size: tuple[int, int, int]) -> DataFrame:
    """Points in world units with the label of their voxel; points outside go."""
    at = [F.floor(F.col(a) / F.lit(s)).cast("bigint").alias(f"v{a}") for a, s in zip(AXES, voxel_size)]
    vox = labels.select(*[F.col(a).alias(f"v{a}") for a in AXES], "label")
    return points.select("*", *at).join(vox, [f"v{a}" for a in AXES]).drop(*[f"v{a}" for a in AXES])


def projected_max(v: DataFrame, labels: DataFrame, ids: DataFrame, column: str = "value") -> DataFrame:
    """(y, x, value): maximum over z of the voxels whose label is one of ``ids`` (label)."""
    own = labels.join(ids.select("label"), "label", "left_semi").select(*AXES)
    return v.join(own, list(AXES), "left_semi").groupBy("y", "x").agg(F.max(column).alias(column))


def emptiness(v: DataFrame, block: tuple[int, int, int], column: str = "value") -> DataFrame:
    """(z, y, x of the block, empty)."""
    return v.groupBy(*_cells(block)).agg((F.max(F.abs(F.col(column))) == 0).alias("empty"))


def mask_of_labels(v: DataFrame, ids: DataFrame, inside: int = 1, outside: int = 0, label: str = "label") -> DataFrame:
    """(z, y, x, mask): foreground where the label is one of ``ids`` (label)."""
    own = ids.select(F.col("label").alias(label), F.lit(True).alias("__in")).distinct()
    return v.join(own, label, "left").select(*AXES, F.when(F.col("__in"), inside).otherwise(outside).cast("bigint").alias("mask"))


def unlabelled_mask(v: DataFrame, label: str = "label") -> DataFrame:
    """(z, y, x, mask): 0 where nothing is labelled, else 1."""
    return v.select(*AXES, (F.col(label) != 0).cast("bigint").alias("mask"))


def touched_mask(v: DataFrame, points: DataFrame, voxel_size: tuple[int, int, int], label: str = "label") -> DataFrame:
    """(z, y, x, mask): 1 in the segments, not 0, that some point lies in."""
    hit = points_labelled(points, v.select(*AXES, F.col(label).alias("label")), voxel_size).filter("label <> 0")
    return mask_of_labels(v, hit.select("label"), label=label)


def strided(v: DataFrame, factor: tuple[int, int, int]) -> DataFrame:
    """Every k-th voxel along each axis, from index 0. No exchange."""
    keep = reduce(lambda p, q: p & q, [F.pmod(F.col(a), F.lit(k)) == 0 for a, k in zip(AXES, factor)])
    rest = [c for c in v.columns if c not in AXES]
    return v.filter(keep).select(*_cells(factor), *rest)


def rescaled(v: DataFrame, scale: float, shift: float, low: int, high: int, column: str = "value") -> DataFrame:
    """value * scale + shift, truncated and clipped to a whole range."""
    value = (F.col(column) * scale + shift).cast("bigint")
    return v.withColumn(column, F.least(F.greatest(value, F.lit(low)), F.lit(high)).cast("bigint"))


def cleaned(v: DataFrame, labels: DataFrame, steps: int = 1, keep_inside: bool = False, column: str = "value") -> DataFrame:
    """A prediction without what lies inside segments shrunk by ``steps`` (or only that)."""
    inside = boundary_grown(labels.select(*AXES, "label"), steps).select(*AXES, (F.col("label") != 0).alias("__in"))
    both = v.join(inside, list(AXES), "left").withColumn("__in", F.coalesce("__in", F.lit(False)))
    return both.withColumn(column, F.when(F.col("__in") == keep_inside, F.col(column)).otherwise(0)).drop("__in")


def sampled_points(v: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """``n`` voxels of a mask, by the order of a seeded hash: the same ones however the rows are dealt."""
    return v.orderBy(F.xxhash64(F.lit(seed), *AXES), *AXES).select(*AXES).limit(n)


def boundary_map(v: DataFrame, label: str = "label") -> DataFrame:
    """(z, y, x) on the grid of 2 n - 1 points an axis: between two neighbours of different labels, 0 included, lies a boundary point."""
    out = None
    for i, a in enumerate(AXES):
        own = v.withColumn("__next", _beside(a, label, 1)).filter(F.col("__next") != F.col(label))
        own = own.select(*[(F.col(b) * 2 + int(i == j)).alias(b) for j, b in enumerate(AXES)])
        out = own if out is None else out.union(own)
    return out


def synapse_areas(objects: DataFrame, voxel: tuple[int, int, int], erosions: tuple[int, ...] = (0, 1, 2), label: str = "object") -> DataFrame:
    """(label, area_erode0 and so on): voxels of each object times a pixel's area, after as many erosions in the plane."""
    out = None
    for k in erosions:
        left = objects.select(*AXES, F.col(label).alias("label"))
        points = left
        for _ in range(k):  # a voxel without all four neighbours of its own object goes
            for a in ("y", "x"):
                for s in (-1, 1):
                    points = points.withColumn(f"__{a}{s + 1}", F.coalesce(_beside(a, "label", s) == F.col("label"), F.lit(False)))
            points = points.filter(" and ".join(f"__{a}{s}" for a in ("y", "x") for s in (0, 2))).select(*AXES, "label")
        area = points.groupBy("label").agg((F.count(F.lit(1)) * voxel[1] * voxel[2]).alias(f"area_erode{k}"))
        out = left.select("label").distinct().join(area, "label", "left") if out is None else out.join(area, "label", "left")
    return out.fillna(0)


def skeleton_pixels(mask) -> list[tuple[int, int]]:
    """Pixels left by Zhang and Suen's thinning of a 2-d mask."""
    import numpy as np

    on = np.pad(np.asarray(mask, bool), 1)
    while True:
        before = on.copy()
        for step in (0, 1):
            n = [np.roll(on, s, (0, 1)) for s in ((1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1))]  # from above, clockwise
            count = sum(x.astype(int) for x in n)
            turns = sum((~n[i] & n[(i + 1) % 8]).astype(int) for i in range(8))
            up, right, down, left = n[0], n[2], n[4], n[6]
            ends = (~(up & right & down) & ~(right & down & left)) if step == 0 else (~(up & right & left) & ~(up & down & left))
            on = on & ~((count >= 2) & (count <= 6) & (turns == 1) & ends)
        if (on == before).all():
            return [(int(y) - 1, int(x) - 1) for y, x in np.argwhere(on)]


@lru_cache(1 << 15)
def _thinned_centre(shape: tuple[int, int], bits: bytes) -> tuple[int, int]:
    """Of a mask as packed bits: the thinned pixel nearest to the thinned pixels' mean. Small sections repeat, so they are remembered."""
    import numpy as np

    mask = np.unpackbits(np.frombuffer(bits, np.uint8), count=shape[0] * shape[1]).reshape(shape).astype(bool)
    thin = skeleton_pixels(mask) or [tuple(p) for p in np.argwhere(mask)]
    middle = np.mean(thin, axis=0)
    y, x = min(thin, key=lambda p: (round(float((p[0] - middle[0]) ** 2 + (p[1] - middle[1]) ** 2), 9), p))
    return int(y), int(x)


def slice_centres(objects: DataFrame, label: str = "object") -> DataFrame:
    """(object, z, y, x): in each section of an object the thinned pixel nearest to the thinned pixels' mean; ties by place. One object's section is held at a time."""
    from tessera.sources.volumes import dealt, groups_of, lots

    schema = "object bigint, z bigint, y bigint, x bigint"

    def run(stream):
        import numpy as np

        def made():
            for rows in groups_of(stream, ["object", "z"]):
                y, x = np.array([r.y for r in rows]), np.array([r.x for r in rows])
                low = int(y.min()), int(x.min())
                shape = int(y.max()) - low[0] + 1, int(x.max()) - low[1] + 1
                mask = np.zeros(shape, bool)
                mask[y - low[0], x - low[1]] = True
                # a large section is hardly met twice
                found = _thinned_centre if mask.size <= 4096 else _thinned_centre.__wrapped__
                at = found(shape, np.packbits(mask).tobytes())
                yield [rows[0].object, rows[0].z, low[0] + at[0], low[1] + at[1]]

        yield from lots(made(), schema)

    own = objects.select(F.col(label).cast("bigint").alias("object"), *[F.col(a).cast("bigint").alias(a) for a in AXES])
    return dealt(own, "object", "z").mapInArrow(run, schema)


def segment_volumes(v: DataFrame, found: DataFrame, column: str = "value") -> DataFrame:
    """(threshold, z, y, x, segment) of fragments (z, y, x, value) and segments (threshold, id, component); a fragment that no segment has keeps its id."""
    sets = found.select("threshold").distinct()
    own = v.select(*AXES, F.col(column).alias("id")).join(F.broadcast(sets))  # a row a threshold
    return own.join(found, ["threshold", "id"], "left").select("threshold", *AXES, F.coalesce("component", "id").alias("segment"))


def object_centres(v: DataFrame, label: str = "object") -> DataFrame:
    """(object, z, y, x): each object's voxel nearest to its mean; ties by place."""
    mean = v.groupBy(label).agg(*[F.avg(a).alias(f"m{a}") for a in AXES])
    d = reduce(lambda p, q: p + q, [(F.col(a) - F.col(f"m{a}")) * (F.col(a) - F.col(f"m{a}")) for a in AXES])
    best = v.join(mean, label).groupBy(label).agg(F.min(F.struct(F.round(d, 9).alias("d"), *AXES)).alias("b"))
    return best.select(label, *[f"b.{a}" for a in AXES])
