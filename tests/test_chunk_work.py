"""Work on chunk rows: wide halos, cells, objects, look-up tables, distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.geometry import Roi
from tessera.operators import chunk_labels, chunks, kernels, surface, volume
from tessera.sources import volumes


def chunked(spark, array, size, skip=()):
    """Chunk rows of an array; blocks of ``skip`` are left out."""
    rows = []
    for b in np.ndindex(*[-(-n // s) for n, s in zip(array.shape, size)]):
        if b not in skip:
            begin = [k * s for k, s in zip(b, size)]
            rows.append(chunks._row(b, begin, array[tuple(slice(o, o + s) for o, s in zip(begin, size))]))
    return spark.createDataFrame(rows, volumes.CHUNKS)


def whole(df, shape, fill=0):
    out = None
    for r in df.collect():
        values = np.frombuffer(r.data, r.dtype).reshape(r.nz, r.ny, r.nx)
        out = np.full(shape, fill, values.dtype) if out is None else out
        out[r.z : r.z + r.nz, r.y : r.y + r.ny, r.x : r.x + r.nx] = values
    return out


@pytest.fixture(scope="module")
def noise():
    return np.random.default_rng(1).integers(0, 200, (5, 11, 14)).astype(np.uint8)


@pytest.mark.parametrize("size", [(4, 4, 4), (1, 3, 2), (5, 11, 14), (2, 5, 6)])
def test_halos_wider_than_chunks(spark, noise, size):
    """Steps with halos of several chunks, and of small chunks at the end, equal one step over the whole array."""
    def least(a, axis, n):
        pad = np.pad(a, [(n, n) if i == axis else (0, 0) for i in range(3)], constant_values=255)
        return np.min([np.take(pad, range(k, k + a.shape[axis]), axis) for k in range(2 * n + 1)], axis=0)

    blocks = chunked(spark, noise, size)
    assert (whole(chunks.eroded_min(blocks, "x", 12), noise.shape) == least(noise, 2, 12)).all()
    assert (whole(chunks.eroded_min(blocks, "zy", 5, size=size), noise.shape) == least(least(noise, 0, 5), 1, 5)).all()
    mask = (noise > 190).astype(np.uint8)
    near = mask.astype(bool)
    for _ in range(7):
        grown = near.copy()
        for axis in range(3):
            for a, b in (((slice(1, None)), slice(None, -1)), (slice(None, -1), slice(1, None))):
                to, of = (tuple(s if i == axis else slice(None) for i in range(3)) for s in (a, b))
                grown[to] |= near[of]
        near = grown
    assert (whole(chunks.dilated(chunked(spark, mask, size), 7), noise.shape) == near).all()


def test_halo_over_missing_blocks(spark, noise):
    """What no chunk holds is absent, also where a halo reaches over it."""
    blocks = chunked(spark, noise, (5, 11, 2), skip={(0, 0, 2)})
    held = noise.astype(int)
    held[:, :, 4:6] = 999
    want = held.copy()
    for x in range(14):
        want[:, :, x] = held[:, :, max(0, x - 1) : x + 2].min(axis=2)
    got = whole(chunks.eroded_min(blocks, "x", 1), noise.shape)
    at = np.r_[0:4, 6:14]
    assert (got[:, :, at] == want[:, :, at]).all()


@pytest.mark.parametrize("size", [(2, 4, 4), (5, 5, 3), (5, 11, 14)])
def test_coarse_predictions_do_not_depend_on_context(spark, noise, size):
    """A model that returns what it sees: cells lie on the grid, and context and block size change nothing."""
    for k in (1, 2, 3):
        got = [whole(chunks.predicted(chunked(spark, noise, size), lambda a: (a + 1) / 2, c, xy_downsample=k), noise.shape) for c in ((0, 0, 0), (0, 1, 1), (1, 3, 2))]
        want = np.zeros(noise.shape)
        for y in range(0, 11, k):
            for x in range(0, 14, k):
                cell = noise[:, y : y + k, x : x + k].astype(np.float64)
                want[:, y : y + k, x : x + k] = cell.mean(axis=(1, 2))[:, None, None]
        assert all((g == got[0]).all() for g in got) and np.abs(got[0] - want).max() <= 1


def objects(values, same):
    """Least linear index (from 1) of each face-connected object, by flooding."""
    out, shape = np.zeros(values.shape, np.int64), values.shape
    for start in np.ndindex(*shape):
        if values[start] and not out[start]:
            name, stack = np.ravel_multi_index(start, shape) + 1, [start]
            out[start] = name
            while stack:
                p = stack.pop()
                for d in kernels.FACES:
                    q = tuple(a + b for a, b in zip(p, d))
                    if all(0 <= c < n for c, n in zip(q, shape)) and values[q] and not out[q] and (not same or values[q] == values[p]):
                        out[q] = name
                        stack.append(q)
    return out


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("size", [(4, 4, 4), (1, 2, 3), (9, 13, 17)])
def test_objects_across_chunks(spark, size, same):
    values = (np.random.default_rng(2).random((9, 13, 17)) < 0.45) * np.random.default_rng(3).integers(1, 3, (9, 13, 17))
    got = chunk_labels.labelled(chunked(spark, values.astype(np.uint16), size), (13, 17), same)
    assert (whole(got, values.shape) == objects(values, same)).all()


def test_objects_of_long_snakes_and_missing_blocks(spark):
    values = np.zeros((1, 20, 21), np.uint8)
    values[0, ::2] = 1
    values[0, 1::4, -1] = values[0, 3::4, 0] = 1
    assert set(np.unique(whole(chunk_labels.labelled(chunked(spark, values, (1, 3, 4)), (20, 21)), values.shape))) == {0, 1}
    line = np.ones((1, 1, 12), np.uint8)
    cut = chunk_labels.labelled(chunked(spark, line, (1, 1, 3), skip={(0, 0, 1)}), (1, 12))
    assert whole(cut, (1, 1, 12)).tolist() == [[[1] * 3 + [0] * 3 + [7] * 6]]
    assert chunk_labels.labelled(chunked(spark, line, (1, 1, 3)).limit(0), (1, 12)).count() == 0


def test_relabelled_chunks_equal_voxel_rows(spark, monkeypatch):
    from tessera.operators import relabel, skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)  # label 1 is in all chunks
    values = np.random.default_rng(4).integers(0, 40, (6, 10, 10)).astype(np.int64)
    values[:, ::3] = 1
    blocks = chunked(spark, values, (2, 3, 4))
    lut = spark.createDataFrame([(k, 1000 + k // 2) for k in range(1, 40, 2)] + [(99, 5)], "src bigint, dst bigint")
    want = np.vectorize({k: 1000 + k // 2 for k in range(1, 40, 2)}.get, otypes=[object])(values)
    want = np.where(want == None, values, want).astype(np.int64)  # noqa: E711
    assert (whole(chunk_labels.relabelled(blocks, lut), values.shape) == want).all()
    rows = volumes.voxels_of(blocks, True)
    by_row = relabel.relabel(rows, lut).groupBy("value").count()
    sizes = {r.label: r.n for r in chunk_labels.volumes(chunk_labels.relabelled(blocks, lut)).collect()}
    assert sizes == {r.value: r["count"] for r in by_row.collect() if r.value}
    props = {r.label: tuple(r)[1:] for r in chunk_labels.boxes(blocks).collect()}
    for label in (1, 7):
        at = np.nonzero(values == label)
        assert props[label] == (len(at[0]), *[int(f) for a in at for f in (a.min(), a.max() + 1)])
    plan = chunk_labels.relabelled(blocks, lut)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def test_distances_on_chunks(spark):
    values = np.random.default_rng(5).integers(0, 3, (4, 7, 9))
    values[:, 2:6, 2:7] = 9
    for size in ((2, 3, 4), (4, 7, 9), (1, 7, 2)):
        got = whole(chunks.distances(chunked(spark, values, size), (40, 4, 4)), values.shape)
        at = np.stack(np.nonzero(np.ones(values.shape)), axis=1)
        far = (((at[:, None] - at[None]) * [40, 4, 4]) ** 2).sum(axis=2).astype(float)
        far[values.ravel()[:, None] == values.ravel()[None]] = np.inf
        assert np.allclose(got.ravel(), np.sqrt(far.min(axis=1)))
    alone = whole(chunks.distances(chunked(spark, np.ones((2, 2, 2), np.int64), (1, 2, 2)), (1, 1, 1)), (2, 2, 2))
    assert np.isnan(alone).all()


def flood(values, present, least):
    """One voxel at a time, from its definition."""
    import heapq

    shape, labels = values.shape, objects((present & (values >= least)).astype(int), False)
    labels = np.where(labels > 0, np.searchsorted(np.unique(labels[labels > 0]), labels) + 1, 0)
    heap = [(-values[p], p) for p in zip(*np.nonzero(labels))]
    heapq.heapify(heap)
    while heap:
        _, p = heapq.heappop(heap)
        for d in kernels.FACES:
            q = tuple(a + b for a, b in zip(p, d))
            if all(0 <= c < n for c, n in zip(q, shape)) and present[q] and not labels[q]:
                labels[q] = labels[p]
                heapq.heappush(heap, (-values[q], q))
    return labels


def test_watershed_equals_its_definition(spark):
    random = np.random.default_rng(6)
    for most in (4, 40, 250):
        values = random.integers(0, most, (6, 9, 10)).astype(np.uint8)
        present = random.random(values.shape) < 0.9
        got = kernels.seeded_watershed(values, present, 0.75 * most)
        assert (got == flood(values.astype(int), present, 0.75 * most)).all() and got.max() > 3
    values = random.integers(0, 60, (5, 9, 11)).astype(np.uint8)
    for size, context in (((2, 4, 4), 0), ((2, 4, 4), 1), ((5, 3, 11), 3)):
        rows = spark.createDataFrame([(*map(int, p), int(values[p])) for p in np.ndindex(*values.shape)], "z bigint, y bigint, x bigint, value bigint")
        want = {(r.z, r.y, r.x): r.fragment for r in kernels.watershed(rows, size, 50, context=context).collect()}
        got = whole(kernels.watershed_chunks(chunked(spark, values, size), size, 50, context=context), values.shape)
        assert {p: int(got[p]) for p in np.ndindex(*values.shape)} == want


def test_surfaces_are_closed_and_hold_their_voxels(spark):
    random = np.random.default_rng(8)
    grid = np.stack(np.meshgrid(*[np.arange(14)] * 3, indexing="ij"), axis=-1)
    values = np.zeros((14, 14, 14), np.int64)
    values[((grid - 6) ** 2).sum(axis=-1) <= 25] = 5
    values[11:, 11:, :] = random.integers(0, 4, (3, 3, 14))
    values[0, 0, 0] = 9  # at the volume's corner
    meshes = [surface.triangles(chunked(spark, values, size), size) for size in ((14, 14, 14), (5, 4, 3))]
    rows = [sorted((r.label, *min([(r.a, r.b, r.c), (r.b, r.c, r.a), (r.c, r.a, r.b)])) for r in m.collect()) for m in meshes]
    assert rows[0] == rows[1] and len(rows[0]) == len(set(rows[0])) > 1000  # cutting in chunks changes nothing
    mesh = meshes[1]
    assert surface.open_edges(mesh).count() == 0
    found = {r.label: r for r in surface.measures(mesh, (1.0, 1.0, 1.0)).collect()}
    for label, r in found.items():
        on = np.pad(values == label, 1)
        faces = sum(int((np.diff(on.astype(int), axis=a) != 0).sum()) for a in range(3))
        assert 0 < r.volume <= on.sum() and on.sum() - r.volume <= faces / 2
    ball = (values == 5).sum()
    assert abs(found[5].volume - ball) < 0.2 * ball
    world = {r.label: r.volume for r in surface.measures(mesh, (40.0, 4.0, 4.0)).collect()}
    assert all(world[k] == pytest.approx(640 * r.volume) for k, r in found.items())
    points = surface.vertices(mesh, (1.0, 1.0, 1.0)).filter("label = 5")
    assert points.count() == found[5].triangles // 2 + 2  # Euler: one sphere
    corner = surface.vertices(mesh, (2.0, 1.0, 1.0)).filter("label = 9").agg(F.min("z"), F.max("z"), F.min("x")).first()
    assert tuple(corner) == (-1.0, 1.0, -0.5)
    assert surface.triangles(chunked(spark, values, (5, 4, 3)).limit(0), (5, 4, 3)).count() == 0


def test_near_isotropic_chunks():
    """The product is the least power of two that reaches the number asked for, and lengths differ by a factor of two at most where they can."""
    for voxel in ((40, 4, 4), (1, 1, 1), (50, 2, 2), (16, 8, 4), (30, 6, 6), (7, 3)):
        for most in (1, 2, 8, 64, 100, 4096, 1 << 20):
            dims = volume.near_isotropic(voxel, most)
            assert np.prod(dims) >= most and (np.prod(dims) == 1 or np.prod(dims) // 2 < most) and all(d & (d - 1) == 0 for d in dims)
            lengths = [d * s for d, s in zip(dims, voxel)]
            grown = [n for n, d in zip(lengths, dims) if d > 1]
            assert not grown or max(grown) <= 2 * min(lengths)
    assert volume.near_isotropic((40, 4, 4), 64) == (1, 8, 8)


def test_chunks_of_scattered_voxels_in_a_call_a_task(spark, noise):
    """Voxels in any order, parts of chunks of many batches; neither a chunk nor a block with its halo is a call of its own."""
    size = (2, 3, 4)
    places = [(z, y, x) for z, y, x in np.ndindex(noise.shape) if noise[z, y, x] > 20]
    np.random.default_rng(2).shuffle(places)
    v = spark.createDataFrame([(int(z), int(y), int(x), int(noise[z, y, x])) for z, y, x in places], "z long, y long, x long, value long").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        made = volumes.chunks_of(v, size, roi=Roi((0, 0, 0), noise.shape))
        assert (whole(made, noise.shape) == np.where(noise > 20, noise, 0)).all()
        least = chunks.eroded_min(made, size=size)
        back = volumes.voxels_of(made, True).collect()
        assert len(back) == noise.size and all(r.value == (noise[r.z, r.y, r.x] if noise[r.z, r.y, r.x] > 20 else 0) for r in back)
        with pytest.raises(Exception, match="outside the box"):
            volumes.chunks_of(v, size, roi=Roi((0, 0, 0), (5, 11, 13))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for df in (made, least):
        plan = df._jdf.queryExecution().toString()
        assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_python_holds_few_rows_of_a_large_batch():
    rows = ([*[0] * 6, 1, 1, 1 << 16, "uint8", bytes(1 << 16)] for _ in range(1000))
    sizes = [b.num_rows for b in volumes.lots(rows, volumes.CHUNKS)]
    assert sum(sizes) == 1000 and max(sizes) <= 64
