"""Operators that no query with SQL covers: goldens, brute force and round trips."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.geometry import Roi
from tessera.operators import chunks, components, connectome, evaluate, incremental, kernels, rag, stats, volume
from tessera.plans import steps
from tessera.sinks import tables
from tessera.sources import datasets, synapses, volumes


def connected(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        a, b = sorted((top(u), top(v)))
        root[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("small", [0, 30, 200_000])
def test_components_by_rounds_and_in_one_task(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    rng = random.Random(small)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (None, 3), (500, 499)]
    rows = {r.node: r.component for r in components.component_edges(spark.createDataFrame(edges, "u int, v int")).collect()}
    real = [(u, v) for u, v in edges if u is not None and u != v]
    assert rows == connected({n for e in real for n in e}, real)
    assert components.component_edges(spark.createDataFrame([], "u int, v int")).count() == 0


def test_cut_weight_equals_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        n = rng.randrange(3, 8)
        edges = [(u, v, rng.randrange(1, 20)) for u, v in itertools.combinations(range(n), 2) if rng.random() < 0.6]
        sources, sinks = {0}, {n - 1} if rng.random() < 0.7 else {n - 1, n - 2} - {0}
        weight = lambda side: sum(c for u, v, c in edges if (u in side) != (v in side))  # noqa: B023, E731
        free = [i for i in range(n) if i not in sources | sinks]
        best = min(weight(sources | set(extra)) for k in range(len(free) + 1) for extra in itertools.combinations(free, k))
        side = kernels.cut_sides(edges, sources, sinks)
        assert sources <= side and not side & sinks and weight(side) == best


def test_null_scores_and_pins(spark):
    e = spark.createDataFrame([(1, 2, 0.2), (2, 3, 0.6), (3, 4, 0.2), (1, 4, None)], "u bigint, v bigint, merge_score double")
    seg = spark.createDataFrame([(i, 1) for i in range(1, 5)], "id bigint, component bigint")
    seeds = spark.createDataFrame([(1, 1, 4)], "component bigint, a bigint, b bigint")
    sides = lambda pins: {r.id: r.side for r in kernels.min_cut(e, seg, seeds, pins).collect()}
    assert sides(None) == {1: 0, 2: 0, 3: 1, 4: 1}
    assert sides(spark.createDataFrame([(2, 9), (3, 9), (4, 8)], "id bigint, skeleton bigint")) == {1: 0, 2: 0, 3: 0, 4: 1}
    apart = spark.createDataFrame([(1, 4)], "a bigint, b bigint")
    found = dict(map(tuple, kernels.reagglomerate(e, seg, apart, 1.0).collect()))
    assert found[1] == found[2] and found[3] == found[4] != found[1]


def test_merge_correction_leaves_no_two_skeletons_together(spark):
    rng = random.Random(7)
    edges = [(10 * g + u, 10 * g + v, rng.randrange(1, 9) / 10) for g in range(12) for u, v in itertools.combinations(range(8), 2) if rng.random() < 0.5]
    nodes = sorted({n for u, v, _ in edges for n in (u, v)})
    top = connected(nodes, [(u, v) for u, v, _ in edges])
    pins = [(n, n % 3) for n in nodes if rng.random() < 0.5] + [(nodes[0], 77), (9999, 1)]
    seg = spark.createDataFrame(list(top.items()), "id bigint, component bigint")
    e = spark.createDataFrame([*edges, (nodes[0], nodes[1], None)], "u bigint, v bigint, merge_score double")
    found, problems = kernels.merge_correction(e, seg, spark.createDataFrame(pins, "id bigint, skeleton bigint"))
    got, held = {r.id: r.component for r in found.collect()}, defaultdict(set)
    problem = {r.id for r in problems.collect()}
    first = {}
    for i, s in pins:
        first[i] = min(s, first.get(i, s))
    touched = defaultdict(set)
    for i, s in pins:
        if i in top:
            touched[top[i]].add(s)
    assert set(got) == {n for n in nodes if len(touched[top[n]]) > 1}
    for i, s in first.items():
        if i in got:
            held[got[i]].add(s)
    assert all(len(s) == 1 for s in held.values()) and problem == {i for i in {p[0] for p in pins} if len({s for j, s in pins if j == i}) > 1}
    assert all(got[c] == c for c in set(got.values()))


def test_merge_tree_gives_the_edges_scores(spark):
    rng = random.Random(9)
    edges = sorted({(u, v): (u, v, rng.randrange(1, 99) / 100) for u, v in ((min(a, b), max(a, b)) for a, b in [rng.sample(range(20), 2) for _ in range(45)])}.values())
    made = []
    scores = kernels.agglomerated(edges, 0.6, history=made)
    when = {}
    members = defaultdict(set, {n: {n} for n in range(20)})
    for a, b, s in made:
        when |= {frozenset((x, y)): s for x in members[a] for y in members[b]}
        members[a] |= members.pop(b)
    assert all(scores[u, v] == when.get(frozenset((u, v))) for u, v, _ in edges) and made
    nodes = spark.createDataFrame([(i, 0) for i in range(20)], "id bigint, block_id bigint")
    rows = kernels.merge_history(nodes, spark.createDataFrame(edges, "u bigint, v bigint, merge_score double"), 0.6).orderBy("step").collect()
    assert [(r.a, r.b, r.score) for r in rows] == made


def test_watershed_numbers_and_context(spark):
    v = spark.createDataFrame([(z, 0, x, 100 - abs(x)) for z in range(2) for x in range(-6, 6)], "z bigint, y bigint, x bigint, value bigint")
    rows = kernels.watershed(v, (2, 1, 3), 97, context=2).collect()
    assert len(rows) == 24 and all(r.fragment for r in rows if abs(r.x) < 5)
    ids = defaultdict(set)
    for r in rows:
        ids[r.fragment].add(r.x // 3)
    assert all(len(b) == 1 for f, b in ids.items() if f)
    with pytest.raises(Exception, match="outside of the grid"):
        kernels.watershed(v.withColumn("x", F.col("x") + 1_000_000), (2, 1, 3), 97, grid=64).collect()
    with pytest.raises(ValueError):
        kernels.watershed(v, (64, 512, 512), 97, grid=1 << 16)


def dense(rows, shape, default=0):
    out = np.full(shape, default)
    for r in rows:
        out[r.z, r.y, r.x] = r.value
    return out


def test_chunk_steps_equal_one_array(spark):
    a = np.random.default_rng(2).integers(0, 255, (7, 9, 10))
    roi = Roi((0, 0, 0), a.shape)
    v = spark.createDataFrame([(*map(int, p), int(a[p])) for p in np.ndindex(a.shape)], "z bigint, y bigint, x bigint, value bigint")
    c = volumes.chunks_of(v, (3, 4, 4), roi=roi)
    back = lambda df, kind="bigint": dense(volumes.voxels_of(df, True, kind).collect(), a.shape)
    assert (back(c) == a).all() and (back(chunks.rechunked(c, (2, 5, 16))) == a).all()

    def moved(x, axis, step, fill):
        out = np.full(x.shape, fill)
        src, dst = [slice(None)] * 3, [slice(None)] * 3
        dst[axis], src[axis] = (slice(0, -1), slice(1, None)) if step > 0 else (slice(1, None), slice(0, -1))
        out[tuple(dst)] = x[tuple(src)]
        return out

    want = a
    for _ in range(2):
        for axis in (0, 2):
            want = np.minimum(want, np.minimum(moved(want, axis, 1, 999), moved(want, axis, -1, 999)))
    assert (back(chunks.eroded_min(c, "zx", 2)) == want).all()
    want = a % 3
    for _ in range(3):
        same = np.ones(a.shape, bool)
        for axis in range(3):
            for step in (1, -1):
                n = moved(want, axis, step, -1)
                same &= (n == -1) | (n == want)
        want = np.where(same, want, 0)
    assert (back(chunks.boundary_grown(chunks.each(c, lambda x: x % 3), 3)) == want).all()
    on = a > 245
    for axes in ((0, 1, 2), (1, 2)):
        before = on
        for axis in axes:
            on = on | (moved(before, axis, 1, 0) == 1) | (moved(before, axis, -1, 0) == 1)
    assert (back(chunks.dilated(chunks.each(c, lambda x: (x > 245).astype("uint8")), 1, 1)) == on).all()
    with pytest.raises(Exception, match="rechunk"):
        chunks.downsampled(c, (2, 2, 2)).collect()
    levels = chunks.pyramid_levels(c, (40, 4, 4), Roi((0, 0, 0), (280, 36, 40)), (3, 4, 4), [(2, 2, 2)], whole_chunks=True)
    assert levels[0][0] == (80, 8, 8) and levels[0][1] == Roi((0, 0, 0), (480, 64, 64))
    got = {(r.z, r.y, r.x): r.value for r in volumes.voxels_of(levels[0][2], True, "double").collect()}
    assert got == {p: a[2 * p[0] : 2 * p[0] + 2, 2 * p[1] : 2 * p[1] + 2, 2 * p[2] : 2 * p[2] + 2].mean() for p in np.ndindex(4, 5, 5)}
    empty = c.filter("false")
    assert chunks.eroded_min(empty).count() == chunks.rechunked(empty, (2, 2, 2)).count() == 0


def test_model_hook_sees_context_and_scale(spark):
    a = np.arange(4 * 4 * 6).reshape(4, 4, 6)
    v = spark.createDataFrame([(*map(int, p), int(a[p])) for p in np.ndindex(a.shape)], "z bigint, y bigint, x bigint, value bigint")
    c = volumes.chunks_of(v, (2, 4, 3))
    same = chunks.predicted(c, lambda x: (x + 1) / 2 + 1e-6, (1, 2, 2))
    assert (dense(volumes.voxels_of(same, True).collect(), a.shape) == a).all()
    half = chunks.predicted(c, lambda x: {"whole": np.ones_like(x), "none": -np.ones_like(x)}, (0, 0, 0), 2, f"{volumes.CHUNKS}, channel string")
    rows = volumes.voxels_of(half, True).collect()
    assert {(r.channel, r.value) for r in rows} == {("whole", 255), ("none", 0)} and len(rows) == 2 * a.size


def test_datasets(spark, tmp_path):
    folder, roi = f"file://{tmp_path}/store", Roi((0, 0, 0), (80, 8, 8))
    made = datasets.create(spark, folder, "volumes/raw", roi, (40, 4, 4), (1, 2, 2))
    assert made.chunks.count() == 0 and datasets.create(spark, folder, "volumes/raw", roi, (40, 4, 4), (1, 2, 2)).size == (1, 2, 2)
    with pytest.raises(ValueError):
        datasets.create(spark, folder, "volumes/raw", roi, (40, 4, 4), (2, 2, 2))
    with pytest.raises(FileNotFoundError):
        datasets.open_dataset(spark, folder, "volumes/none")
    v = spark.createDataFrame([(z, y, x, z + y + x + 1) for z in range(2) for y in range(2) for x in range(2)], "z bigint, y bigint, x bigint, value bigint")
    datasets.write(made, volumes.chunks_of(v, (1, 2, 2)))
    read = datasets.open_dataset(spark, folder, "volumes/raw")
    assert {tuple(r) for r in read.in_box(Roi((40, 0, 0), (80, 4, 8))).collect()} == {(1, 0, 0, 2), (1, 0, 1, 3)}
    assert {(tuple(r.resolution), tuple(r.offset)) for r in datasets.exported(read).collect()} == {((40, 4, 4), (0, 0, 0)), ((40, 4, 4), (40, 0, 0))}
    both = datasets.create(spark, folder, "two", roi, (40, 4, 4), (1, 2, 2), channels=2)
    parts = [volumes.chunks_of(v.withColumn("value", F.col("value") + 10 * k), (1, 2, 2)).withColumn("channel", F.lit(k)) for k in (0, 1)]
    datasets.write(both, parts[0].union(parts[1]))
    first = datasets.copy(datasets.open_dataset(spark, folder, "two"), spark, folder, "one", channel=0)
    assert sorted(r.value for r in volumes.voxels_of(first.chunks).collect()) == sorted(r.value for r in v.collect())
    assert datasets.create(spark, folder, "one", roi, (40, 4, 4), (1, 2, 2), delete=True).chunks.count() == 0


def test_images(spark, tmp_path):
    values = [(z, y, x, (0 if z == 2 else 10 * z + 4 * y + x)) for z in (1, 2, 3) for y in range(4) for x in range(4)]
    v = spark.createDataFrame(values, "z bigint, y bigint, x bigint, value bigint")
    for form in ("pgm", "tiff"):
        folder = tmp_path / form
        folder.mkdir()
        for r in tables.tile_images(v, 2, form).collect():
            (folder / f"s{r.z}_{r.row}_{r.column}.{form}").write_bytes(bytes(r.image))
        got = {tuple(r) for r in volumes.tile_voxels(spark, f"file://{folder}", rf"s(\d+)_(\d+)_(\d+)\.{form}$", (2, 2)).collect()}
        assert got == {(z, y, x, 10 + 4 * y + x if z == 2 else value) for z, y, x, value in values}  # the black section takes the one before
        bad = {tuple(r) for r in volumes.tile_voxels(spark, f"file://{folder}", rf"s(\d+)_(\d+)_(\d+)\.{form}$", (2, 2), (3,)).collect()}
        assert {r[3] for r in bad if r[0] == 3} == {r[3] for r in bad if r[0] == 1}
    wide = np.arange(6, dtype=np.uint16).reshape(2, 3) * 300
    assert (volumes.decoded(tables.tiff(wide)) == wide).all()
    with pytest.raises(ValueError):
        volumes.decoded(b"JPEG")
    side = tables.tile_images(v, 4, plane="xz").filter("z = 1 and row = 0").first()
    assert volumes.decoded(bytes(side.image))[1].tolist() == [14, 15, 16, 17]


def test_reports_and_meshes(spark, tmp_path):
    splits = spark.createDataFrame([(1, 2, "split"), (3, 4, "breaking")], "u bigint, v bigint, error_type string")
    merges = spark.createDataFrame([(5, 6)], "a bigint, b bigint")
    tables.write_error_report(splits, merges, f"file://{tmp_path}/r")
    assert {r.value for r in spark.read.text(f"file://{tmp_path}/r/txt").collect()} == {"split between 1 and 2", "breaking between 3 and 4", "merge between 5 and 6"}
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/r/csv").count() == 3
    sites = spark.createDataFrame([(1, 2, 7, 8), (3, 4, 7, 8)], "u bigint, v bigint, pre_label bigint, post_label bigint")
    met = spark.createDataFrame([(1, 2, 3, 4)], "gt_u bigint, gt_v bigint, pred_u bigint, pred_v bigint")
    kinds = sorted((r.kind, r.u, r.matches) for r in tables.match_lists(sites, sites, met).collect())
    assert kinds == [("fn", 3, None), ("fp", 1, None), ("tp", 1, '[{"pred_u":3,"pred_v":4}]')]
    tables.problem_fragments(spark.createDataFrame([(5,), (5,), (6,)], "id bigint"), f"file://{tmp_path}/p")
    assert sorted(r.value for r in spark.read.text(f"file://{tmp_path}/p").collect()) == ['{"id":"5"}', '{"id":"6"}']
    tables.write_graph(splits, merges, f"file://{tmp_path}/g")
    assert spark.read.parquet(f"file://{tmp_path}/g/edges").count() == 1
    assert {r.value for r in tables.graph_json(merges).collect()} == {'{"a":5,"b":6}'}
    cube = spark.createDataFrame([(0, 0, 0, 123), (5, 5, 5, 4), (5, 5, 6, 4)], "z bigint, y bigint, x bigint, label bigint")
    blobs = tables.mesh_blobs(volume.surface_faces(cube), least=7)
    obj = tables.mesh_obj(blobs).collect()
    assert [(r.label, r.path) for r in obj] == [(4, "4/0/0")] and obj[0].obj.count("\nf ") == 20 and obj[0].obj.count("v ") == 40
    assert "default" in {r.name for r in tables.databases(spark).collect()}
    assert tables.read_lut(spark, f"file://{tmp_path}/none", "a", "b", 0.3).count() == 0


def test_masks_have_defaults(spark):
    v = spark.createDataFrame([(0, 0, x, x + 1) for x in range(4)], "z bigint, y bigint, x bigint, value bigint")
    mask = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 0)], "z bigint, y bigint, x bigint, mask bigint")
    rows = lambda df: [r.value for r in df.orderBy("x").collect()]
    assert rows(volume.masked(v, mask)) == [1, 0, 0, 0]
    assert rows(volume.masked(v, mask, absent=1)) == [1, 0, 3, 4]
    assert rows(volume.masked(v, mask, "and", absent=5)) == [1, 0, 1, 1]
    assert rows(volume.masked(v, mask, "set", 9)) == [1, 9, 9, 9]
    assert rows(volume.cleaned(v, mask.withColumnRenamed("mask", "label"))) == [1, 2, 3, 4]
    assert rows(volume.filled(v.select("z", "y", F.col("x")).union(v.select("z", "y", F.col("x") + 10)), v, 7).filter("x >= 10")) == [7] * 4
    assert [r.mask for r in volume.constant(v, 3).collect()] == [3] * 4
    assert len(volume.pyramid(v, [(1, 1, 2), (1, 1, 2)])) == 2 and rows(volume.pyramid(v, [(1, 1, 2), (1, 1, 2)])[1]) == [2.5]


def test_thinning_and_centres(spark):
    bar = np.zeros((5, 20), bool)
    bar[1:4, 2:18] = True
    thin = volume.skeleton_pixels(bar)
    assert {y for y, _ in thin} == {2} and 10 <= len(thin) <= 16
    v = spark.createDataFrame([(3, int(y) + 40, int(x) - 7, 9) for y, x in np.argwhere(bar)] + [(4, 0, 0, 9)], "z bigint, y bigint, x bigint, object bigint")
    got = {r.z: (r.y, r.x) for r in volume.slice_centres(v).collect()}
    assert got[4] == (0, 0) and got[3][0] == 42 and abs(got[3][1] + 7 - 9.5) <= 1


def test_areas_and_plateaus(spark):
    rows = [(0, y, x, 1) for y in range(5) for x in range(5)] + [(1, 0, 0, 2)]
    v = spark.createDataFrame(rows, "z bigint, y bigint, x bigint, object bigint")
    assert {r.label: tuple(r)[1:] for r in volume.synapse_areas(v, (40, 4, 4)).collect()} == {1: (400, 144, 16), 2: (16, 0, 0)}
    flat = spark.createDataFrame([(0, 0, x, 9 if 2 <= x <= 4 else 1) for x in range(8)], "z bigint, y bigint, x bigint, value bigint")
    assert [tuple(r)[1:] for r in volume.maxima_centres(flat, (1, 1, 1), 5, (1, 8)).collect()] == [(0.0, 0.0, 3.0, 3, 9)]


def test_synapse_documents(spark):
    s = spark.createDataFrame([(1, 0.5, 1.7)], "id int, score double, z double")
    row = synapses.documents(s).first()
    assert (row.id, row.z, row.post_z, row.score, row.id_superfrag_pre, row.props) == (1, 1, None, 0.5, None, {})
    assert connectome.sorted_ids(spark.createDataFrame([("b",), ("a",), ("b",)], "neuron string")).collect()[0][0] == "a"


def test_incremental_by_output(spark, tmp_path):
    blocks = spark.createDataFrame([(i,) for i in range(5)], "block_id bigint")
    done = blocks.filter("block_id = 0")
    empty = spark.createDataFrame([(1, False), (2, True)], "block_id bigint, empty boolean")
    ids = lambda df: sorted(r.block_id for r in df.collect())
    assert ids(incremental.pending_by_output(blocks, done, empty)) == [2, 3, 4]
    assert ids(incremental.without_output(blocks, f"file://{tmp_path}/none")) == [0, 1, 2, 3, 4]
    blocks.filter("block_id < 2").withColumn("v", F.lit(1)).write.partitionBy("block_id").parquet(f"file://{tmp_path}/out")
    assert ids(incremental.without_output(blocks, f"file://{tmp_path}/out")) == [2, 3, 4]
    calls = []

    def build():
        calls.append(1)
        return blocks

    for overwrite, number in ((False, 1), (False, 1), (True, 2)):
        assert incremental.cached(spark, f"file://{tmp_path}/c", {"t": 0.5}, build, overwrite).count() == 5 and len(calls) == number
    incremental.cached(spark, f"file://{tmp_path}/c", {"t": 0.6}, build)
    assert len(calls) == 3
    queue = incremental.queue_updated(blocks.withColumnRenamed("block_id", "id"), spark.createDataFrame([(1,)], "id bigint"), spark.createDataFrame([(9,), (2,)], "id bigint"))
    assert sorted(r.id for r in queue.collect()) == [0, 2, 3, 4, 9]


def test_growth_in_small_batches(spark):
    nodes = spark.createDataFrame([(i, i // 3) for i in range(12)], "id bigint, block_id bigint")
    edges = spark.createDataFrame([(i, i + 1, 0.1 if i != 7 else 0.9) for i in range(11)] + [(0, 5, None)], "u bigint, v bigint, merge_score double")
    seeds = spark.createDataFrame([(0,), (11,)], "id bigint")
    for most in (None, 1):
        got = {r.id: r.round for r in rag.grow_loop(nodes, edges, seeds, 0.3, most=most).collect()}
        assert set(got) == set(range(12)) and got[0] == 0
    assert {r.id for r in rag.grow_loop(nodes, edges, seeds.filter("id = 0"), 0.3).collect()} == set(range(8))
    assert rag.grow_loop(nodes, edges, seeds.limit(0), 0.3).count() == 0
    pairs = spark.createDataFrame([(1, 2, 0.2), (1, 2, 0.6)], "u bigint, v bigint, aff double")
    assert [round(rag.edge_scores(pairs, n).first().merge_score, 3) for n in ("mean", "hist_quant_50", "hist_quant_90_initmax")] == [0.6, 0.8, 0.4]
    with pytest.raises(ValueError):
        rag.edge_scores(pairs, "median")


def test_breaks_of_several_steps(spark):
    labels = spark.createDataFrame(list(enumerate("XXYZXXW", 1)), "id bigint, label string")
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 7)], "u bigint, v bigint")
    found = lambda most: {tuple(r) for r in evaluate.breaking_edges(links, labels, most).collect()}
    assert found(1) == {(6, 7)} and found(2) == {(2, 3), (3, 4), (4, 5), (6, 7)}


def test_statistics(spark):
    assert stats._beta_share(0.3, 2, 3) == pytest.approx(0.3483, abs=1e-12) and stats._beta_share(0.5, 0.5, 0.5) == pytest.approx(0.5)
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 5)] + [("b", float(x)) for x in (2, 4, 6, 8, 10)], "g string, x double")
    row = stats.t_test(df, "g", "x", "a", "b").first()
    assert row.t == pytest.approx(-1.8973666) and row.df == 8 and row.p == pytest.approx(0.0943498, abs=1e-6)
    few = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 3)], "x double")
    assert [tuple(r) for r in stats.node_histogram(few, "x", 50).orderBy("bin").collect()] == [(0, 0.0, 1), (3, pytest.approx(0.9), 2), (9, pytest.approx(2.7), 1)]
    assert stats.auto_bins(few.filter("x = 1"), "x") == (1, 0.5, 1.5) and stats.node_histogram(few.limit(0), "x", 3).count() == 0
    rng = np.random.default_rng(1)
    pts, at = rng.normal(size=(200, 2)) @ [[1, 0.6], [0, 1]], rng.normal(size=(37, 2))
    h = np.cov(pts.T) * 200 ** (-1 / 3)
    d = at[:, None] - pts[None]
    want = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", d, np.linalg.inv(h), d)).sum(axis=1) / (2 * math.pi * math.sqrt(np.linalg.det(h)) * 200)
    points = spark.createDataFrame([tuple(map(float, p)) for p in pts], "x double, y double")
    places = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(at)], "i bigint, x double, y double")
    for most in (2000, 10):
        got = {r.i: r.density for r in stats.density(points, places, most=most).collect()}
        assert [got[i] for i in range(37)] == pytest.approx(want.tolist())
    assert evaluate.weighted_sum(spark.createDataFrame([(1, 2.0, 0.5), (1, 4.0, 0.25)], "k int, metric double, weight double"), ["k"]).first().metric == 2.0


def test_gaussian_descriptors(spark):
    v = spark.createDataFrame([(0, 0, x, 1) for x in range(3)], "z bigint, y bigint, x bigint, label bigint")
    row = {r.x: r for r in kernels.descriptors(v, (1, 1, 3), 2, sigma=1.0).collect()}
    w1, w2 = math.exp(-0.5), math.exp(-2)
    assert row[1].n == pytest.approx(1 + 2 * w1) and row[0].mean_x == pytest.approx((w1 + 2 * w2) / (1 + w1 + w2))


def test_names_and_configuration(spark, tmp_path):
    df = spark.createDataFrame([("a/seg_0.500",), ("b/seg.frag.300",), ("plain",), ("x/setup07/model_30000.zarr",)], "p string")
    got = [tuple(r) for r in df.select(names.threshold_of(F.col("p")), names.model_of(F.col("p"))).collect()]
    assert got == [(0.5, None), (0.3, None), (None, None), (None, "setup07_30000")]
    assert names.grid_of((400, 80, 40), (800, 100, 60), (40, 4, 4), (40, 4, 4)) == {"corner": "10 20 10", "grid_width": 60, "grid_height": 100, "grid_x_offset": 40, "grid_y_offset": 80, "z_begin": 10, "z_end": 30, "z_offset": 9}
    assert steps.formatted({"a": ["{x}/{y}", 3], "b": "{}"}, {"x": 1}) == {"a": ["1/{y}", 3], "b": "{}"}
    for n in (100, 250, 300, 400):
        (tmp_path / f"model_{n}.index").write_text("x")
    rows = steps.checkpoints(spark, f"file://{tmp_path}", r"model_(\d+)\.index$", 200, 300, spark.createDataFrame([(1,), (2,)], "k int"))
    assert sorted((r.iteration, r.k) for r in rows.collect()) == [(250, 1), (250, 2), (300, 1), (300, 2)]
    v = spark.createDataFrame([(0, 0, x, 50 * x) for x in range(4)], "z bigint, y bigint, x bigint, value bigint")
    program = [("rescale", {"scale": 1.0, "shift": 1.0}), ("chunks", {"size": [1, 1, 2]}), ("chunk_erode", {"axes": "x"}), ("voxels", {"keep_zero": True}), ("save", {"name": "t"}), ("segment", {"least": 50, "shape": [1, 4]})]
    assert {(r.x, r.object) for r in steps.run(v, program).collect()} == {(2, 2), (3, 2)}
    assert volume.near_isotropic((40, 4, 4), 64) == (1, 8, 8) and volume.near_isotropic((1, 1, 1), 8) == (2, 2, 2)


def test_density_hands_python_no_more_than_one_pair_of_parts(spark):
    points = spark.createDataFrame([(float(k % 31), float(k * k % 17)) for k in range(300)], "x double, y double")
    places = spark.createDataFrame([(k, float(k % 29), float(k % 13)) for k in range(120)], "i bigint, x double, y double")
    found = stats.density(points, places, most=40)
    whole = {r.i: r.density for r in stats.density(points, places).collect()}
    assert {r.i: round(r.density, 12) for r in found.collect()} == {i: round(d, 12) for i, d in whole.items()} and len(whole) == 120
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "MapInArrow" not in plan  # batches of packed lists grew with both tables


def test_synapses_of_one_id_are_told_apart(spark):
    from tessera.sources import synapses

    key = ["id", "u", "v"]
    rows = spark.createDataFrame([(5, 1, 2, 0.9), (5, 3, 4, 0.8), (6, 1, 7, 0.1)], "id bigint, u bigint, v bigint, score double")
    assert [r.score for r in synapses.by_ids(rows, rows.filter("u = 1").select(key), 0.5, key).collect()] == [0.9]
    assert synapses.by_ids(rows, rows.filter("u = 1")).count() == 3


def test_sites_go_to_few_cells(spark):
    """A site takes eight cells at most, and every pair within reach is met, over cell ends and below zero too."""
    from tessera.operators import sites

    at = [(k, -k - 1, (37 * k) % 101 - 50, (53 * k) % 97 - 40, (71 * k) % 89, k % 2) for k in range(120)]
    names = ["u", "v", "post_z", "post_y", "post_x", "post_label", "pre_label"]
    df = spark.createDataFrame([(*r, r[0] % 3) for r in at], names)
    points = ["post_z", "post_y", "post_x"]
    assert sites._cells(df, points, 10.0, True).groupBy("u").count().agg({"count": "max"}).first()[0] <= 8
    near = lambda a, b: sum((p - q) ** 2 for p, q in zip(a[2:5], b[2:5])) <= 100 and a[5] == b[5]
    got = {(r.gt_u, r.pred_u): (r.gt_pre_label, r.pred_pre_label) for r in sites.node_matches(df, df, 10.0, "post", "pre_label").collect()}
    assert got == {(a[0], b[0]): (a[0] % 3, b[0] % 3) for a in at for b in at if near(a, b)}


def test_near_sites_are_listed_without_an_exchange_of_pairs(spark, monkeypatch):
    from tessera.operators import sites

    monkeypatch.setattr(sites, "MOST_SITES", 3)
    monkeypatch.setattr(sites, "AT_ONCE", 50)
    rng = random.Random(2)
    at = lambda: [rng.randrange(30) for _ in range(6)]
    columns = "u bigint, v bigint, pre_label bigint, post_label bigint, pre_z bigint, pre_y bigint, pre_x bigint, post_z bigint, post_y bigint, post_x bigint"
    truth = [(k, k + 1, rng.randrange(3), rng.randrange(3), *at()) for k in range(60)] + [(900, 901, None, 1, *at()), (902, 903, 1, None, *at()), (904, 905, 7, 8, *at())]
    found = [(k, 9 - k, rng.randrange(3), rng.randrange(3), *at()) for k in range(80)] + [(990, 1, None, 1, *at())]
    t, f = spark.createDataFrame(truth, columns), spark.createDataFrame(found, columns)
    met = spark.createDataFrame([(1, 2), (5, 6)], "gt_u bigint, gt_v bigint")
    got = sites.near_far(t, f, met, 12.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "gt_u" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    want = {}
    for u, v, pre, post, *p in truth:
        if (u, v) in {(1, 2), (5, 6)}:
            continue
        others = [g for g in found if g[3] == post and post is not None]
        near = sorted([g[0], g[1]] for g in others if None not in (pre, g[2]) and g[2] != pre and sum((a - b) ** 2 for a, b in zip(p[3:], g[7:])) <= 144)
        want[u, v] = near, len(others) - sum(g[2] == pre and pre is not None for g in others)
    assert {(r.gt_u, r.gt_v): ([list(p) for p in r.near], r.far) for r in got.collect()} == want
    assert sum(len(n) for n, _ in want.values()) > 50


def test_moments_of_crowded_cells_equal_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(5e5, 700, 3000)
    y = 0.02 * x + rng.normal(0, 20, 3000)
    points = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    at = [(k, float(a), float(b)) for k, (a, b) in enumerate(zip(rng.normal(5e5, 900, 80), rng.normal(1e4, 40, 80)))] + [(80, 9e6, -3e6)]
    places = spark.createDataFrame(at, "i bigint, x double, y double")
    monkeypatch.setattr(stats, "CROWDED", 10**9)
    want = {r.i: r.density for r in stats.density(points, places).collect()}
    monkeypatch.setattr(stats, "CROWDED", 5)
    monkeypatch.setattr(stats, "PLACES", 30)
    met = []
    whole = stats._moments
    monkeypatch.setattr(stats, "_moments", lambda *a: met.append(whole(*a)) or met[-1])
    got = {r.i: r.density for r in stats.density(points, places).collect()}
    assert met[0][0].count() < 1000  # most points are summed up
    top = max(want.values())
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-13 * top for k in want)
