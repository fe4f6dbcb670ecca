import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.geometry import Roi
from tessera.operators import connectome, evaluate, incremental, kernels, sites, skeleton, stats, volume
from tessera.plans import steps
from tessera.sinks import tables
from tessera.sources import skeletons, volumes
from tessera.streaming import progress


def voxels(spark, array, column="value"):
    rows = [(int(z), int(y), int(x), int(array[z, y, x])) for z, y, x in np.ndindex(array.shape)]
    return spark.createDataFrame(rows, f"z bigint, y bigint, x bigint, {column} bigint")


def dense(rows, shape, column="value"):
    out = np.zeros(shape, float)
    for r in rows.collect():
        out[r.z, r.y, r.x] = r[column]
    return out


def test_skeleton_tree_errors_and_pruning(spark):
    rows = [(1, 7, None, 0, 5), (2, 7, 1, 0, 5), (3, 7, 2, 0, 5), (4, 7, 2, 0, 6), (5, 7, 3, 0, 9), (6, 7, 5, 0, 5)]
    t = spark.createDataFrame(rows, "treenode_id bigint, skeleton_id bigint, parent_id bigint, z bigint, label bigint")
    e, labels = skeleton.edges(t), t.withColumnRenamed("treenode_id", "id")
    errors = evaluate.split_errors(e, labels)
    kinds = {(r.u, r.v): r.error_type for r in evaluate.classified(errors, evaluate.breaking_nodes(e, labels)).collect()}
    assert kinds == {(4, 2): "split", (5, 3): "breaking", (6, 5): "breaking"}
    n = t.select(F.col("treenode_id").alias("id"))
    assert sorted(r.id for r in skeleton.pruned(n, e, 1).collect()) == [2, 3, 5]
    assert sorted(r.id for r in skeleton.pruned(n, e, 2).collect()) == [3]
    assert skeleton.components(t).select("component").distinct().count() == 1


def test_interpolation_truncates(spark):
    t = spark.createDataFrame([(1, None, 0, 0, 0), (2, 1, 120, 10, -10)], "treenode_id bigint, parent_id bigint, z bigint, y bigint, x bigint")
    assert sorted(map(tuple, skeleton.interpolated(t, 40).collect())) == [(2, 1, 40, 3, -3), (2, 2, 80, 6, -6)]


def test_long_edges_are_interpolated_to_their_end(spark, monkeypatch):
    from tessera.plans import skeletons

    t = spark.createDataFrame([(1, None, 0, 0, 0), (2, 1, 400 * 56, 56, 0)], "treenode_id bigint, parent_id bigint, z bigint, y bigint, x bigint")
    monkeypatch.setattr(skeletons.Views, "treenodes", lambda self: t)
    got = sorted(map(tuple, skeletons.QUERIES["skeleton_interpolated"](spark, "").collect()))
    assert got == [(2, k, 400 * k, k, 0) for k in range(1, 56)]


def test_voi_and_rand(spark):
    same = spark.createDataFrame([(1, 1)] * 4 + [(2, 2)] * 4, "label bigint, skeleton_id bigint")
    half = spark.createDataFrame([(1, 1)] * 4 + [(2, 1)] * 4, "label bigint, skeleton_id bigint")
    get = lambda f, df: tuple(round(x, 9) for x in f(evaluate.contingency(df)).first())
    assert get(evaluate.voi, same) == (0, 0) and get(evaluate.rand, same) == (0, 0)
    assert get(evaluate.voi, half) == (1, 0) and get(evaluate.rand, half) == (0.5, 0)


def test_merges_and_corrections(spark):
    rows = [(1, 10, 5, 0, 0, 0), (2, 10, 5, 0, 0, 9), (3, 20, 5, 0, 0, 10), (4, 30, 5, 0, 0, 30), (5, 30, 6, 0, 0, 31)]
    n = spark.createDataFrame(rows, "id bigint, skeleton_id bigint, label bigint, z bigint, y bigint, x bigint")
    best = evaluate.merge_sites(n)
    assert sorted((r.skeleton_a, r.skeleton_b, r.a, r.b, r.d) for r in best.collect()) == [(10, 20, 2, 3, 1), (10, 30, 2, 4, 441), (20, 30, 3, 4, 400)]
    assert sorted((r.skeleton_a, r.skeleton_b) for r in evaluate.minimal_sites(best).collect()) == [(10, 20), (20, 30)]
    assert [tuple(r) for r in evaluate.split_correction(n).collect()] == [(6, 5)]


def test_connectome_pieces(spark):
    s = spark.createDataFrame([(1, 10, 20, 0, 0, 0, 0.9, 5), (2, 10, 20, 0, 0, 3, 0.8, 6), (3, 10, 20, 0, 0, 100, 0.7, 7), (4, 10, 20, 0, 0, 0, 0.95, 8)], "id bigint, pre bigint, post bigint, post_z bigint, post_y bigint, post_x bigint, score double, n bigint")
    mean = {r.cluster: (r.n, r.post_x) for r in connectome.clustered(s.drop("n"), 5.0).collect()}
    assert mean == {1: (3, 1.0), 3: (1, 100.0)}  # 1 and 4 coincide: linked through 2 only
    best = {r.cluster: (r.score, r.post_x) for r in connectome.clustered(s.drop("n"), 5.0, "max_score").collect()}
    assert best == {1: (0.95, 0.0), 3: (0.7, 100.0)}
    apart = connectome.clustered(s.filter("id in (1, 4)").drop("n"), 5.0)
    assert apart.count() == 2 and connectome.clustered(s.filter("id in (1, 4)").drop("n"), 5.0, with_equal_points=True).count() == 1
    n = spark.createDataFrame([("n_1", [5, 6]), ("n_2", [6])], "neuron string, segments array<bigint>")
    assert sorted(map(tuple, connectome.segment_map(n).collect())) == [(5, "n_1"), (6, "n_2")]


def test_clusters_of_dense_synapses(spark, monkeypatch):
    """Equal to all pairs compared, with shared ids and coincident points; links grow with the cells, not with the pairs of points."""
    rng = np.random.default_rng(5)
    rows = []
    for pre, n, side in ((1, 60, 60), (2, 25, 40), (3, 400, 6), (4, 40, 25)):
        spots = rng.integers(-side, side, (n, 3))
        spots[n // 2 :: 7] = spots[: len(spots[n // 2 :: 7])]
        rows += [(int(i), pre, 9, *map(int, p), float(k % 5)) for i, k, p in zip(rng.integers(0, 4000, n), range(n), spots)]
    rows += [(5001, 5, 9, 0, 0, 0, 1.0), (5002, 5, 9, 0, 0, 0, 1.0), (5001, 6, 9, 0, 0, 0, 1.0), (5003, 6, 9, 0, 0, 10, 1.0), (5004, 7, 9, 0, 0, 0, 1.0), (5005, 7, 9, 0, 0, 11, 1.0)]
    root = {r[0]: r[0] for r in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in rows:
        for b in rows:
            if a[1] == b[1] and 0 < sum((p - q) ** 2 for p, q in zip(a[3:6], b[3:6])) <= 100:
                low, high = sorted((top(a[0]), top(b[0])))
                root[high] = low
    want = {}
    for r in rows:
        want.setdefault((top(r[0]), r[1], r[2]), []).append(r[5])
    given, found = [], connectome.component_edges

    def counted(links, *more):
        links = links.localCheckpoint()
        given.append(links.count())
        return found(links, *more)

    monkeypatch.setattr(connectome, "component_edges", counted)
    s = spark.createDataFrame(rows, "id bigint, pre bigint, post bigint, post_z bigint, post_y bigint, post_x bigint, score double")
    got = {(r.cluster, r.pre, r.post): (r.n, round(r.post_x, 9)) for r in connectome.clustered(s, 10.0).collect()}
    assert got == {k: (len(v), round(sum(v) / len(v), 9)) for k, v in want.items()}
    assert sum(given) < 4 * len(rows)  # of 400 points in a few cells, all pairs were links before


def test_mirrored_site_matching(spark):
    row = "u bigint, v bigint, pre_label bigint, post_label bigint, pre_z bigint, pre_y bigint, pre_x bigint, post_z bigint, post_y bigint, post_x bigint"
    truth = spark.createDataFrame([(1, 2, 1, 2, 0, 0, 0, 0, 0, 9), (3, 4, 1, 2, 0, 0, 500, 0, 0, 509)], row)
    found = spark.createDataFrame([(7, 8, 1, 2, 0, 0, 3, 0, 0, 9), (9, 9, 2, 1, 0, 0, 0, 0, 0, 9)], row)
    met = sites.matches(truth, found, 5.0)
    assert [(r.gt_u, r.pred_u) for r in met.collect()] == [(1, 7)]
    assert tuple(sites.errors(truth, found, met).first()) == (1, 1, 1, 1)
    report = {(r.pre_label, r.post_label): (r.n_gt, r.n_tp, r.n_fn, r.n_fp) for r in tables.match_report(truth, found, met).collect()}
    assert report == {(1, 2): (2, 1, 1, 0), (2, 1): (0, 0, 0, 1)}


def test_downsampling_and_boundary_golden(spark):
    a = np.array([[[1, 1, 2, 2], [1, 1, 2, 2], [1, 1, 2, 2], [3, 3, 3, 3]]])
    v = voxels(spark, a)
    assert dense(volume.downsampled_mean(v, (1, 2, 2)), (1, 2, 2)).tolist() == [[[1, 2], [2, 2.5]]]
    assert dense(volume.downsampled_labels(v, (1, 2, 2)), (1, 2, 2)).tolist() == [[[1, 2], [3, 3]]]
    grown = dense(volume.boundary_grown(v.withColumnRenamed("value", "label")), (1, 4, 4), "label")
    assert grown[0].tolist() == [[1, 0, 0, 2], [1, 0, 0, 2], [0, 0, 0, 0], [0, 0, 0, 0]]
    assert volume.next_factor((40, 4, 4)) == (1, 2, 2) and volume.next_factor((40, 32, 32)) == (2, 2, 2)


def test_labels_of_a_spiral(spark):
    a = np.random.default_rng(3).random((5, 6, 7)) < 0.45
    got = dense(volume.labelled(voxels(spark, a.astype(int)).filter("value = 1"), (6, 7)), a.shape, "object")
    want, seen = np.zeros(a.shape), np.zeros(a.shape, bool)
    for p in np.ndindex(a.shape):
        if a[p] and not seen[p]:
            stack, seen[p] = [p], True
            while stack:
                q = stack.pop()
                want[q] = (p[0] * 6 + p[1]) * 7 + p[2]
                for d in kernels.FACES:
                    r = tuple(i + j for i, j in zip(q, d))
                    if all(0 <= c < s for c, s in zip(r, a.shape)) and a[r] and not seen[r]:
                        seen[r] = True
                        stack.append(r)
    assert (got == want).all()


def test_targets_round_half_to_even(spark):
    p = spark.createDataFrame([(0, 0, 0, 0.0, 0.0, 6.0), (0, 0, 0, 0.0, 0.0, 2.0)], "z bigint, y bigint, x bigint, dz double, dy double, dx double")
    assert sorted(r.tx for r in volume.targets(p, 1.0, (40, 4, 4), 0).collect()) == [0, 8]


def test_kernels_do_not_depend_on_blocks(spark):
    a = np.random.default_rng(2).integers(0, 3, (6, 6, 6))
    v = voxels(spark, a)
    smooth = [dense(kernels.gaussian(v, b, (0.5, 0.5, 0.5)), a.shape) for b in ((6, 6, 6), (2, 3, 4))]
    assert np.allclose(*smooth)
    labels = v.withColumnRenamed("value", "label")
    far = [dense(kernels.edt(labels, b, (40, 4, 4), 1).na.fill(-1), a.shape, "distance") for b in ((6, 6, 6), (4, 2, 3))]
    assert (far[0] == far[1]).all() and far[0].max() <= 40.5
    shape = [dense(kernels.descriptors(labels, b, 2), a.shape, "r_zy") for b in ((6, 6, 6), (3, 5, 2))]
    assert np.allclose(*shape)
    flat = np.array([[[9, 5, 1, 4, 9]]])
    marks = kernels.seeded_watershed(flat.astype(float), np.ones_like(flat, bool), 9)
    assert marks.ravel().tolist() == [1, 1, 1, 2, 2]
    ids = {r.fragment for r in kernels.watershed(v, (3, 3, 3), 2).collect()}
    assert len(ids - {0}) >= 8


@pytest.mark.parametrize("group", [250_000, 30])
def test_distances_are_exact(spark, monkeypatch, group):
    monkeypatch.setattr(kernels, "GROUP", group)
    a = np.ones((5, 11, 12), int)
    a[1:, 3:, 5:], a[2, 2, 11], a[4, 10, 0] = 2, 3, 1
    rng = np.random.default_rng(4)
    keep = rng.random(a.shape) < 0.7
    keep[:, 6] = keep[3, :, 4:] = False  # whole lines are missing
    for mask in (np.ones(a.shape, bool), keep):
        at, voxel = np.argwhere(mask), np.array([40, 4, 4])
        labels = a[mask]
        apart = np.sqrt((((at[:, None] - at[None]) * voxel) ** 2).sum(-1))
        want = np.where(labels[:, None] != labels[None], apart, np.inf).min(1)
        assert want.max() > 20  # beyond five voxels
        rows = spark.createDataFrame([(*map(int, p), int(k)) for p, k in zip(at, labels)], "z bigint, y bigint, x bigint, label bigint")
        for block in ((50, 8, 8), (2, 3, 5)):
            got = {(r.z, r.y, r.x): r.distance for r in kernels.edt(rows, block, (40, 4, 4)).collect()}
            assert len(got) == len(at) and np.allclose([got[tuple(map(int, p))] for p in at], want)
    one = rows.withColumn("label", F.lit(0))
    assert {r.distance for r in kernels.edt(one, (50, 8, 8), (40, 4, 4)).collect()} == {None}
    assert kernels.edt(one.limit(0), (50, 8, 8), (40, 4, 4)).count() == 0


def test_section_steps_and_program(spark):
    a = np.arange(12).reshape(3, 2, 2)
    v = voxels(spark, a)
    got = dense(volume.sections_replaced(v, {1: 2, 0: 9}, [2]), a.shape)
    assert got[0].tolist() == a[0].tolist() and got[1].tolist() == a[2].tolist() and got[2].sum() == 0
    out = steps.run(v, [("threshold", {"least": 4}), ("pool", {"k": 2, "how": "max"})])
    assert sorted((r.z, r.value) for r in out.collect()) == [(0, 0), (1, 7), (2, 11)]
    assert sorted((r.z, r.value) for r in steps.run(v, [("erode", {"axes": "z"})]).filter("y = 0 and x = 0").collect()) == [(0, 0), (1, 0), (2, 4)]


def test_config():
    text = '{"a": {"b": 1, // one\n "url": "http://x#y"}, # two\n "c": [1]}'
    assert steps.load_config(text) == {"a": {"b": 1, "url": "http://x#y"}, "c": [1]}
    assert steps.merged({"a": {"b": 1, "d": 2}}, {"a": {"b": 3}}, steps.overrides(["a.e=[1]", "a.f=x=y"])) == {"a": {"b": 3, "d": 2, "e": [1], "f": "x=y"}}
    assert steps.config_hash({"a": 1, "b": 2}) == steps.config_hash({"b": 2, "a": 1})


def test_incremental(spark, tmp_path):
    blocks = spark.createDataFrame([(i, i, 0, 0) for i in range(6)], "block_id bigint, z bigint, y bigint, x bigint")
    done = spark.createDataFrame([(0, 5), (1, 5), (2, 5)], "block_id bigint, duration_ms bigint")
    incremental.log_completion(done, f"file://{tmp_path}/log", "t")
    log = spark.read.parquet(f"file://{tmp_path}/log").filter("task = 't'")
    assert sorted(r.block_id for r in incremental.pending(blocks, log).collect()) == [3, 4, 5]
    assert sorted(r.block_id for r in incremental.forced(blocks, log, Roi((1, 0, 0), (2, 1, 1))).collect()) == [1, 3, 4, 5]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), spark.createDataFrame([(2, "c")], "id int, v string")
    assert sorted(map(tuple, incremental.upsert(old, new).collect())) == [(1, "a"), (2, "c")]
    assert incremental.update_only(old, new).count() == 2
    with pytest.raises(ValueError):
        incremental.insert_only(old, new)
    with pytest.raises(ValueError):
        incremental.update_only(new, old)


def test_skeleton_sources(spark, tmp_path):
    doc = {"skeletons": {"7": {"treenodes": {"1": {"location": [3.0, 2.0, 1.0], "parent_id": None}, "2": {"location": [6, 5, 4], "parent_id": 1}}, "connectors": {"9": {"location": [1, 1, 1], "presynaptic_to": [1, 2], "postsynaptic_to": [5]}}}, "8": {"treenodes": {"3": {"location": [0, 0, 0], "parent_id": None}}, "connectors": {}}}}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    assert sorted(map(str, map(tuple, skeletons.treenodes_json(spark, f"file://{tmp_path}/s.json").collect()))) == ["(1, 7, None, 1, 2, 3)", "(2, 7, 1, 4, 5, 6)"]
    c = skeletons.connectors_json(spark, f"file://{tmp_path}/s.json")
    assert sorted(map(tuple, skeletons.site_edges(c).collect())) == [(9, 1, 5), (9, 2, 5)]
    (tmp_path / "s.csv").write_text("a,b,c,d,e,f,g\n7, 1, , 3, 2, 1, 0\n7, 2, 1, 6, 5, 4, 0\n")
    assert [(r.treenode_id, r.parent_id, r.x) for r in skeletons.treenodes_csv(spark, f"file://{tmp_path}/s.csv").orderBy("treenode_id").collect()] == [(1, None, 3.0), (2, 1, 6.0)]


def test_chunks_and_tiles(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 4, (3, 5, 4))
    c = volumes.chunks_of(voxels(spark, a).filter("value > 0"), (2, 2, 2))
    assert (dense(volumes.voxels_of(c), a.shape) == a).all()
    roi = Roi((1, 1, 1), (3, 4, 3))
    assert sum(r.value for r in volumes.read_roi(c, roi, (2, 2, 2)).collect()) == a[1:3, 1:4, 1:3].sum()
    moved = volumes.translated(volumes.voxels_of(c), (1, 0, 0), Roi((0, 0, 0), (2, 5, 4)))
    assert (dense(moved, (2, 5, 4)) == a[1:3]).all()
    for name in ("s3_r1_c2.png", "s4_r0_c0.png", "other.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = volumes.tiles(spark, f"file://{tmp_path}", r"s(\d+)_r(\d+)_c(\d+)\.png", (10, 20)).collect()
    assert sorted((r.z, r.y, r.x) for r in found) == [(3, 10, 40), (4, 0, 0)]
    usable = spark.createDataFrame([(0, True), (1, False), (3, True)], "z bigint, usable boolean")
    assert sorted(map(tuple, volumes.sections_carried(usable, 0, 4).collect())) == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3)]


def test_sinks(spark, tmp_path):
    lut = spark.createDataFrame([(0, 1, 5), (1, 2, 5)], "block_id bigint, src bigint, dst bigint")
    path = f"file://{tmp_path}/lut"
    tables.write_lut(lut, path, "frags2local", "mean", 0.29)
    tables.write_lut(lut.filter("block_id = 1").withColumn("dst", F.lit(9)), path, "frags2local", "mean", 0.29)
    got = tables.read_lut(spark, path, "frags2local", "mean", 0.29)
    assert sorted((r.block_id, r.src, r.dst) for r in got.collect()) == [(0, 1, 5), (1, 2, 9)]
    assert tables.read_lut(spark, path, "frags2local", "mean", 0.29, [1]).count() == 1
    s = spark.createDataFrame([(50, 1, 2, 3, 4, 5, 6), (40, 7, 8, 9, 10, 11, 12)], "id bigint, pre_z bigint, pre_y bigint, pre_x bigint, post_z bigint, post_y bigint, post_x bigint")
    rows = sorted(map(tuple, tables.exchange_rows(s).collect()))
    assert rows[0] == (0, 1, "presynaptic_site", 7, 8, 9) and rows[3] == (3, 2, "postsynaptic_site", 4, 5, 6)
    tables.write_edges_csv(spark.createDataFrame([(1, [1, 2])], "pre int, at array<int>"), f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").first().at == "[1,2]"
    faces = volume.surface_faces(voxels(spark, np.array([[[1, 1]]]), "label"))
    blob = tables.mesh_blobs(faces).first()
    assert blob.n_faces == 10 and len(blob.vertices) == 10 * 4 * 3 * 4 and len(blob.triangles) == 10 * 2 * 3 * 4
    image = tables.tile_images(voxels(spark, np.array([[[1, 2], [3, 4]]])), 2).first().image
    assert image.endswith(bytes([1, 2, 3, 4]))
    tables.write_block(voxels(spark, np.ones((2, 4, 4), int)), f"file://{tmp_path}/blocks", Roi((0, 0, 0), (2, 2, 4)), (2, 2, 2))
    assert spark.read.parquet(f"file://{tmp_path}/blocks").count() == 16
    with pytest.raises(ValueError):
        tables.drop_database(spark, "default")


def test_statistics(spark):
    v = spark.createDataFrame([(float(i % 10), "a" if i % 2 else "b") for i in range(100)], "x double, g string")
    hist = stats.cumulative(stats.histogram(v, "x", 5, 0, 9)).orderBy("bin").collect()
    assert [r.n for r in hist] == [20] * 5 and hist[-1].total == 100
    t = stats.t_statistic(v, "g", "x", "a", "b").first()
    a, b = np.arange(1, 10, 2).repeat(10), np.arange(0, 10, 2).repeat(10)
    want = (a.mean() - b.mean()) / np.sqrt(((a.var(ddof=1) + b.var(ddof=1)) / 2) * (2 / 50))
    assert abs(t.t - want) < 1e-9 and t.df == 98


def test_streams(spark, tmp_path):
    rows = [(i % 3, f"2024-01-01 00:{i:02d}:00") for i in range(30)]
    spark.createDataFrame(rows, "block_id bigint, ts string").select("block_id", F.to_timestamp("ts").alias("ts")).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("block_id bigint, ts timestamp").parquet(f"file://{tmp_path}/in")
    q = progress.per_window(stream).writeStream.format("memory").queryName("win").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("win").collect()) == [10, 10, 10]
    q = progress.completions(stream).writeStream.format("memory").queryName("done").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("done").count() == 3
    seen = []
    progress.seeds(stream.select("block_id"), lambda b: seen.append(b.count()), f"file://{tmp_path}/cp").awaitTermination()
    assert sum(seen) == 30
