"""Agglomeration of whole graphs, peeling before cuts, closest pairs and spanning trees, against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import agglomeration, components, evaluate, kernels, peeling

NAMES = ["mean", "hist_quant_10", "hist_quant_50", "hist_quant_90", "hist_quant_75_initmax"]


def score_of(affs, name):
    """The named score from all affinities between two regions."""
    kind, quantile, _ = agglomeration.parsed(name)
    if kind == "mean":
        return 1 - sum(affs) / len(affs)
    bins = sorted(min(int(a * 255), 255) for a in affs)
    return 1 - bins[-(-quantile * len(bins) // 100) - 1] / 255


def brute(samples, name, threshold):
    """(a, b, score) by scoring all edges again after each merge, from the affinities themselves."""
    affs = defaultdict(list)
    for u, v, a in samples:
        affs[min(u, v), max(u, v)].append(a)
    if name.endswith("initmax"):
        affs = {e: [max(a)] for e, a in affs.items()}
    out = []
    while affs:
        score, (a, b) = min((score_of(x, name), e) for e, x in affs.items())
        if score > threshold:
            break
        out.append((a, b, round(score, 9)))
        following = defaultdict(list)
        for (u, v), x in affs.items():
            u, v = sorted(a if n == b else n for n in (u, v))
            if u != v:
                following[u, v] += x
        affs = following
    return out


def samples_of(rng, n, edges, most=6):
    out = []
    for _ in range(edges):
        u, v = rng.sample(range(n), 2)
        out += [(u, v, rng.random()) for _ in range(rng.randint(1, most))]
    return out


@pytest.mark.parametrize("name", NAMES)
def test_queue_equals_brute_force(name):
    for seed in range(6):
        samples = samples_of(random.Random(seed), 25, 60)
        rows = defaultdict(lambda: [0, 0.0])
        best = defaultdict(float)
        for u, v, a in samples:
            e = min(u, v), max(u, v)
            best[e] = max(best[e], a)
        for u, v, a in [(*e, a) for e, a in best.items()] if name.endswith("initmax") else samples:
            held = rows[min(u, v), max(u, v), min(int(a * 255), 255)]
            held[0] += 1
            held[1] += a
        got = agglomeration.queued([(*k, *v) for k, v in rows.items()], name, 0.7)
        want = brute(samples, name, 0.7)
        assert [(a, b, pytest.approx(s, abs=1e-9)) for a, b, s in got] == want and len(want) > 5


@pytest.mark.parametrize("name", ["mean", "hist_quant_50"])
def test_rounds_equal_brute_force(spark, monkeypatch, name):
    """Without any one-task finish; affinities are such that no two edges ever score the same for the mean."""
    monkeypatch.setattr(agglomeration, "SMALL", -1)
    samples = samples_of(random.Random(11), 40, 70, most=1 if name != "mean" else 3)
    if name != "mean":  # one sample an edge, all in different bins: ties only come with merges, and are looked for below
        samples = [(u, v, ((k * 3) % 255 + 0.5) / 255) for k, (u, v, _) in enumerate(dict.fromkeys((u, v, 0) for u, v, _ in samples))]
    want = brute(samples, name, 0.6)
    state = agglomeration.edge_state(spark.createDataFrame(samples, "u bigint, v bigint, aff double"), name)
    history = agglomeration.agglomerate(state, name, 0.6)
    got = [(r.a, r.b, round(r.score, 9)) for r in history.collect()]
    assert max(r.round for r in history.collect()) > 1
    if name == "mean":
        assert sorted(got) == sorted(want)
    nodes = spark.range(40).select("id")
    root = {i: i for i in range(40)}

    def top(i):
        return i if root[i] == i else top(root[i])

    for a, b, _ in want:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert {r.id: r.component for r in agglomeration.segments(nodes, history).collect()} == {i: top(i) for i in range(40)}


def test_finish_in_one_task_is_the_same(spark):
    samples = samples_of(random.Random(12), 60, 120)
    state = agglomeration.edge_state(spark.createDataFrame(samples, "u bigint, v bigint, aff double"), "mean")
    got = [(r.a, r.b, round(r.score, 9)) for r in agglomeration.agglomerate(state, "mean", 0.55).collect()]
    assert got == brute(samples, "mean", 0.55)
    assert agglomeration.agglomerate(state.limit(0), "mean", 0.5).count() == 0
    with pytest.raises(ValueError):
        agglomeration.parsed("hist_quant_x")


def test_small_segments_are_peeled_without_rounds(spark, monkeypatch):
    rng = random.Random(11)
    links = [(c, c + v, c + rng.randrange(v)) for c in range(0, 1200, 40) for v in range(1, 40)] + [(c, c + 3, c + 17) for c in range(0, 1200, 40)]
    edges = spark.createDataFrame(links, "component bigint, u bigint, v bigint")
    kept = spark.createDataFrame([(c + k,) for c in range(0, 1200, 40) for k in (0, 39)], "id bigint")
    want = {tuple(r) for r in peeling.peeled(edges, kept).collect()}
    monkeypatch.setattr(peeling, "SMALL", 60)
    monkeypatch.setattr(peeling, "peeled", lambda *a: pytest.fail("rounds"))
    assert {tuple(r) for r in peeling.peeled_segments(edges, kept).collect()} == want


@pytest.mark.parametrize("small", [10**6, 0])
def test_peeling_keeps_cycles_and_seeds(spark, small):
    rng = random.Random(5)
    links = {tuple(sorted(rng.sample(range(80), 2))) for _ in range(78)} | {(200, 201), (201, 202), (202, 200), (202, 203), (203, 204), (300, 301)}
    kept = {1, 7, 203, 40}
    df = spark.createDataFrame(sorted(links), "u bigint, v bigint")
    got = {r.id: r.root for r in peeling.peeled(df, spark.createDataFrame([(k,) for k in kept], "id bigint"), small).collect()}
    core = {i for i, r in got.items() if i == r}
    assert set(got) == {n for e in links for n in e} and kept & set(got) <= core and {200, 201, 202} <= core and got[204] == 203 and got[301] == 300
    near = defaultdict(set)
    for u, v in links:
        near[u].add(v)
        near[v].add(u)
    for n in core - kept:  # a core node is in a cycle, between kept nodes or cycles, or all that is left of a tree
        assert len([m for m in near[n] if m in core]) >= 2 or not [m for m in near[n] if m in core]
    for i, r in got.items():  # what hangs reaches its root without another core node
        seen, stack = {i}, [i]
        while stack:
            for m in near[stack.pop()]:
                if m not in seen and (m not in core or m == r):
                    seen.add(m)
                    if m != r:
                        stack.append(m)
        assert r in seen


@pytest.mark.parametrize("small", [10**6, 0])
def test_cuts_after_peeling_weigh_the_least(spark, monkeypatch, small):
    """Weights against all subsets, with trees hung on seeds and cycles."""
    from itertools import product

    monkeypatch.setattr(peeling, "SMALL", small)
    rng = random.Random(8)
    rows, want = [], {}
    for c in range(6):
        base, n = 100 * c, 9
        edges = {(base + rng.randrange(k), base + k): round(rng.random(), 2) for k in range(1, n)}
        edges |= {tuple(sorted(base + x for x in rng.sample(range(n), 2))): round(rng.random(), 2) for _ in range(4)}
        rows += [(*e, s) for e, s in edges.items()]
        a, b = base, base + n - 1
        weight = {e: max(1, round(1000 * (1 - s))) for e, s in edges.items()}
        best = min(sum(w for (u, v), w in weight.items() if side[u - base] != side[v - base]) for side in product((0, 1), repeat=n) if side[0] == 0 and side[-1] == 1)
        want[base] = (weight, best, a, b)
    edges = spark.createDataFrame(rows, "u bigint, v bigint, merge_score double")
    segments = spark.createDataFrame([(100 * c + k, 100 * c) for c in range(6) for k in range(9)], "id bigint, component bigint")
    seeds = spark.createDataFrame([(c, a, b) for c, (_, _, a, b) in want.items()], "component bigint, a bigint, b bigint")
    sides = {r.id: r.side for r in kernels.min_cut(edges, segments, seeds).collect()}
    assert len(sides) == 54
    for weight, best, a, b in want.values():
        assert sides[a] == 0 and sides[b] == 1 and sum(w for (u, v), w in weight.items() if sides[u] != sides[v]) == best


def test_closest_pairs_and_trees_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "NODE_PAIRS", 0)  # halve to the end
    rng = random.Random(9)
    rows = []
    for label in range(4):
        for s in range(7):
            z, y, x = (rng.randrange(900) for _ in range(3))
            for _ in range(rng.randint(1, 25)):
                rows.append((len(rows), 10 * label + s, label, z, y, x))
                z, y, x = z + rng.randint(-30, 30), y + rng.randint(-30, 30), x + rng.randint(-30, 30)
    rows += [(9000, 3, 0, 5, 5, 5), (9001, 4, 0, 5, 5, 5), (9002, 5, 0, 5, 5, 5), (9003, 99, 77, 1, 1, 1)]
    nodes = spark.createDataFrame(rows, "id bigint, skeleton_id bigint, label bigint, z bigint, y bigint, x bigint")
    for levels in (24, 3):
        monkeypatch.setattr(evaluate, "MOST_LEVELS", levels)
        got = {(r.label, r.skeleton_a, r.skeleton_b): (r.d, r.a, r.b) for r in evaluate.merge_sites(nodes, 3).collect()}
        want = {}
        for p in rows:
            for q in rows:
                if p[2] == q[2] and p[1] < q[1]:
                    d = 9 * (p[3] - q[3]) ** 2 + (p[4] - q[4]) ** 2 + (p[5] - q[5]) ** 2
                    want[p[2], p[1], q[1]] = min(want.get((p[2], p[1], q[1]), (d + 1, 0, 0)), (d, p[0], q[0]))
        assert got == want
    sites = evaluate.merge_sites(nodes, 3)
    tree = evaluate.minimal_sites(sites).collect()
    root: dict = {}

    def top(i):
        return i if root.setdefault(i, i) == i else top(root[i])

    least = []
    for (label, s, t), (d, a, b) in sorted(want.items(), key=lambda w: w[1]):
        if top((label, s)) != top((label, t)):
            root[top((label, s))] = top((label, t))
            least.append((label, s, t, a, b, d))
    assert sorted((r.label, r.skeleton_a, r.skeleton_b, r.a, r.b, r.d) for r in tree) == sorted(least)
    assert evaluate.merge_sites(nodes.limit(0)).count() == 0 and evaluate.minimal_sites(sites.limit(0)).count() == 0


def test_closest_pairs_meet_few_nodes(spark):
    """Long parallel threads: node pairs stay in proportion to nodes."""
    rows = [(1000 * s + k, s, 1, k * 7, 400 * s, k * 5) for s in range(3) for k in range(600)]
    nodes = spark.createDataFrame(rows, "id bigint, skeleton_id bigint, label bigint, z bigint, y bigint, x bigint")
    plan = evaluate.merge_sites(nodes)
    assert {(r.skeleton_a, r.skeleton_b): r.d for r in plan.collect()} == {(0, 1): 160_000, (1, 2): 160_000, (0, 2): 640_000}


def test_stars_to_the_end(spark):
    links = [(k, k + 1) for k in range(500) if k % 97] + [(1000, 1000 + k) for k in range(1, 300)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    got = {r.node: r.component for r in components.component_edges(df, small=0).collect()}
    assert got == {r.node: r.component for r in components.component_edges(df).collect()} and len(set(got.values())) == 7


@pytest.mark.parametrize("name", ["mean", "hist_quant_50"])
def test_components_have_their_own_queues(spark, monkeypatch, name):
    """Equal scores along chains would take a round a merge; a component that a queue can hold takes none."""
    monkeypatch.setattr(agglomeration, "SMALL", 150)
    rng = random.Random(3)
    samples = [(100 * g + k, 100 * g + k + 1, 0.9) for g in range(6) for k in range(60)]
    samples += [(100 * g + rng.randrange(61), 100 * h + rng.randrange(61), 0.2) for g in range(6) for h in range(6)]
    state = agglomeration.edge_state(spark.createDataFrame(samples, "u bigint, v bigint, aff double"), name)
    want = agglomeration.queued([tuple(r) for r in state.collect()], name, 0.5)
    got = agglomeration.agglomerate(state, name, 0.5).collect()
    assert {(r.a, r.b, round(r.score, 9)) for r in got} == {(a, b, round(s, 9)) for a, b, s in want} and len(got) == len(want) > 300
    assert {r.round for r in got} == {0}


def test_queues_get_tasks_by_rows_and_keep_the_order_of_ties(spark, monkeypatch):
    monkeypatch.setattr(agglomeration, "QUEUE_ROWS", 20)
    rng = random.Random(3)
    samples = [(u + k, v + k, rng.choice([0.1, 0.6, 1.0])) for k in range(0, 400, 20) for u, v in (rng.sample(range(20), 2) for _ in range(30))]
    state = agglomeration.edge_state(spark.createDataFrame(samples, "u bigint, v bigint, aff double"), "hist_quant_50")
    rows = state.count()
    done = agglomeration._groups_finished(state.withColumn("pack", (F.col("u") / 20).cast("int")), rows, "hist_quant_50", 0.5)
    assert done.rdd.getNumPartitions() == -(-rows // 20)
    want = {(a, b, s) for a, b, s in brute(samples, "hist_quant_50", 0.5)}
    assert {(r.a, r.b, round(r.score, 9)) for r in done.collect()} == want


@pytest.mark.parametrize("name", NAMES)
def test_edges_within_a_threshold_need_no_lists(spark, name):
    state = agglomeration.edge_state(spark.createDataFrame(samples_of(random.Random(5), 30, 200), "u bigint, v bigint, aff double"), name)
    for threshold in (-0.1, 0.2, 0.5, 1.0):
        got = agglomeration.within(state, name, threshold)
        assert "collect_list" not in got._jdf.queryExecution().toString()
        want = {(r.u, r.v) for r in agglomeration.scored(state, name).collect() if r.score <= threshold}
        assert {(r.u, r.v) for r in got.collect()} == want


def test_links_of_near_ids_need_no_star_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "SMALL", 100)
    monkeypatch.setattr(components, "TASK_ROWS", 150)
    monkeypatch.setattr(components, "_round", lambda edges: pytest.fail("a round of stars"))
    rng = random.Random(7)
    chains = [list(range(k, k + 30)) for k in range(0, 900, 30)]
    for c in chains:
        rng.shuffle(c)
    links = [pair for c in chains for pair in zip(c, c[1:])]
    got = components.component_edges(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert sorted(tuple(r) for r in got) == [(n, n - n % 30) for n in range(900)]


def test_small_groups_share_a_pack_and_blocks_are_parted(spark, monkeypatch):
    """The packs change no result; a block's merges keep the order of one queue over the block."""
    from tessera.operators import skew

    rng = random.Random(5)
    edges = [(10 * g + a, 10 * g + b, rng.choice([0.1, 0.2, 0.3, 0.6])) for g in range(30) for a in range(8) for b in range(a + 1, 8) if rng.random() < 0.4]
    e = spark.createDataFrame(edges, "u bigint, v bigint, merge_score double")
    nodes = spark.createDataFrame([(10 * g + a, g % 2) for g in range(30) for a in range(8)], "id bigint, block_id bigint")
    want = {}
    for block in (0, 1):
        made: list = []
        kernels.agglomerated(sorted(x for x in edges if x[0] // 10 % 2 == block), 0.3, history=made)
        want |= {(block, k): m for k, m in enumerate(made)}
    found = components.connected_components(nodes, e.filter("merge_score <= 0.3"))
    ends = found.groupBy("component").agg({"id": "max"}).toDF("a", "b").filter("a < b")
    again = []
    for rows in (1, 1_000_000):
        monkeypatch.setattr(skew, "PACK_ROWS", rows)
        assert {(r.block_id, r.step): (r.a, r.b, r.score) for r in kernels.merge_history(nodes, e, 0.3).collect()} == want
        apart = kernels.reagglomerate(e.filter("merge_score <= 0.3"), found, ends, 0.3)
        again.append(sorted(map(tuple, apart.collect())))
        assert "pack" in apart._jdf.queryExecution().executedPlan().toString()
    assert again[0] == again[1]
