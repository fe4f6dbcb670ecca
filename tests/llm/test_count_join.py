import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import count_join
from tessera.operators import skew
from tests.llm.test_mixing_near import brute as brute_near


def brute(rows, percent=80):
    return brute_near(rows, 5, percent)


def family(random, n, size, changes, at):
    start = [f"w{x}" for x in random.integers(0, 50_000, size)]
    out = []
    for k in range(n):
        words = list(start)
        for i in random.integers(0, size, int(random.integers(0, changes + 1))):
            words[i] = f"z{random.integers(0, 99)}"
        out.append((at + k, " ".join(words)))
    return out


def table_of(random):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\x0btwo"), (6, "two one"), (7, "é É")]
    for k, (size, changes) in enumerate([(5, 1), (9, 1), (40, 2), (150, 5), (600, 14), (2500, 40)]):
        rows += family(random, 14, size, changes, 100 * (k + 1))
    shared = " ".join(f"p{k}" for k in range(70))  # a passage of many different texts, one of them nothing else
    rows += [(2000 + k, shared + " " + " ".join(f"q{x}" for x in random.integers(0, 9999, int(random.integers(2, 60))))) for k in range(60)]
    rows += [(3000, shared), (3001, shared + " end"), (5000, "long " + " ".join(f"v{x}" for x in random.integers(0, 10**6, 50_000)))]
    return rows


@pytest.mark.parametrize("common, leaf", [(128, 128), (8, 4), (2, 3)])
def test_join_equals_brute_force(spark, monkeypatch, common, leaf):
    """Also with small bounds: common tokens, salts, many leaves and boxes."""
    monkeypatch.setattr(count_join, "COMMON", common)
    monkeypatch.setattr(count_join, "OVER_MEAN", 0)
    if leaf < 128:
        monkeypatch.setattr(skew, "HOT_ROWS", 5)
        monkeypatch.setattr(count_join, "DEALT", 20)
        links = count_join.tree_candidates
        monkeypatch.setattr(count_join, "tree_candidates", lambda *a: links(*a, leaf=leaf))
    rows = table_of(np.random.default_rng(3))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, node int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in count_join.components(docs).collect()}
    assert got == brute(rows)


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (None, None), (4, "a b d")], "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in count_join.components(docs).collect()) == [("3", 1, "3"), ("4", 1, "4"), ("None", 0, "None"), ("None", 1, "None")]
    assert count_join.components(docs.limit(0)).count() == 0
    text = " ".join(f"a{i}" for i in range(40))
    again = spark.createDataFrame([(5, text), (5, "b " * 9), (7, text + " x"), (8, "b " * 10 + "c")], "doc_id bigint, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in count_join.components(again).collect()}
    assert got[5, 36] == got[5, 1] == got[7, 37] == 5


def test_bound_is_never_below_the_overlap():
    random = np.random.default_rng(4)
    for _ in range(200):
        pool = random.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(random.integers(0, 2))
        a = np.unique(pool[: int(random.integers(1, 3000))])
        b = np.unique(pool[int(random.integers(0, 1500)) : int(random.integers(1501, 3000))])
        shared = len(np.intersect1d(a, b))
        assert shared <= count_join.most_shared(count_join.group_counts(a), count_join.group_counts(b)) <= min(len(a), len(b))


def test_linked_sets_share_a_first_token():
    random = np.random.default_rng(5)
    for _ in range(300):
        n = int(random.integers(1, 60))
        a = np.unique(random.integers(0, 200, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[random.random(len(a)) < 0.9], random.integers(0, 200, 3).astype(np.uint64)]))
        common = random.integers(0, 200, 30)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            first = [set(count_join.reordered(x, np.isin(x, common), 80).tolist()) for x in (a, b)]
            assert first[0] & first[1]


def test_common_cells_are_counted_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(count_join, "FEWEST_CELLS", 1 << 13)
    monkeypatch.setattr(count_join, "LOAD", 4)
    random = np.random.default_rng(7)
    shared = " ".join(f"p{k}" for k in range(20))
    rows = [(k, shared + " " + " ".join(f"q{x}" for x in random.integers(0, 10**6, 40))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    marks = count_join.common_cells(docs)
    assert len(marks) == 1 << 15
    import pyarrow as pa

    sets = list(count_join.shingle_sets(pa.array([t for _, t in rows])))
    counts = np.bincount(count_join.cell_of(np.concatenate(sets), len(marks)), minlength=len(marks))
    assert (marks == (counts > 128)).all() and 16 <= marks.sum() <= 32
    assert not count_join.common_cells(docs.limit(0)).any()


def test_boxes_keep_pairs_that_may_link_and_drop_others(spark):
    """Leaves of unlike counts do not meet; those that hold a link do."""
    random = np.random.default_rng(6)
    rows = family(random, 8, 60, 1, 0) + family(random, 8, 60, 1, 100) + [(200 + k, " ".join(f"y{x}" for x in random.integers(0, 9**6, 60))) for k in range(16)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = count_join.points(docs).withColumnRenamed("doc_id", "node")
    members = nodes.select(F.lit(1).cast("bigint").alias("key"), "node", F.col("node").alias("component"))
    stars = members.select("node", "component").limit(0)
    spots = count_join.leaves(members, nodes, stars, 80, leaf=2)
    boxes = nodes.select("node", "counts").mapInArrow(count_join._boxed, "node bigint, box array<bigint>")
    met = count_join.meeting(spots, boxes, 80)
    n = spots.select("band", "leaf").distinct().count()
    assert 0 < met.count() < n * (n + 1) // 2
    found = {(r.a, r.b) for r in count_join.tree_candidates(members, nodes, stars, 80, leaf=2).collect()}
    assert {(a, b) for a in range(8) for b in range(a + 1, 8) if brute([rows[a], rows[b]])[b][1] == a} <= found
    assert len(found) < len(rows) * (len(rows) - 1) // 4
