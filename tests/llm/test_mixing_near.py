from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tessera.llm import mixing, near_dedup


def budgets(available, total, weights, epochs=mixing.EPOCHS, default=1.0):
    """Whole tokens for each leaf path, by recursion from the root."""
    def share(paths, depth, budget, level):
        if depth == len(paths[0]):
            return {paths[0]: budget}
        groups = {}
        for p in sorted(paths):
            groups.setdefault(p[depth], []).append(p)
        found = [level.get(k, level.get("*", (default, {}))) for k in groups]
        parts = mixing.fill(budget, [epochs * sum(available[p] for p in g) for g in groups.values()], [w for w, _ in found])
        out = {}
        for own, part, (_, below) in zip(groups.values(), parts, found):
            out |= share(own, depth + 1, part, below)
        return out

    return {p: round(b) for p, b in share(list(available), 0, total, weights).items()}


def test_shortages_go_to_siblings_first(spark):
    have = {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 1000}
    weights = {"a": (1, {"x": (1, {}), "y": (1, {})}), "b": (1, {})}
    leaves = spark.createDataFrame([(*k, n) for k, n in have.items()], "domain string, lang_ string, n bigint")
    got = lambda total, epochs: {(r.domain, r.lang_): r.budget for r in mixing.budgets(leaves, total, weights, epochs, keys=["domain", "lang_"]).collect()}
    for total, epochs, want in ((100, 1, (10, 40, 50)), (600, 1, (10, 100, 490)), (9999, 2, (20, 200, 2000))):
        assert got(total, epochs) == dict(zip(have, want)) == budgets(have, total, weights, epochs)
    assert mixing.fill(10, [5, 5, 50], [0, 0, 1]) == [0, 0, 10]
    assert mixing.fill(60, [5, 5, 50], [0, 0, 1]) == [5, 5, 50]


@pytest.fixture(scope="module")
def sources(spark):
    random = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(random.integers(0, 40))), ["en", "de", None][i % 3], f"src{i % 4}" if i % 2 else "src0", i) for i in range(900)]
    rows += [(2000, None, "en", None, 0), (2001, "a b", "en", "src1", 0), (2001, "a b", "en", "src1", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, epoch int")


@pytest.mark.parametrize(("budget", "small", "few"), [(0.4, 20_000, 100), (0.4, 3, 1), (25_000, 50, 100), (10**9, 5, 100)])
def test_mix_equals_brute_force(spark, sources, monkeypatch, budget, small, few):
    monkeypatch.setattr(mixing, "SMALL", small)
    monkeypatch.setattr(mixing, "SMALL_LEAVES", few)
    weights = {"head": (0.5, {"en": (3.0, {}), "*": (1.0, {})}), "tail": (0.5, {})}
    got = Counter((r.doc_id, r.epoch) for r in mixing.mix(sources, weights, budget).collect())
    slim = sources.select("doc_id", "text", "lang", "source")
    from pyspark.sql import functions as F

    leaves, ranks = defaultdict(list), {}
    for e in range(mixing.EPOCHS + 1):
        for r in slim.select("doc_id", mixing._rank(mixing.SEED, F.lit(e), F.col("doc_id"), F.xxhash64("text")).alias("k")).collect():
            ranks[r.doc_id, e] = r.k
    for r in slim.collect():
        leaves["head" if r.source == "src0" else "tail", r.lang or "", r.source or ""].append((r.doc_id, len((r.text or "").split())))
    have = {k: sum(n for _, n in v) for k, v in leaves.items()}
    want = Counter()
    for leaf, tokens in budgets(have, budget * sum(have.values()) if budget < 1 else budget, weights).items():
        for e in range(mixing.EPOCHS):
            whole = have[leaf] and tokens >= have[leaf]
            by_rank = defaultdict(list)  # repeated rows have one rank and are taken together
            for i, n in leaves[leaf]:
                by_rank[ranks[i, e]].append((i, n))
            left = tokens
            for _, rows in sorted(by_rank.items()):
                if whole or left > 0 and have[leaf]:
                    want.update((i, e) for i, _ in rows)
                left -= sum(n for _, n in rows)
            if not whole:
                break
            tokens -= have[leaf]
    assert got == want
    assert mixing.mix(sources.limit(0), weights, 0.5).count() == 0


def test_mix_keeps_columns_and_whole_texts(spark):
    rows = [(1, "w " * 300_000, "en", "src0", "mine"), (2, "a b", "en", "src1", "mine")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, epoch string")
    kept = mixing.mix(docs, {}, 10**9, epochs=1, epoch_column=None)
    assert kept.columns == docs.columns and {(r.doc_id, r.epoch, len(r.text)) for r in kept.collect()} == {(1, "mine", 600_000), (2, "mine", 3)}
    assert sorted(r.epoch for r in mixing.mix(docs, {}, 10**9, epochs=2).collect()) == [0, 0, 1, 1]


def brute(rows, width=5, percent=75):
    up = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    import re

    sets = {}
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(up))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_copies_equal_brute_force(spark):
    random = np.random.default_rng(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\x0btwo"), (6, "two one"), (7, "é É"), (8, "é é")]
    at = 10
    for size in (5, 6, 8, 30, 120, 600):
        base = [f"w{x}" for x in random.integers(0, 5000, size)]
        for _ in range(14):
            words = list(base)
            for k in random.integers(0, size, int(random.integers(0, max(2, size // 14)))):
                words[k] = f"z{random.integers(0, 9)}"
            rows.append((at, " ".join(words)))
            at += 3
    shared = " ".join(f"p{k}" for k in range(60))  # one passage in many different texts
    rows += [(1000 + k, shared + " " + " ".join(f"q{x}" for x in random.integers(0, 9999, 30))) for k in range(40)]
    rows.append((5000, "long " + " ".join(f"w{x}" for x in random.integers(0, 10**6, 60000))))
    rows.append((4, "one two"))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, component string")
    got = near_dedup.components(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    kept = near_dedup.distinct(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}
    assert near_dedup.components(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (None, None)], "doc_id bigint, text string")
    assert sorted((str(r.component_id), r.kept) for r in near_dedup.components(odd).collect()) == [("3", True), ("None", True), ("None", True)]


def test_ids_that_repeat_with_other_texts(spark):
    random = np.random.default_rng(8)
    a, b = (" ".join(f"{k}{x}" for x in random.integers(0, 9999, 40)) for k in "ab")
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (9, "alone " + " ".join(f"c{i}" for i in range(30))), (3, None), (3, "alone " + " ".join(f"c{i}" for i in range(31))), (None, a)]
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id) == [(3, 0, 3), (3, 28, 3), (5, 36, 5), (5, 36, 5), (7, 37, 5), (8, 37, 5), (9, 27, 3)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = near_dedup.distinct(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "3", "5", "5", "None"]


def test_many_near_copies_of_one_text_are_dealt_to_salts(spark, monkeypatch):
    """Nearly all pairs of the stars have one first end: its rows are salted, and the answer is the same."""
    from pyspark.sql import functions as F

    from tessera.llm import base

    random = np.random.default_rng(12)
    start = [f"w{x}" for x in random.integers(0, 9999, 60)]
    rows = [(k, " ".join([*start, f"n{k}", f"m{k % 7}"])) for k in range(3000)] + [(9000, "something else altogether, in one line")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = []
    first = near_dedup.salted
    monkeypatch.setattr(near_dedup, "salted", lambda rows, key, hot, by, *a: seen.append((key, hot.count())) or first(rows, key, hot, by, *a))
    got = {r.doc_id: r.component_id for r in near_dedup.components(docs).collect()}
    assert {c for i, c in got.items() if i < 9000} == {0} and got[9000] == 9000
    assert any(key == "a" and n for key, n in seen)
    pairs = spark.createDataFrame([(0, k) for k in range(1, 3000)], "a bigint, b bigint")
    met = near_dedup._beside(pairs, docs.select(F.col("doc_id").alias("node"), "text"), {"text": "ta tb"})
    assert met.count() == 2999 and base.SALTS > 1


def test_large_buckets_are_dealt_to_parts(spark, monkeypatch):
    """Hot band keys, salts and parts: many small components that share all of a passage, beside one large component."""
    from tessera.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(near_dedup, "GROUP_ROWS", 7)
    random = np.random.default_rng(9)
    shared = [f"p{k}" for k in range(70)]
    rows = [(k, " ".join(shared + [f"q{x}" for x in random.integers(0, 9999, 28)])) for k in range(60)]
    rows += [(100 + k, rows[k % 20][1] + f" r{k}") for k in range(60)]
    rows += [(300 + k, " ".join(shared + [f"t{j}" for j in range(20)] + [f"u{k}"])) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.components(docs).collect()} == want
    assert len({c for _, c in want.values()}) > 20


def test_cross_links_join_all_components_that_meet():
    random = np.random.default_rng(10)
    base = random.integers(0, 2**32, 60, dtype=np.uint32)
    sets = [np.unique(np.concatenate([base[: 60 - k % 13], random.integers(0, 2**32, k % 5, dtype=np.uint32)])) for k in range(30)]
    every = np.ones(30, bool)
    found = near_dedup.cross_links(np.arange(30), np.arange(30), sets, every, every, 75)
    root = list(range(30))

    def top(i):
        return i if root[i] == i else top(root[i])

    for a, b in found:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)
        root[max(top(a), top(b))] = min(top(a), top(b))
    for a in range(30):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * both < 75 * (len(sets[a]) + len(sets[b]) - both) or top(a) == top(b)


def test_estimate_follows_similarity():
    random = np.random.default_rng(6)
    for share in (0.5, 0.75, 0.9):
        off = []
        for _ in range(40):
            pool = random.integers(0, 2**63, 4000, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            cut = int(2000 * share)
            a, b = np.unique(pool[:2000]), np.unique(np.concatenate([pool[:cut], pool[2000 : 4000 - cut]]))
            true = cut / (4000 - cut)
            off.append(near_dedup.similarity(near_dedup.sketch(a), near_dedup.sketch(b)) - true)
        assert abs(np.mean(off)) < 0.02
