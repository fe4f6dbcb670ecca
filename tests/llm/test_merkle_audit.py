import hashlib
import zlib
from itertools import permutations

import pytest

from tessera.llm import base, filter_audit, merkle
from tessera.operators import skew


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes, fanout=3):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def path(tree, i, fanout=3):
    """(left, right) siblings level by level."""
    out = []
    for level in tree[:-1]:
        at = i // fanout * fanout
        out.append(("".join(level[at:i]), "".join(level[i + 1 : at + fanout])))
        i //= fanout
    return out


def brute(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, levels([leaf(r) for r in own], fanout)
    over = levels([t[-1][0] for _, t in trees.values()], fanout)
    out = []
    for k, s in enumerate(sources):
        own, tree = trees[s]
        for i, r in enumerate(own):
            steps = path(tree, i, fanout) + path(over, k, fanout)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            have = leaf((*r[:4], r[4].replace("\n", "") if bad and r[4] is not None else r[4]))
            for a, b in steps:
                have = h(a, have, b)
            out.append((r[0], leaf(r), tree[-1][0], over[-1][0], h(*[a + b for a, b in steps]), have, have == over[-1][0]))
    return out


ROWS = [(i, f"s{i % 4}", "en", i, f"text {i}\nline\n" if i % 3 else f"flat {i}") for i in range(90)]
ROWS += [(200 + i, "hot", None, None, "same\ntext") for i in range(250)] + [(5, "hot", "x", 1, None), (5, "hot", "x", 1, ""), (5, "hot", "x", 1, "")]
ROWS += [(None, None, None, None, None), (7, None, "é", 2, "ü\n" * 5000), (8, "", "a", 0, ""), (9, "Ω", "a", 3, "x"), (10, "z", "a", 3, "\n")]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [r for r in ROWS if r[1] == "hot"], ROWS[-5:]], ids=["all", "one leaf", "one source", "lone leaves"])
def test_manifest_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "q") for r in rows], SCHEMA + ", leaf string")
    got = [tuple(r) for r in merkle.verified(merkle.manifest(docs)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_no_rows_and_shuffled_lists(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS[:60], SCHEMA)
    assert merkle.verified(merkle.manifest(docs.limit(0))).count() == 0
    monkeypatch.setattr(base, "SMALL_STARTS", -1)
    monkeypatch.setattr(merkle, "SMALL_STARTS", -1)
    got = sorted(tuple(r) for r in merkle.verified(merkle.manifest(docs)).collect())
    assert got == sorted(brute(ROWS[:60]))


def test_other_shapes_of_trees(spark):
    docs = spark.createDataFrame(ROWS[:90], SCHEMA)
    for fanout, tier in ((2, 3), (5, 1)):
        got = merkle.verified(merkle.manifest(docs, fanout=fanout, tier=tier)).select("doc_id", "subroot", "root", "proof_sha256").collect()
        assert sorted(map(tuple, got)) == sorted((r[0], *r[2:5]) for r in brute(ROWS[:90], fanout))


def masks_of(rows):
    import re

    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, part, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and t in least and i > least[t]]
        out.append((part or "", sum(f << k for k, f in enumerate(fails)), i))
    return out


def brute_audit(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    out = {}
    rows = masks_of(rows)
    for part in {p for p, *_ in rows}:
        own = [(m, i in good, i in toxic) for p, m, i in rows if p == part]
        shapley = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            for m, *_ in own:
                first = next((f for f in order if m >> f & 1), None)
                if first is not None:
                    shapley[first] += 1
        for order in permutations(range(5)):
            for step in range(5):
                f, before = order[step], sum(1 << k for k in order[:step])
                here = [r for r in own if r[0] >> f & 1 and not r[0] & before]
                counts = sum(not r[0] & (before | 1 << f) for r in own), len(here), sum(bool(r[0] >> f & 1 and r[0] & before) for r in own), sum(r[0] == 1 << f for r in own)
                out[part, "".join("ABCDE"[k] for k in order), step + 1] = (*counts, sum(r[1] for r in here), sum(r[2] for r in here), shapley[f])
    return out


LONG = " ".join(f"w{k}" for k in range(9000))
TEXTS = [None, "", " \t\n", "short", "LOUD words", "a# b", " ".join(["again"] * 400), LONG, LONG + " x", LONG[:-1] + "y", " ".join(f"é{k}" for k in range(300)), " ".join(f"W{k}" for k in range(300)), "one|two " + LONG]


def test_audit_equals_brute_force(spark, monkeypatch):
    rows = [(k, ["a", "b", None, ""][k % 4], TEXTS[k * 7 % len(TEXTS)]) for k in range(150)]
    rows += [(3, "a", LONG), (3, "b", LONG), (None, "a", LONG), (None, "c", None)] + [(1000 + k, "hot", "copy of one text") for k in range(200)]
    labels = [(k, k % 3 == 0 and 1 or 0, k % 5 == 0 and 1 or None) for k in range(0, 1200, 2)] + [(2, 1, 1), (4, None, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, source string, text string, mask int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = brute_audit(rows, labels)

    def got(df):
        counts = filter_audit.labelled_masks(filter_audit.masks(df), marks)
        return {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(counts).collect()}

    assert got(docs) == want
    monkeypatch.setattr(filter_audit, "SMALL_CLASSES", -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    assert got(docs) == want
    assert filter_audit.audit(filter_audit.labelled_masks(filter_audit.masks(docs.limit(0)), marks)).count() == 0


def test_equal_block_hashes_decide_nothing(spark, monkeypatch):
    """All texts of one length get the same class: only the comparison of full texts tells them apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(filter_audit, "_blocks", lambda text: [F.lit(1).cast("bigint")] * len(filter_audit.BLOCKS))
    rows = [(k, "a", f"text {k % 7}") for k in range(40)] + [(90, "b", "other one"), (91, "b", "other two"), (91, "b", "other one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = sorted(tuple(r) for r in filter_audit.masks(docs).select("part", "mask", "doc_id").collect())
    assert got == sorted(masks_of(rows))
