import zlib

import numpy as np
import pytest

from tessera.llm import quality


@pytest.fixture(scope="module")
def made(spark):
    random = np.random.default_rng(0)
    words = ["river", "stone", "cloud", "light", "walks", "under", "green", "early"]
    rows, labels = [], []
    for i in range(600):
        text = " ".join(random.choice(words, 30))
        if i % 3 == 0:
            text = text.upper() if i % 2 else " ".join([words[i % 8]] * 30)
        rows.append((i, text))
        labels.append((i, int(i % 3 != 0), "z"))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "wörter " * 40000), (1003, "wörter " * 40000), (None, "river")]
    labels += [(None, 1, "z"), (5000, 0, "z"), (1, None, "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("text", "text"), spark.createDataFrame(labels, "doc_id bigint, quality int, text string")


def test_held_out_accuracy(spark, made):
    docs, labels = made
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= quality.THRESHOLD) == (r.doc_id % 3 != 0) for r in unseen]) > 0.95
    again = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs.repartition(7), labels)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-3 for r in got)  # however the rows are dealt
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= quality.THRESHOLD for r in got)


def test_without_labels_or_rows(spark, made):
    docs, labels = made
    assert {r.score for r in quality.score(docs.limit(3), quality.fit(docs.limit(50), labels.limit(0))).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0


def test_an_id_with_both_labels_is_not_learnt_from(spark, made):
    docs, labels = made
    both = labels.union(spark.createDataFrame([(i, 0, "z") for i in range(600) if i % 3], labels.schema))
    model = quality.fit(docs, both)
    assert not model.layers and model.prior == 0.0  # only label 0 is left


def test_whole_words_count(spark):
    long = "ab1-" * 50_000
    assert quality._row(long + "x") != quality._row(long + "X9") and quality._row(long)[1] != quality._row(long[:12])[1]


def test_vector_sums_equal_brute_force(spark):
    text = "a b b c A! d9"
    sums = quality.vector_sums(spark.createDataFrame([(text,), ("x",)], "text string"))
    place, sign = quality.index_vectors()
    want = np.zeros((quality.ROWS, quality.DIM + 1))
    for t in (text, "x"):
        words = t.split()
        pairs = [quality._row(w) for w in words]
        shapes = [quality.WORDS if i and words[i] == words[i - 1] else p[1] for i, p in enumerate(pairs)]
        for rows in ([p[0] for p in pairs], shapes):
            for i, r in enumerate(rows):
                want[r, -1] += 1
                for j in range(max(0, i - 2), min(len(rows), i + 3)):
                    if j != i:
                        for k in range(quality.NONZERO):
                            want[r, place[rows[j], k]] += sign[rows[j], k]
    assert (sums == want).all()


def test_calibration_softens_overconfidence():
    y = np.array([1.0, 0, 1, 0, 1, 1, 0, 1] * 20)
    assert quality.calibrated(np.where(np.arange(160) % 8 < 6, 2 * y - 1, 1 - 2 * y) * 8, y) > 2


def test_ids_that_repeat_are_one_row_of_the_sample(spark):
    rows = [(k, f"good words here {k}" if k % 2 else "bad bad bad", 1) for k in range(40)] + [(3, "good words here 3", 1)] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    again = docs.dropDuplicates()
    one, many = (quality.score(docs, quality.fit(d, labels)) for d in (again, docs))
    assert many.count() == len(rows) and one.columns == ["doc_id", "score"]  # a column called score does not clash
