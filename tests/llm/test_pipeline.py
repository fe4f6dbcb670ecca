import zlib

import corpus_pipeline
from tests.llm.test_mixing_near import brute


def test_stages_take_effect(spark, tmp_path):
    junk = [(i, " ".join([f"x{i % 7}"] * 40), "en", "src1", 0) for i in range(60)]
    base = [(100 + i, " ".join(f"w{(i * 37 + k * k) % 997}" for k in range(60)), "en" if i % 2 else "de", f"src{i % 3}", 0) for i in range(120)]
    copies = [(400 + i, base[i][1], "en", "src1", 0) for i in range(30)]
    near = [(500 + i, base[60 + i][1] + " more", "en", "src1", 0) for i in range(30)]
    docs = spark.createDataFrame(junk + base + copies + near + [(900, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = [(i, 0, 0) for i, *_ in junk] + [(i, 1, 0) for i, *_ in base]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = {}
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        path = f"{tmp_path}/{zlib.crc32(name.encode())}"
        out.write.parquet(path)
        before, at = at, spark.read.parquet(path)
        made[name] = at
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
    ids = [{r.doc_id for r in made[n].select("doc_id").collect()} for n, _ in corpus_pipeline.STAGES]
    assert not ids[0] & {i for i, *_ in junk} and ids[0] >= {i for i, *_ in base}
    assert ids[1] == ids[0] - {i - 300 for i, *_ in copies}
    rows = [(r.doc_id, r.text) for r in made[corpus_pipeline.STAGES[1][0]].collect()]
    assert ids[2] == {i for i, (_, c) in brute(rows).items() if c == i}
    assert ids[3] < ids[2] and ids[4] == ids[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == at.count()


def test_edge_cases_in_every_stage(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and columns with the names that operators use."""
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, epoch string, salt int, digest string, score double, node int, row int, n int, label int"
    extra = ("e", 1, "d", 0.5, 2, 3, 4, 5)
    rows = [(i, f"plain words number {i} and some more of them {i * i}", "en", "src1", 0, *extra) for i in range(40)]
    rows += [(90, None, None, None, None, *extra), (91, "", "de", "src0", 0, *extra), (92, "long " * 60_000 + "end", "en", "src0", 0, *extra), (None, "no id", "en", "src1", 0, *extra), (5, rows[5][1], "en", "src1", 0, *extra)]
    docs = spark.createDataFrame(rows, columns)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for at in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
                assert out.count() <= at.count() * 4 and (at.isEmpty() or not out.isEmpty()), name
            else:
                assert out.count() >= at.count(), name
    kept = corpus_pipeline.drop_copies(spark, docs, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([str(i) for i in range(40)] + ["91", "92", "None"])
    packed = corpus_pipeline.pack_best(spark, docs, str(tmp_path)).collect()
    assert sum(r.length for r in packed if r.doc_id == 92) > 60_000 and [r.length for r in packed if r.doc_id == 90] == [1]
