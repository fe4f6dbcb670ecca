import hashlib
import zlib

import numpy as np
import pytest

from tessera.llm import exact_dedup, pack, rans
from tessera.llm.tokens import CachedTokenizer, default_path

ODD = [None, "", "  a  b\n\n c\t\n", "don't we'll 's x", "a\x1cb c\x85d", "x y　z", " \n", "Σας ΟΔΟΣ é́", "<|endoftext|> a", "w " * 30000, "\x01 \x01a"]


def plain(name, end, text):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(default_path(name))
    model.encode_special_tokens = True
    return np.array([*model.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize(("name", "spaces"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_tokens_equal_the_library(name, spaces):
    import pyarrow as pa

    model = CachedTokenizer(default_path(name), spaces)
    for got in (model.encode(ODD), model.batches(pa.array(ODD))):
        assert [g + np.array([7], "<u4").tobytes() for g in got] == [plain(name, 7, t).tobytes() for t in ODD]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, rans.BLOCK, 2 * rans.BLOCK + 17])
def test_segment_round_trip_and_checkpoints(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype("<u4")
    data = rans.encode_segment(ids)
    segment = rans.Segment(data)
    assert (segment.all_ids() == ids).all()
    if n > rans.LANES * rans.STRIDE:
        k = segment.entries[0][3]
        assert (segment.block_ids(0, k) == ids[: segment.entries[0][1]][k * rans.STRIDE * rans.LANES :]).all()
        assert len(data) < 4 * n
        bad = bytearray(data)
        bad[segment.entries[0][0] + 8 * rans.LANES + segment.entries[0][3] * (4 + 8 * rans.LANES) + 40] ^= 1
        with pytest.raises(ValueError):
            rans.Segment(bytes(bad)).all_ids()


def test_crc_shares():
    whole = bytes(range(200))
    shares = [rans.shifted_crc(zlib.crc32(whole[a:b]), 200 - b) for a, b in ((0, 3), (3, 90), (90, 200))]
    assert shares[0] ^ shares[1] ^ shares[2] == zlib.crc32(whole)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "x") for i, t in enumerate(ODD)] + [(900, "twin", "y"), (901, "twin", "y"), (901, "twin", "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, start string")


def test_token_file(spark, docs, tmp_path):
    path = default_path("byte_bpe_50k.json")
    rans.write_tokens(docs, f"file://{tmp_path}/t", path, 2, segment=5000)
    got = sorted(map(tuple, rans.read_index(spark, f"file://{tmp_path}/t").collect()))
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = plain("byte_bpe_50k.json", 2, r.text)
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == sorted(want)
    rans.write_tokens(docs.limit(0), f"file://{tmp_path}/e", path, 2)
    assert rans.read_index(spark, f"file://{tmp_path}/e").count() == 0


def test_rows_without_an_id_are_dealt_over_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "SAME_ID", 50)
    path = default_path("byte_bpe_50k.json")
    rows = [(None, f"row {k % 90}") for k in range(400)] + [(5, "same")] * 60 + [(3, "first"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    rans.write_tokens(docs, f"file://{tmp_path}/n", path, 2)
    assert spark.read.parquet(f"file://{tmp_path}/n").select("part").distinct().count() > 1
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rans.read_index(spark, f"file://{tmp_path}/n").collect()), key=lambda r: r[1])
    kinds = {t: plain("byte_bpe_50k.json", 2, t) for _, t in rows}
    assert sorted((str(i), n, c) for i, _, n, c in got) == sorted((str(i), len(kinds[t]), zlib.crc32(kinds[t].tobytes())) for i, t in rows)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]


def test_blocks_decode_in_any_task(spark, docs, tmp_path):
    ids = (np.random.default_rng(1).zipf(1.3, 2 * rans.BLOCK + 4000) % 50_000).astype("<u4")
    runs = rans.block_groups(rans.encode_segment(ids), 1)
    assert [a for a, _ in runs] == [0, rans.BLOCK, 2 * rans.BLOCK]
    assert (np.concatenate([rans.Segment(d).all_ids() for _, d in reversed(runs)][::-1]) == ids).all()
    path = default_path("byte_bpe_50k.json")
    rans.write_tokens(docs.coalesce(1), f"file://{tmp_path}/b", path, 2, segment=70_000)
    parts = {}
    for r in rans.read_blocks(spark, f"file://{tmp_path}/b", 1).collect():
        assert len(r.ids) == 4 * r.n_tokens
        parts[r.part, r.start] = r.ids
    whole = b"".join(parts[k] for k in sorted(parts))
    assert whole == b"".join(plain("byte_bpe_50k.json", 2, r.text).tobytes() for r in sorted(docs.collect(), key=lambda r: r.doc_id))


def test_pack(spark, docs):
    width = 256
    packed = pack.pack(docs, default_path("word_bpe_49k.json"), 1, width, 8, with_ids=True)
    rows = packed.collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
    want = []
    for r in docs.collect():
        ids = plain("word_bpe_49k.json", 1, r.text)
        want += [(r.doc_id, k, k * width, len(p := ids[k * width : (k + 1) * width]), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // width))]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    total = sum(r.length for r in rows)
    assert pack.sequences(packed).agg({"n_tokens": "sum"}).first()[0] == total
    assert len(bins) <= -(-total // width) + 40
    assert pack.pack(docs.limit(0), default_path("word_bpe_49k.json"), 1).count() == 0


def test_bins_left_open_by_many_tasks_are_packed_once_more(spark, monkeypatch):
    rows = [(i, " ".join(["word"] * (10 + i % 50))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(32)
    for few in (pack.TASKS, 4):
        monkeypatch.setattr(pack, "TASKS", few)
        packed = pack.pack(docs, default_path("word_bpe_49k.json"), 1, 1024).collect()
        assert len(packed) == 64
        total, bins = sum(r.length for r in packed), {}
        for r in packed:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert all(sum(n for _, n in sorted(parts)[:k]) == o for parts in bins.values() for k, (o, _) in enumerate(sorted(parts)))
        assert max(sum(n for _, n in parts) for parts in bins.values()) <= 1024
        assert len(bins) <= -(-total // 1024) + (1 if few > 4 else 8)


def slow_best_fit(lengths, width, most):
    """The rule, by looking at all bins: the tightest open bin that holds a length; of equal ones the one opened or filled last."""
    free, order, out, made, at = {}, [], [], 0, 0
    for n in lengths:
        at += 1
        fits = [b for b in free if free[b][0] >= n]
        if fits:
            b = min(fits, key=lambda b: (free[b][0], -free[b][1]))
        else:
            b, made = made, made + 1
            if n < width and len(free) >= most:
                del free[min(free, key=lambda b: (free[b][0], -free[b][1]))]
            free[b] = (width, at)
        out.append((b, width - free[b][0]))
        free[b] = (free[b][0] - n, at)
        if not free[b][0]:
            del free[b]
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_best_fit_equals_a_search_of_all_bins(most):
    lengths = np.random.default_rng(most).integers(1, 41, 500).tolist()
    bins = pack.BestFit(40, most)
    assert [bins.put(n) for n in lengths] == slow_best_fit(lengths, 40, most)


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = pack.BestFit(10, 2)
    assert [bins.put(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]  # 3 fits 7 exactly
    bins = pack.BestFit(10, 2)
    [bins.put(n) for n in (6, 7, 9)]  # the third closes bin 1, the fullest then
    assert bins.put(3) == (0, 6)


def test_exact_dedup(spark, docs):
    got = sorted(map(tuple, exact_dedup.groups(docs).collect()))
    by = {}
    for r in docs.collect():
        by.setdefault(r.text or "", []).append(r.doc_id)
    want = [(i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in by.items() for i in ids]
    assert got == sorted(want)
    kept = exact_dedup.distinct(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(ids) for ids in by.values())
    assert exact_dedup.groups(docs.limit(0)).count() == exact_dedup.distinct(docs.limit(0)).count() == 0


def test_hot_digests_are_salted_and_repeated_rows_have_a_rule(spark, monkeypatch):
    from tessera.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rows = [(i, "hot" if i % 3 else f"text {i % 40}", i % 7) for i in range(300)] + [(None, "hot", 0), (7000, "hot", 2), (7000, "hot", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest int")
    got = exact_dedup.groups(docs).collect()
    hot = [r for r in got if r.text_sha256 == hashlib.sha256(b"hot").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in hot} == {(7000, 203)} and len(got) == len(rows)
    kept = [exact_dedup.distinct(docs.repartition(n)).collect() for n in (1, 5)]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
    assert len([r for r in kept[0] if r.text == "hot"]) == 1
