import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import audio, warc
from tessera.session import materialize

TEXTS = [None, "", "short", "short", "é" * 288, "x" * 576, "x" * 577, "long text " * 20000]


def slow_adpcm(block):
    value, index, out = int(np.frombuffer(block[:2], "<i2")[0]), min(block[2], 88), []
    out.append(value)
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(audio.STEPS[index])
            diff = step >> 3
            if code & 1:
                diff += step >> 2
            if code & 2:
                diff += step >> 1
            if code & 4:
                diff += step
            value = max(-32768, min(32767, value - diff if code & 8 else value + diff))
            index = max(0, min(88, index + int(audio.INDEX[code & 7])))
            out.append(value)
    return out


def test_tables():
    assert audio.MULAW[0] == -32124 and audio.MULAW[127] == audio.MULAW[255] == 0 and audio.MULAW[128] == 32124
    assert audio.ALAW[0xD5] == 8 and audio.ALAW[0x55] == -8 and audio.ALAW[0x2A] == -32256 and audio.ALAW[0xAA] == 32256
    assert len(set(audio.ALAW.tolist())) == 256


def test_adpcm_equals_the_scalar_decoder():
    blocks = np.random.default_rng(1).integers(0, 256, (7, 60), np.uint8)
    blocks[:, 3] = 0
    assert [r.tolist() for r in audio.decode_adpcm(blocks)] == [slow_adpcm(b.tobytes()) for b in blocks]


def test_resampling():
    x = np.array([0, 100, -50], np.int16)
    assert audio.resample(x, 8000, 16000).tolist() == [0, 50, 100, 25, -50, -50]
    assert audio.resample(x, 8000, 8000).tolist() == x.tolist()
    assert len(audio.resample(np.arange(800, dtype=np.int16), 8000, 11025)) == 1102
    x = np.random.default_rng(3).integers(-32768, 32768, 999).astype(np.int16)  # one rule at all rates, halves to even
    placed = np.interp(np.arange(1998) / 2, np.arange(999), x)
    assert audio.resample(x, 8000, 16000).tolist() == np.round(placed).astype(np.int16).tolist()
    assert audio.resample(x[:0], 8000, 4000).tolist() == audio.resample(x[:0], 8000, 16000).tolist() == []


def test_downsampling_takes_out_what_the_lower_rate_cannot_hold():
    t = np.arange(8000) / 8000
    low, high = (np.round(10_000 * np.sin(2 * np.pi * f * t)).astype(np.int16) for f in (300, 3400))
    kept, gone = (audio.resample(x, 8000, 4000)[200:-200].astype(float) for x in (low, high))
    assert np.sqrt((kept**2).mean()) > 6900 and np.sqrt((gone**2).mean()) < 100


@pytest.mark.parametrize("codec", audio.CODECS)
def test_store_is_lossless(codec):
    payload = np.random.default_rng(2).integers(0, 256, 3 * audio.BLOCK, np.uint8).tobytes()
    assert audio.stored_payload(audio.store(payload, codec)) == payload


def test_media_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, b"m") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, media binary")
    media = materialize(audio.encode(docs), "media")
    got = {r.doc_id: r for r in audio.features(media).collect()}
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        padded = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
    assert got[2].feature == got[3].feature and got[2].media_sha256 == got[3].media_sha256
    assert {r.codec for r in got.values()} <= set(audio.CODECS)
    audio.store_pcm(media, f"file://{tmp_path}/pcm")
    stored = {r.doc_id: r.pcm for r in spark.read.parquet(f"file://{tmp_path}/pcm").collect()}
    assert f"crc={zlib.crc32(stored[7])}" in got[7].feature
    assert audio.features(audio.encode(docs.limit(0))).count() == 0


def test_the_query_stores_the_pcm_it_describes(spark, tmp_path, monkeypatch):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").write.parquet(f"file://{tmp_path}/in/documents.parquet")
    monkeypatch.setattr("tessera.session.scratch_root", lambda _: f"file://{tmp_path}/shared")
    got = {r.doc_id: r for r in audio.op5_telephony_audio(spark, f"file://{tmp_path}/in").collect()}
    stored = {r.doc_id: r for r in spark.read.parquet(f"file://{tmp_path}/shared/tessera/pcm-*").collect()}
    media = {r.doc_id: r.media for r in spark.read.parquet(f"file://{tmp_path}/shared/tessera/media-*").collect()}
    assert len(got) == len(stored) == len(media) == len(TEXTS)
    for i, r in got.items():
        (rate, samples), = audio.decode_all([media[i]])
        assert stored[i].rate == 16000 and stored[i].pcm == audio.resample(samples, rate, 16000).astype("<i2").tobytes()
        assert r.feature.endswith(f"crc={zlib.crc32(stored[i].pcm)}") and f":n={len(stored[i].pcm) // 2}:" in r.feature


def test_like_recordings_are_stored_side_by_side(spark):
    rows = [(i, None if i == 7 else f"{('ein', 'the')[i % 2]} text {i % 40}", ("de", "en")[i % 2]) for i in range(120)] + [(None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1)
    got = audio.encode(docs, like_column="lang").collect()
    langs = {i: lang for i, _, lang in rows}
    runs = [k for k, r in enumerate(got) if k == 0 or (audio.open_wav(r.media)[0], langs[r.doc_id]) != (audio.open_wav(got[k - 1].media)[0], langs[got[k - 1].doc_id])]
    assert len(runs) <= 7 and len(got) == 121  # three codecs by two languages, and the row without one
    small = audio.encode(docs, like_column="lang", lot=2000).collect()  # many lots, the same rows
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert sorted(small, key=key) == sorted(got, key=key) == sorted(audio.encode(docs).collect(), key=key)


def test_texts_of_one_style_are_stored_side_by_side(spark):
    assert [audio.style(t.encode()) for t in ("", "Plain text, é.", "LOUD!! TEXT!!!!", "a | b | c", "x" * 99 + "#", "x" * 40 + "#")] == [0, ord("P"), ord("!"), ord("|"), 0, ord("#")]
    kinds = ("{} plain text", "{} loud!!!! text!!!!", "{} cells | and | cells")
    rows = [(i, kinds[i % 3].format(chr(97 + i % 26) * (1 + i % 5))) for i in range(180)]
    got = audio.encode(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    runs = [k for k, r in enumerate(got) if k == 0 or (audio.open_wav(r.media)[0], r.doc_id % 3) != (audio.open_wav(got[k - 1].media)[0], got[k - 1].doc_id % 3)]
    assert len(got) == 180 and len(runs) <= 9  # three codecs by three styles


def test_the_pcm_of_adpcm_has_files_of_its_own_that_are_denser(spark, tmp_path):
    parts = np.array(["an", "er", "th", "tion", "ou", "re", "st", "le", " ", " the ", ". "])
    rng = np.random.default_rng(5)
    rows = [(i, "".join(rng.choice(parts, 900))) for i in range(150)]
    media = materialize(audio.encode(spark.createDataFrame([*rows, (None, None)], "doc_id bigint, text string").coalesce(1)), "media")
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    stored = audio.store_pcm(media, f"file://{tmp_path}/pcm")
    assert sorted(stored.collect(), key=key) == sorted(audio.expanded(media).collect(), key=key)  # no row is lost or doubled
    codecs = [{r.codec for r in spark.read.parquet(f"file://{f}").select("codec").distinct().collect()} for f in (tmp_path / "pcm").glob("*.parquet")]
    assert {"adpcm"} in codecs and not [c for c in codecs if "adpcm" in c and len(c) > 1]
    stored.where("codec = 'adpcm'").coalesce(1).write.options(**audio.COMPRESSION).parquet(f"file://{tmp_path}/before")
    size = lambda folder: sum(f.stat().st_size for f in folder.glob("*.parquet") if spark.read.parquet(f"file://{f}").where("codec = 'adpcm'").count())
    assert size(tmp_path / "pcm") < 0.97 * size(tmp_path / "before")


def test_headers_follow_the_standard(spark):
    big = "<p>" + "a" * 1000
    rows = [(1, "http://a/x y\r\nWARC-Type: bad", big), (2, "http://b/ü%20", big), (3, " ", "s" * 2_000_000), (4, "http://c", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    final = materialize(warc.deduplicate(materialize(warc.write_archives(pages), "warc")), "warc")
    found = {h["X-Page-ID"]: (h, p) for r in final.collect() for h, p in warc.records(bytes(r.data))}
    assert [found[k][0]["WARC-Target-URI"] for k in "1234"] == ["http://a/x%20y%0D%0AWARC-Type:%20bad", "http://b/%C3%BC%20", "urn:page:3", "http://c"]
    again, first = found["1"][0], found["2"][0]
    assert again["WARC-Type"] == "revisit" and found["1"][1] == b"" and again["WARC-Refers-To"] == first["WARC-Record-ID"]
    assert again["WARC-Refers-To-Target-URI"] == first["WARC-Target-URI"] and again["WARC-Refers-To-Date"] == first["WARC-Date"]
    assert found["2"][1] == big.encode() and len(found["3"][1]) == 2_000_000 and found["4"][1] == b""
    assert {h["Content-Type"] for h, _ in found.values()} == {"application/http;msgtype=response"}


def test_lists_of_revisits_beyond_the_broadcast(spark, monkeypatch):
    from tessera.operators import skew

    pages = spark.createDataFrame([(i, f"u{i}", "x" * 1200 if i % 3 else f"{i}" * 1200) for i in range(60)], "page_id bigint, url string, html string")
    crawl = warc.store_archives(warc.write_archives(pages.repartition(4), most=500), buckets=4)
    want = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_headers(warc.deduplicate(crawl)).collect())
    monkeypatch.setattr(warc, "SMALL_LIST", 0)
    plan = warc.deduplicate(crawl)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and not [x for x in plan.splitlines() if "Exchange" in x and "data" in x] and plan.count("Exchange") == 1  # the lists alone are dealt
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_headers(warc.deduplicate(crawl)).collect()) == want
    assert sum(w[1] == "revisit" for w in want) == 39


def test_the_whole_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    assert warc.op9_warc_revisits(spark, f"file://{tmp_path}").count() == 0


def test_archives(spark):
    big, other = "<p>" + "a" * 1000, "é" * 500
    rows = [(1, "http://a/ 1\n", big), (2, None, big), (3, "x", "small"), (4, "x", "small"), (5, "x", None), (6, "x", other), (7, "x", big), (7, "x", big), (8, "y", "WARC/1.1\r\n\r\n" * 300), (None, "z", big)]
    pages = spark.createDataFrame([(*r, "q") for r in rows], "page_id bigint, url string, html string, archive string").repartition(3)
    crawl = materialize(warc.write_archives(pages, most=700), "warc")
    final = materialize(warc.deduplicate(crawl), "warc")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.length, r.digest) for r in warc.read_headers(final, check=True).collect()), key=str)
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        again = html == big and page_id in (1, 2)
        want.append((page_id, "revisit" if again else "response", 7 if again else None, len(raw), hashlib.sha1(raw).hexdigest()))
    assert got == sorted(want, key=str)
    again = materialize(warc.deduplicate(final), "warc")  # revisits stay what they are
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.read_headers(again).collect()), key=str) == [w[:3] for w in sorted(want, key=str)]
    assert warc.write_archives(pages.limit(0)).count() == 0
    assert warc.deduplicate(materialize(warc.write_archives(pages.filter("false")), "warc")).count() == 0
