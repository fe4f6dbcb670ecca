"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV containers, expanded and resampled.

mu-law and A-law are expanded by 256-entry tables built from their rules; IMA ADPCM
blocks (4 header bytes, then two 4-bit codes a byte, low one first) are decoded one
step at a time for all blocks of a batch together, across recordings.

``store`` puts a payload into a WAV without loss: as the samples of a companded file,
or as the code bytes of ADPCM blocks of BLOCK data bytes. ``expanded`` reads the
stored bytes back, decodes and resamples to 16-bit PCM, ``store_pcm`` stores that,
and ``pcm_features`` describes it.

Edge cases: null and empty texts are one block of padding; payloads are padded with
bytes 255 to a positive multiple of BLOCK; recordings of any length, also empty ones, are decoded whole;
repeated rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import named, small_batches, table
from tessera.session import scratch_path

BLOCK, RATE, TARGET = 576, 8000, 16000
#: WAV format tags.
TAGS = {"alaw": 6, "mulaw": 7, "adpcm": 17}
#: Fixed value of the format: the change of the step index for each code's three low bits.
INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def mulaw_table() -> np.ndarray:
    """ITU-T G.711 mu-law bytes to 16-bit samples."""
    u = ~np.arange(256, dtype=np.int32) & 255
    size = ((((u & 15) << 3) + 132) << (u >> 4 & 7)) - 132
    return np.where(u & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """ITU-T G.711 A-law bytes to 16-bit samples."""
    a = np.arange(256, dtype=np.int32) ^ 0x55
    part, low = a >> 4 & 7, (a & 15) << 4
    size = np.where(part == 0, low + 8, (low + 264) << np.maximum(part - 1, 0))
    return np.where(a & 128, size, -size).astype(np.int16)


def step_table() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM."""
    # fixed values of the format
    return np.array(
        [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
        np.int32,
    )


MULAW, ALAW, STEPS = mulaw_table(), alaw_table(), step_table()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """(blocks, 4 + n) bytes to (blocks, 1 + 2n) 16-bit samples, all blocks a step at a time."""
    blocks = np.ascontiguousarray(blocks, np.uint8)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2").astype(np.int32)[:, 0]
    index = np.minimum(blocks[:, 2].astype(np.int32), 88)
    codes = np.empty((2 * (blocks.shape[1] - 4), len(blocks)), np.uint8)
    codes[0::2], codes[1::2] = (blocks[:, 4:] & 15).T, (blocks[:, 4:] >> 4).T
    # change of the value for each step index and code
    code = np.arange(16)
    part = (STEPS[:, None] >> 3) + np.where(code & 4, STEPS[:, None], 0) + np.where(code & 2, STEPS[:, None] >> 1, 0) + np.where(code & 1, STEPS[:, None] >> 2, 0)
    change = np.where(code & 8, -part, part).astype(np.int32).ravel()
    after = np.clip(np.arange(89)[:, None] + INDEX[code & 7], 0, 88).astype(np.int32).ravel()
    out = np.empty((1 + len(codes), len(blocks)), np.int16)
    out[0] = value
    for k, c in enumerate(codes):
        at = index * 16 + c
        value = np.clip(value + change[at], -32768, 32767)
        index = after[at]
        out[k + 1] = value
    return out.T


def low_passed(samples: np.ndarray, share: float, half: int = 16) -> np.ndarray:
    """Samples without what lies above ``share`` of their own band: a sinc in a Hann window, ``half`` zeros to a side."""
    reach = int(np.ceil(half / share))
    at = np.arange(-reach, reach + 1)
    taps = np.sinc(at * share) * np.hanning(2 * reach + 3)[1:-1]
    wide = np.pad(samples.astype(np.float64), reach, mode="edge")
    return np.convolve(wide, taps / taps.sum(), "valid")


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation on the target's grid, rounded to 16-bit with halves to even; to a lower rate after a low-pass."""
    n = len(samples) * target // rate
    if target == 2 * rate:  # the usual case, without a search
        wide = samples.astype(np.int32)
        both = wide + np.append(wide[1:], wide[-1:])
        out = np.empty(n, np.int16)
        out[0::2] = wide
        out[1::2] = (both >> 1) + (both & both >> 1 & 1)
        return out
    if target < rate and len(samples):
        samples = low_passed(samples, target / rate)
    placed = np.interp(np.arange(n) * (rate / target), np.arange(len(samples)), samples) if n else np.zeros(0)
    return np.clip(np.round(placed), -32768, 32767).astype(np.int16)


def wav(codec: str, data: bytes, rate: int = RATE, align: int = 1) -> bytes:
    """A WAV file around coded mono samples."""
    if codec == "adpcm":
        per = (align - 4) * 2 + 1
        form = struct.pack("<HHIIHHHH", 17, 1, rate, rate * align // per, align, 4, 2, per)
    else:
        form = struct.pack("<HHIIHHH", TAGS[codec], 1, rate, rate, 1, 8, 0)
    body = b"fmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def open_wav(media: bytes) -> tuple[str, int, int, bytes]:
    """codec, rate, bytes a block, coded samples."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, found = 12, {}
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        found.setdefault(media[at : at + 4], media[at + 8 : at + 8 + size])
        at += 8 + size + size % 2
    tag, _, rate, _, align = struct.unpack_from("<HHIIH", found[b"fmt "])
    return {v: k for k, v in TAGS.items()}[tag], rate, align, found[b"data"]


def store(payload: bytes, codec: str) -> bytes:
    """A payload of whole blocks as a WAV; ADPCM blocks start at value 0 and step index 0."""
    if codec != "adpcm":
        return wav(codec, payload)
    blocks = np.zeros((len(payload) // BLOCK, BLOCK + 4), np.uint8)
    blocks[:, 4:] = np.frombuffer(payload, np.uint8).reshape(-1, BLOCK)
    return wav(codec, blocks.tobytes(), align=BLOCK + 4)


def stored_payload(media: bytes) -> bytes:
    """The payload that ``store`` put in."""
    codec, _, align, data = open_wav(media)
    return data if codec != "adpcm" else np.frombuffer(data, np.uint8).reshape(-1, align)[:, 4:].tobytes()


def decode_all(medias: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """(rate, 16-bit samples) of each WAV; ADPCM blocks of equal size are decoded together."""
    out: list = [None] * len(medias)
    waiting: dict[int, list] = {}
    for i, media in enumerate(medias):
        codec, rate, align, data = open_wav(media)
        if codec == "adpcm":
            waiting.setdefault(align, []).append((i, rate, np.frombuffer(data, np.uint8).reshape(-1, align)))
        else:
            out[i] = rate, (MULAW if codec == "mulaw" else ALAW)[np.frombuffer(data, np.uint8)]
    for group in waiting.values():
        cut = np.concatenate([b for _, _, b in group])
        done = np.concatenate([decode_adpcm(cut[a : a + 4096]) for a in range(0, len(cut), 4096)])
        at = 0
        for i, rate, blocks in group:
            out[i] = rate, done[at : at + len(blocks)].ravel()
            at += len(blocks)
    return out


def described(pcm: bytes, target: int = TARGET) -> str:
    """A feature text of resampled PCM."""
    samples = np.frombuffer(pcm, "<i2")
    wide = samples.astype(np.int64)
    crossings = int(np.count_nonzero(np.diff(np.signbit(samples))))
    return f"pcm16:{target}:n={len(samples)}:rms={np.sqrt(float(wide @ wide) / len(samples)):.2f}:peak={int(np.abs(wide).max())}:zc={crossings}:crc={zlib.crc32(pcm)}"


CODECS = ("mulaw", "alaw", "adpcm")


def _spans(sizes, most: int = 4_000_000):
    """(from, to) of runs of rows of about ``most`` bytes together."""
    at = 0
    while at < len(sizes):
        upto, total = at, 0
        while upto < len(sizes) and (upto == at or total + sizes[upto] <= most):
            total += sizes[upto]
            upto += 1
        yield at, upto
        at = upto


def _by_bytes(stream, column: str, most: int = 4_000_000):
    """Slices of batches of about ``most`` bytes of a column."""
    import pyarrow.compute as pc

    for batch in stream:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for at, upto in _spans(sizes, most):
            yield batch.slice(at, upto - at)


#: Bytes of text that a task holds to put like recordings side by side.
LOT = 128_000_000
#: Bytes that most texts have: small letters, blanks, stops, and all beyond ASCII.
PLAIN = np.array([b > 127 or chr(b) in "abcdefghijklmnopqrstuvwxyz \n.," for b in range(256)])


def style(raw: bytes) -> int:
    """The most frequent capital, digit or sign of a text, if it is more than a fiftieth of its bytes; else 0."""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    counts[PLAIN] = 0
    top = int(counts.argmax())
    return top if 50 * counts[top] > len(raw) else 0


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", like_column: str | None = None, lot: int = LOT) -> DataFrame:
    """doc_id, n_bytes, media: each text's padded UTF-8 bytes as a WAV, its codec chosen by the bytes' crc32.

    Rows come by codec, ``like_column`` (such as the language; it changes no value), ``style`` and bytes within about
    ``lot`` bytes of text, so that what is alike is stored side by side and files compress better.
    """
    def run(stream):
        import pyarrow as pa

        def made(rows):
            rows.sort(key=lambda row: row[:4])
            for at, upto in _spans([len(row[3]) for row in rows]):
                cut = rows[at:upto]
                media = [store(raw, CODECS[code]) for code, _, _, raw, _, _ in cut]
                yield pa.RecordBatch.from_arrays([pa.array([r[5] for r in cut], pa.int64()), pa.array([r[4] for r in cut], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

        held, size = [], 0
        for batch in _by_bytes(stream, "text"):
            for key, text, like in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "like")]):
                raw = (text or "").encode()
                n, kind = len(raw), style(raw)
                raw += b"\xff" * (-n % BLOCK or BLOCK * (not n))
                held.append((zlib.crc32(raw) % 3, like or "", kind, raw, n, key))
                size += len(raw)
            if size >= lot:
                yield from made(held)
                held, size = [], 0
        yield from made(held)

    own = named(docs, doc_id=id_column, text=text_column, **({"like": like_column} if like_column else {}))
    own = own.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn("like", F.col("like").cast("string") if like_column else F.lit(None).cast("string"))
    return own.mapInArrow(run, "doc_id bigint, n_bytes bigint, media binary")


PAYLOAD = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, codec string"
FEATURES = f"{PAYLOAD}, feature string"
#: Of the stored files: the PCM is several times the payload, but tells no more. Pages hold many recordings that are alike.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "12", "parquet.page.size": str(16 << 20)}
#: Of the PCM of ADPCM: the longest of all, and the one that a further search shortens most for its time.
DENSE = COMPRESSION | {"parquet.compression.codec.zstd.level": "13"}
#: Of the media: row groups of about two pages (one being filled, one compressed), so that many tasks expand them.
SHORT_GROUPS = COMPRESSION | {"parquet.block.size": str(20 << 20)}


def in_splits(spark, size: str):
    """A session over the same context that reads files in splits of at most ``size``; the caller's settings stay as they are."""
    reading = spark.newSession()
    reading.conf.set("spark.sql.files.maxPartitionBytes", size)
    return reading


def expanded(media: DataFrame, target: int = TARGET) -> DataFrame:
    """Read stored media back: payload digests, the sample rate and the resampled 16-bit PCM."""
    def run(stream):
        import pyarrow as pa

        for batch in _by_bytes(stream, "media", 1_000_000):
            files, rows = batch.column("media").to_pylist(), []
            for file, (rate, samples) in zip(files, decode_all(files)):
                payload = stored_payload(file)
                pcm = resample(samples, rate, target).astype("<i2").tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(file), hashlib.sha256(file).hexdigest(), open_wav(file)[0], target, pcm))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary()]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "codec", "rate", "pcm"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=["doc_id", "n_bytes", *names])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"{PAYLOAD}, rate int, pcm binary")


def pcm_features(pcm: DataFrame) -> DataFrame:
    """The columns of ``expanded`` with the PCM described instead of given."""
    kept = [c.split()[0] for c in PAYLOAD.split(", ")]

    def run(stream):
        import pyarrow as pa

        for batch in _by_bytes(stream, "pcm"):
            texts = [described(p, rate) for p, rate in zip(batch.column("pcm").to_pylist(), batch.column("rate").to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, "feature"])

    return pcm.select(*kept, "rate", "pcm").mapInArrow(run, FEATURES)


def features(media: DataFrame, target: int = TARGET) -> DataFrame:
    """Payload digests of stored media, and features of the resampled PCM, which is not kept."""
    return pcm_features(expanded(media, target))


def store_pcm(media: DataFrame, path: str, target: int = TARGET) -> DataFrame:
    """Write the columns of ``expanded`` to Parquet, those of ADPCM to files of their own, and read them back."""
    # the tag in files of ``wav``; others are whole as well, in either half
    adpcm = F.substring("media", 21, 2).eqNullSafe(F.lit(struct.pack("<H", TAGS["adpcm"])))
    for rows, options, mode in ((media.where(~adpcm), COMPRESSION, "error"), (media.where(adpcm), DENSE, "append")):
        pcm = expanded(rows, target)
        pcm.write.options(**options).mode(mode).parquet(path)
    return small_batches(media.sparkSession).read.schema(pcm.schema).parquet(path)


def op5_telephony_audio(spark, sf_dir: str) -> DataFrame:
    """Store all texts of ``documents`` as telephony audio, store the resampled PCM of that, and describe what was stored."""
    docs, path = table(in_splits(spark, "128m"), sf_dir, "documents"), scratch_path(spark, "media")  # a task reads about a lot; small tables still go to all cores
    made = encode(docs, like_column="lang" if "lang" in docs.columns else None)
    made.write.options(**SHORT_GROUPS).parquet(path)
    media = in_splits(spark, "8m").read.schema(made.schema).parquet(path)  # about a row group a task
    return pcm_features(store_pcm(media, scratch_path(spark, "pcm")))


QUERIES = {"op5_telephony_audio": op5_telephony_audio}
ORACLE: dict[str, str] = {}
