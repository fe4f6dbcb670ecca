"""Token ids in a binary format coded by static range asymmetric numeral systems (rANS).

A *segment* is a run of documents in ascending id order, up to ``SEGMENT``
tokens. It holds one frequency table, shared by all its blocks, and blocks of
``BLOCK`` tokens. Blocks are independent: each has its own ``LANES`` interleaved
states, words, crc32 and, every ``STRIDE`` steps, a checkpoint (all states and the
word position) from which decoding may start. Token i of a block belongs to lane
i mod LANES. All blocks of a group and all their lanes advance together in numpy.

Layout (little endian): ``HEAD``; zlib-packed table (uint32 ids, uint32
frequencies that sum to 2**bits); one ``ENTRY`` a block; block bodies. A body is
the LANES uint64 states, the checkpoints (uint32 word position and LANES uint64
states each), and the uint32 words in reading order.

Edge cases: a null text counts as empty; an empty text is its end id alone; a
null doc_id sorts first; rows with equal ids stay next to each other, ordered by
text; an empty table gives no segments; columns other than the two named are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import named, small_batches, table
from tessera.llm.tokens import default_path, tokenizer
from tessera.session import materialize, scratch_path

BLOCK, LANES, STRIDE, SEGMENT, GROUP = 1 << 16, 64, 256, 1 << 22, 32
HEAD = struct.Struct("<4sBBHIQIII")  # magic, version, bits, lanes, block tokens, tokens, blocks, table bytes, table crc
ENTRY = struct.Struct("<QIIII")  # place of the body, tokens, words, checkpoints, crc32 of the ids
LOW = np.uint64(1 << 31)


def quantised(counts: np.ndarray, bits: int) -> np.ndarray:
    """Positive counts to positive integers that sum to 2**bits."""
    total = 1 << bits
    freq = np.maximum(1, counts * (total / counts.sum())).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    gap = total - int(freq.sum())
    if gap > 0:
        freq[order[0]] += gap
    while gap < 0:
        can = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * -gap // total))
        take = np.minimum(can, np.maximum(0, -gap - np.concatenate([[0], np.cumsum(can)[:-1]])))
        freq[order] -= take
        gap += int(take.sum())
    return freq


def _encode_blocks(symbols: np.ndarray, freq: np.ndarray, base: np.ndarray, bits: int):
    """(steps, blocks, LANES) table indices to final states, checkpoints, words and their marks."""
    steps, blocks, lanes = symbols.shape
    shift, room = np.uint64(bits), np.uint64(63 - bits)
    x = np.full((blocks, lanes), LOW)
    words = np.empty(symbols.shape, np.uint32)
    marks = np.empty(symbols.shape, bool)
    saved = []
    for t in range(steps - 1, -1, -1):
        f, c = freq[symbols[t]], base[symbols[t]]
        full = x >= (f << room)
        words[t], marks[t] = x, full
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = (q << shift) + (x - q * f) + c
        if t and t % STRIDE == 0:
            saved.append((t, x.copy()))
    return x, saved[::-1], words, marks


def encode_segment(ids: np.ndarray) -> bytes:
    """uint32 ids to one segment."""
    ids = np.ascontiguousarray(ids, "<u4")
    counts = np.bincount(ids)
    known = np.flatnonzero(counts)
    index = np.zeros(len(counts), np.int32)
    index[known] = np.arange(len(known))
    index, counts = index[ids], counts[known]
    bits = max(16, int(len(known)).bit_length() + 4)
    freq = quantised(counts, bits) if len(known) else np.zeros(0, np.int64)
    packed = zlib.compress(known.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    f64 = freq.astype(np.uint64)
    c64 = np.cumsum(f64, dtype=np.uint64) - f64
    pad = int(np.argmax(freq)) if len(known) else 0
    full, bodies, entries = len(ids) // BLOCK, [], []
    cuts = [(a, min(GROUP, full - a), BLOCK) for a in range(0, full, GROUP)]
    if len(ids) % BLOCK:
        cuts.append((full, 1, len(ids) % BLOCK))
    for first, blocks, size in cuts:
        steps = -(-size // LANES)
        part = np.full((blocks, steps * LANES), pad, np.int32)
        part[:, :size] = index[first * BLOCK : first * BLOCK + blocks * size].reshape(blocks, size)
        symbols = np.ascontiguousarray(part.reshape(blocks, steps, LANES).transpose(1, 0, 2))
        x, saved, words, marks = _encode_blocks(symbols, f64, c64, bits)
        per_step = np.cumsum(marks.sum(axis=2), axis=0)
        for b in range(blocks):
            own = words[:, b][marks[:, b]]
            body = [x[b].astype("<u8").tobytes()]
            for t, states in saved:
                body.append(struct.pack("<I", int(per_step[t - 1, b])) + states[b].astype("<u8").tobytes())
            body.append(own.astype("<u4").tobytes())
            at = (first + b) * BLOCK
            entries.append((size, len(own), len(saved), zlib.crc32(ids[at : at + size].tobytes())))
            bodies.append(b"".join(body))
    place = HEAD.size + len(packed) + ENTRY.size * len(entries)
    out = [HEAD.pack(b"RANS", 1, bits, LANES, BLOCK, len(ids), len(entries), len(packed), zlib.crc32(packed)), packed]
    for entry, body in zip(entries, bodies):
        out.append(ENTRY.pack(place, *entry))
        place += len(body)
    return b"".join(out + bodies)


class Segment:
    """A segment opened for reading. Blocks decode in any order; a wrong checksum raises ValueError."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.lanes, self.block, self.tokens, count, packed, crc = HEAD.unpack_from(data)
        if magic != b"RANS" or version != 1:
            raise ValueError("not a token segment")
        at = HEAD.size
        if zlib.crc32(data[at : at + packed]) != crc:
            raise ValueError("the frequency table is damaged")
        both = np.frombuffer(zlib.decompress(data[at : at + packed]), "<u4")
        self.ids, freq = both[: len(both) // 2], both[len(both) // 2 :]
        self.freq = freq.astype(np.uint64)
        self.base = np.cumsum(self.freq, dtype=np.uint64) - self.freq
        self.slots = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
        self.entries = [ENTRY.unpack_from(data, at + packed + i * ENTRY.size) for i in range(count)]
        self.data = data

    def _run(self, numbers: list[int], checkpoint: int) -> np.ndarray:
        """(blocks, tokens) ids of blocks of one size, from a checkpoint on (0: the start)."""
        size, mark = self.entries[numbers[0]][1], checkpoint * STRIDE
        steps = -(-size // self.lanes)
        wide = max(self.entries[n][2] for n in numbers) + self.lanes
        words = np.zeros((len(numbers), wide), np.uint64)
        x = np.empty((len(numbers), self.lanes), np.uint64)
        at = np.zeros(len(numbers), np.int64)
        for k, n in enumerate(numbers):
            place, _, count, saved, _ = self.entries[n]
            after = place + 8 * self.lanes + saved * (4 + 8 * self.lanes)
            words[k, :count] = np.frombuffer(self.data, "<u4", count, after)
            start = place
            if checkpoint:
                start = place + 8 * self.lanes + (checkpoint - 1) * (4 + 8 * self.lanes)
                at[k] = struct.unpack_from("<I", self.data, start)[0]
                start += 4
            x[k] = np.frombuffer(self.data, "<u8", self.lanes, start)
        mask, shift = np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        flat, rows = words.ravel(), np.arange(len(numbers)) * wide
        out = np.empty((steps - mark, len(numbers), self.lanes), np.int32)
        for t in range(steps - mark):
            slot = x & mask
            s = self.slots[slot]
            out[t] = s
            x = self.freq[s] * (x >> shift) + slot - self.base[s]
            need = x < LOW
            order = np.cumsum(need, axis=1)
            fresh = flat[(rows + at)[:, None] + order - 1]
            x = np.where(need, (x << np.uint64(32)) | fresh, x)
            at += order[:, -1]
        return self.ids[out.transpose(1, 0, 2).reshape(len(numbers), -1)[:, : size - mark * self.lanes]]

    def block_ids(self, number: int, checkpoint: int = 0) -> np.ndarray:
        """Ids of one block, or of its rest from a checkpoint on."""
        return self._run([number], checkpoint)[0]

    def all_ids(self) -> np.ndarray:
        """All ids, checked block by block."""
        out = np.empty(self.tokens, "<u4")
        full = [n for n, e in enumerate(self.entries) if e[1] == self.block]
        groups = [full[a : a + GROUP] for a in range(0, len(full), GROUP)] + [[n] for n, e in enumerate(self.entries) if e[1] != self.block]
        for numbers in groups:
            for n, ids in zip(numbers, self._run(numbers, 0)):
                if zlib.crc32(ids.astype("<u4").tobytes()) != self.entries[n][4]:
                    raise ValueError(f"block {n} is damaged")
                out[n * self.block : n * self.block + len(ids)] = ids
        return out


def block_groups(data: bytes, blocks: int) -> list[tuple[int, bytes]]:
    """(first token, segment) for each run of ``blocks`` blocks: a segment of its own, with the same table, that any task can decode."""
    whole = Segment(data)
    packed, crc = HEAD.unpack_from(data)[7:]
    table_ = data[HEAD.size : HEAD.size + packed]
    ends = [e[0] for e in whole.entries[1:]] + [len(data)]
    out = []
    for a in range(0, len(whole.entries), blocks):
        own, place = whole.entries[a : a + blocks], HEAD.size + packed + ENTRY.size * len(whole.entries[a : a + blocks])
        head = HEAD.pack(b"RANS", 1, whole.bits, whole.lanes, whole.block, sum(e[1] for e in own), len(own), packed, crc)
        shifted = b"".join(ENTRY.pack(e[0] - own[0][0] + place, *e[1:]) for e in own)
        out.append((a * whole.block, head + table_ + shifted + data[own[0][0] : ends[a + len(own) - 1]]))
    return out


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the crc32 polynomial, bits reflected."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


def shifted_crc(crc: int, after: int) -> int:
    """A piece's share in the crc32 of a whole that has ``after`` bytes behind the piece; shares are xored."""
    power, square = 1 << 31, 1 << 23  # x**0 and x**8
    while after:
        if after & 1:
            power = _times(power, square)
        square, after = _times(square, square), after >> 1
    return _times(power, crc)


#: Rows of one id beyond which they are dealt over several ranges.
SAME_ID = 1000
SEGMENTS = "part int, start bigint, n_tokens bigint, payload binary, doc_ids array<bigint>, doc_starts array<bigint>, doc_tokens array<bigint>, doc_befores array<bigint>"


def _segments(path: str, end_id: int, most: int):
    def run(stream):
        import pyarrow as pa
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), tokenizer(path, True)
        end, done = np.array([end_id], "<u4").tobytes(), 0
        held, index, size = [], [], 0

        def cut():
            data = encode_segment(np.frombuffer(b"".join(held), "<u4"))
            columns = zip(*index)
            row = [[part], [done], [size], [data], *[[list(c)] for c in columns]]
            names = ["part", "start", "n_tokens", "payload", "doc_ids", "doc_starts", "doc_tokens", "doc_befores"]
            longs = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), longs, longs, longs, longs]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

        for batch in stream:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.batches(batch.column("text"))):
                ids += end
                total, before = len(ids) // 4, 0
                while before < total:
                    take = min(total - before, most - size)
                    held.append(ids[4 * before : 4 * (before + take)])
                    index.append((doc_id, size, total, before))
                    size, before = size + take, before + take
                    if size == most:
                        yield cut()
                        done, held, index, size = done + size, [], [], 0
        if size:
            yield cut()

    return run


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", segment: int = SEGMENT) -> None:
    """Write all texts' ids, each followed by ``end_id``, as segments in ascending id order to a Parquet folder.

    One range exchange on the id puts the order; a worker holds one segment at a time. Rows of an id that
    very many rows share (or of no id) are dealt over several ranges by their text's hash and a number, and stay together.
    """
    rows = named(docs, doc_id=id_column, text=text_column)
    order = [F.col("doc_id")]
    if (rows.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0) > SAME_ID:
        rows = rows.withColumns({"hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
        order += [F.col("hash"), F.col("number")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, *([] if len(order) > 1 else ["text"])).select("doc_id", "text")
    # payloads are random bits: packing or indexing them again only costs time
    ordered.mapInArrow(_segments(tokenizer_path, end_id, segment), SEGMENTS).write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(out)


def _read(stream):
    import pyarrow as pa

    for batch in stream:
        for row in batch.to_pylist():
            data = Segment(row["payload"]).all_ids().tobytes()
            starts, totals, befores = row["doc_starts"], row["doc_tokens"], row["doc_befores"]
            sizes = [b - a for a, b in zip(starts, starts[1:] + [row["n_tokens"]])]
            crcs = [zlib.crc32(data[4 * s : 4 * (s + n)]) for s, n in zip(starts, sizes)]
            crcs = [c if b + n == t else shifted_crc(c, 4 * (t - b - n)) for c, b, n, t in zip(crcs, befores, sizes, totals)]
            columns = [[row["part"]] * len(starts), row["doc_ids"], [row["start"] + s - b for s, b in zip(starts, befores)], totals, befores, sizes, crcs]
            kinds = [pa.int32(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "doc_id", "start", "n_tokens", "before", "size", "crc"])


def read_index(spark, path: str) -> DataFrame:
    """Decode every segment under ``path``: doc_id, start, n_tokens, ids_crc32, in no order.

    The table of parts has one row for each task that wrote; a document cut by a
    segment's end is put together by xor of its pieces' crc shares.
    """
    stored = small_batches(spark).read.schema(SEGMENTS).parquet(path)
    pieces = stored.mapInArrow(_read, "part int, doc_id bigint, start bigint, n_tokens bigint, before bigint, size bigint, crc bigint")
    pieces = spark.read.schema(pieces.schema).parquet(materialize(pieces, "rans-index")._scratch)  # read twice below; decoded once
    parts = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    bases, total = [], 0
    for part, n in parts:
        bases.append((part, total))
        total += n
    based = pieces.join(F.broadcast(spark.createDataFrame(bases, "part int, base bigint")), "part")
    based = based.withColumn("start", F.col("start") + F.col("base"))
    whole = based.filter("size = n_tokens").select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    cut = based.filter("size < n_tokens").groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"))
    return whole.union(cut)


def read_blocks(spark, path: str, blocks: int = 8) -> DataFrame:
    """Decode by runs of blocks, each in any task: part, start (of the run in its part), n_tokens, ids (uint32, little endian).

    For few large segments on many executors: a segment's blocks are dealt out, coded, and decoded apart.
    """
    def cut(stream):
        import pyarrow as pa

        for batch in stream:
            for row in batch.select(["part", "start", "payload"]).to_pylist():
                runs = block_groups(row["payload"], blocks)
                columns = [pa.array([row["part"]] * len(runs), pa.int32()), pa.array([row["start"] + a for a, _ in runs], pa.int64()), pa.array([d for _, d in runs], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "start", "payload"])

    def decode(stream):
        import pyarrow as pa

        for batch in stream:
            for i in range(batch.num_rows):
                ids = Segment(batch.column("payload")[i].as_py()).all_ids()
                yield pa.RecordBatch.from_arrays([batch.column("part").slice(i, 1), batch.column("start").slice(i, 1), pa.array([len(ids)], pa.int64()), pa.array([ids.tobytes()], pa.binary())], names=["part", "start", "n_tokens", "ids"])

    runs = small_batches(spark).read.schema(SEGMENTS).parquet(path).mapInArrow(cut, "part int, start bigint, payload binary")
    return runs.repartition("part", "start").mapInArrow(decode, "part int, start bigint, n_tokens bigint, ids binary")


def op1_token_ids_rans(spark, sf_dir: str) -> DataFrame:
    """Encode ``documents``, write the segments, read them back."""
    out = scratch_path(spark, "rans")
    write_tokens(table(spark, sf_dir, "documents"), out, default_path("byte_bpe_50k.json"), 2)
    return read_index(spark, out)


QUERIES = {"op1_token_ids_rans": op1_token_ids_rans}
ORACLE: dict[str, str] = {}
