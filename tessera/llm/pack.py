"""Best-fit packing of token sequences with a bounded number of open bins.

Online: a piece goes to the open bin with the least free space that holds it. The
open bins are kept as stacks by free space, and a bitset (one Python integer) marks
which free spaces have a bin, so the best fit is one shift and one lowest-bit
search. With ``open_bins`` open, a new bin closes the fullest open one. Each Arrow
batch is offered longest piece first. Texts never leave their task, and memory is
the open bins alone.

Bins that a task leaves open with a share of SPARE or more free are packed once more, whole, as if each
were a piece, TASKS tasks' bins at a time: so tables of many small partitions do not end
in one part-filled sequence each. Only the bins' lengths move.

A document's ids and its end id are cut into pieces of ``width`` only if they are
longer; the last piece may be shorter. Edge cases: null text counts as empty (one
piece, the end id); repeated rows are packed as often as they occur; an empty table
gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import named, slices, table
from tessera.llm.tokens import default_path, tokenizer
from tessera.session import materialize

OPEN_BINS, SPARE, TASKS = 4096, 1 / 64, 256
#: Moved bins up to which their list is sent to every executor; beyond it, a shuffled join.
SMALL_LIST = 200_000


class BestFit:
    """Places lengths; ``put`` gives (bin number, offset)."""

    def __init__(self, width: int, open_bins: int = OPEN_BINS):
        self.width, self.most = width, open_bins
        self.bits = 0  # bit f is set if an open bin has f free
        self.stacks: list[list[int]] = [[] for _ in range(width + 1)]
        self.open = self.made = 0

    def _pop(self, free: int) -> int:
        stack = self.stacks[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            number = self._pop(free)
        else:
            free, number = self.width, self.made
            self.made += 1
            if length < free and self.open >= self.most:
                self._pop((self.bits & -self.bits).bit_length() - 1)  # the fullest
        rest = free - length
        if rest:
            self.stacks[rest].append(number)
            self.bits |= 1 << rest
            self.open += 1
        return number, self.width - free


PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def _packer(path: str, end_id: int, width: int, open_bins: int, with_ids: bool):
    def run(stream):
        import pyarrow as pa
        from pyspark import TaskContext

        bins, encode = BestFit(width, open_bins), tokenizer(path, False)
        base, end = TaskContext.get().partitionId() << 40, np.array([end_id], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5] + [pa.binary()] * with_ids
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
        for batch in slices(stream, 10_000):
            pieces = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.batches(batch.column("text"))):
                ids += end
                for k in range(0, len(ids), 4 * width):
                    part = ids[k : k + 4 * width]
                    row = (doc_id, k // (4 * width), k // 4, len(part) // 4, zlib.crc32(part))
                    pieces.append((*row, part) if with_ids else row)
            pieces.sort(key=lambda p: -p[3])
            placed = [bins.put(p[3]) for p in pieces]
            columns = list(zip(*pieces))
            columns[5:5] = [[base + n for n, _ in placed], [o for _, o in placed]]
            if pieces:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        # a row without a piece for each bin that another one's content may fit in
        left = [(base + n, width - f) for f in range(max(1, int(SPARE * width)), width) for n in bins.stacks[f]]
        if left:
            empty = {"sequence_id": [n for n, _ in left], "length": [n for _, n in left]}
            yield pa.RecordBatch.from_arrays([pa.array(empty.get(c, [None] * len(left)), k) for c, k in zip(names, kinds)], names=names)

    return run


def _moved(left: DataFrame, width: int, open_bins: int) -> DataFrame:
    """(sequence_id, into, shift): bins (sequence_id, length) put behind others, longest first; those that stay are left out."""
    def run(rows):
        import pandas as pd

        rows, bins, first, out = rows.sort_values(["length", "sequence_id"], ascending=[False, True]), BestFit(width, open_bins), {}, []
        for own, length in zip(rows.sequence_id.tolist(), rows.length.tolist()):
            number, shift = bins.put(length)
            if first.setdefault(number, own) != own:
                out.append((own, first[number], shift))
        return pd.DataFrame(out, columns=["sequence_id", "into", "shift"]).astype("int64")

    few = F.floor(F.shiftright("sequence_id", 40) / TASKS).alias("few")
    return left.select("sequence_id", "length", few).groupBy("few").applyInPandas(lambda rows: run(rows), "sequence_id bigint, into bigint, shift bigint")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 4096, open_bins: int = OPEN_BINS, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; ``with_ids`` adds the ids (uint32, little endian)."""
    rows = named(docs, doc_id=id_column, text=text_column)
    placed = materialize(rows.mapInArrow(_packer(tokenizer_path, end_id, width, open_bins, with_ids), PACKED + ", ids binary" * with_ids), "packed")
    moved = materialize(_moved(placed.filter("piece is null"), width, open_bins), "packed-moved")
    if moved.count() <= SMALL_LIST:
        moved = F.broadcast(moved)
    both = placed.filter("piece is not null").join(moved, "sequence_id", "left")
    new = {"sequence_id": F.coalesce("into", "sequence_id"), "offset": F.col("offset") + F.coalesce("shift", F.lit(0))}
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in placed.columns])


def sequences(packed: DataFrame) -> DataFrame:
    """Assemble pieces with ids into sequence_id, n_tokens, ids (array of int). A group holds at most ``width`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return grouped.select("sequence_id", "n_tokens", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))


def op2_pack_best_fit(spark, sf_dir: str) -> DataFrame:
    """Pack all of ``documents`` into sequences of 4096."""
    return pack(table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"), 1)


QUERIES = {"op2_pack_best_fit": op2_pack_best_fit}
ORACLE: dict[str, str] = {}
