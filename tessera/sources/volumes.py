"""Volume scans: chunk rows, sparse voxel rows and image tile names."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi

CHUNKS = "bz bigint, by bigint, bx bigint, z bigint, y bigint, x bigint, nz int, ny int, nx int, dtype string, data binary"


NAMES = [c.split()[0] for c in CHUNKS.split(", ")]
#: Voxels that a Python step makes rows of at once, unless one chunk has more.
LOT = 1 << 18
_ARROW = {"bigint": "int64", "int": "int32", "string": "string", "binary": "binary", "boolean": "bool_", "double": "float64"}


def arrow_schema(schema: str):
    """Of a schema of names and simple types."""
    import pyarrow as pa

    return pa.schema([(name, getattr(pa, _ARROW[kind])()) for name, kind in map(str.split, schema.split(", "))])


def rows_of(stream) -> Iterator:
    """Rows of Arrow batches as named tuples, a few at once."""
    kind = None
    for batch in stream:
        kind = kind or namedtuple("Row", batch.schema.names)
        for at in range(0, batch.num_rows, 256):
            yield from map(kind, *[c.to_pylist() for c in batch.slice(at, 256).columns])


def lots(rows: Iterator, schema: str, most: int = 1 << 22) -> Iterator:
    """Arrow batches of about ``most`` bytes of an iterator of rows, so that Python holds no more than that."""
    import pyarrow as pa

    kinds = arrow_schema(schema)
    batch = lambda held: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kinds)], schema=kinds)
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(c) for c in row if isinstance(c, bytes))
        if size >= most:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def groups_of(stream, keys: list[str]) -> Iterator[list]:
    """Rows with the same key, of batches sorted by it: a call of Python serves all groups of a task, one is held at a time."""
    held, key = [], None
    for r in rows_of(stream):
        own = tuple(getattr(r, k) for k in keys)
        if held and own != key:
            yield held
            held = []
        held.append(r)
        key = own
    if held:
        yield held


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to as many tasks as the session shuffles to, by a key, and sorted by it there. Rows of a chunk are few bytes but much work: tasks are not merged by size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def chunks_of(voxels: DataFrame, size: tuple[int, int, int], dtype: str = "uint8", column: str = "value", roi: Roi | None = None) -> DataFrame:
    """Dense chunk rows from voxel rows; absent voxels are 0. Chunks end where a box (in voxels) does, if one is given.

    Voxels are packed by chunk where they lie, batch by batch, so that parts of chunks are exchanged and not voxels. A task of either side makes all its chunks in one call.
    """
    per = int(np.prod(size))
    kind = np.int32 if per < 1 << 31 else np.int64

    def pack(stream):
        import pyarrow as pa

        for batch in stream:
            if not batch.num_rows:
                continue
            places = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]]
            values = batch.column(3).to_numpy(zero_copy_only=False).astype(dtype)
            blocks = [c // n for c, n in zip(places, size)]
            inner = [c - b * n for c, b, n in zip(places, blocks, size)]
            at = ((inner[0] * size[1] + inner[1]) * size[2] + inner[2]).astype(kind)
            order = np.lexsort(blocks[::-1])
            blocks, at, values = [b[order] for b in blocks], at[order], values[order]
            starts = np.flatnonzero(np.concatenate([[True], np.any([b[1:] != b[:-1] for b in blocks], axis=0)]))
            ends = [*starts[1:].tolist(), len(at)]
            cut = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(starts.tolist(), ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array(b[starts]) for b in blocks], cut(at), cut(values)], names=["bz", "by", "bx", "at", "data"])

    def run(stream):
        def made():
            for rows in groups_of(stream, ["bz", "by", "bx"]):
                block = (rows[0].bz, rows[0].by, rows[0].bx)
                begin = [k * n for k, n in zip(block, size)]
                shape = [n if roi is None else min(n, e - b) for n, b, e in zip(size, begin, roi.end if roi else size)]
                data = np.zeros(per, dtype)
                for r in rows:
                    if shape != list(size) and any((c >= n).any() for c, n in zip(np.unravel_index(np.frombuffer(r.at, kind), size), shape)):
                        raise ValueError("a voxel lies outside the box")
                    data[np.frombuffer(r.at, kind)] = np.frombuffer(r.data, dtype)
                data = data.reshape(size)[tuple(slice(0, n) for n in shape)]
                yield [*block, *begin, *shape, dtype, data.tobytes()]

        yield from lots(made(), CHUNKS)

    kinds = "bz bigint, by bigint, bx bigint, at binary, data binary"
    return dealt(voxels.select(*AXES, column).mapInArrow(pack, kinds), "bz", "by", "bx").mapInArrow(run, CHUNKS)


def voxels_of(chunks: DataFrame, keep_zero: bool = False, kind: str = "bigint") -> DataFrame:
    """Voxel rows of chunk rows; zeros are left out unless asked for. A column ``channel`` stays."""
    more = [c for c in chunks.columns if c == "channel"]

    def run(stream):
        import pyarrow as pa

        def rows(held):
            shape = held[0][3:6]
            data = np.frombuffer(b"".join(h[7] for h in held), held[0][6]).reshape(len(held), *shape)
            at = np.nonzero(np.ones(data.shape, bool) if keep_zero else data)
            begins = np.array([h[:3] for h in held], np.int64)
            arrays = [pa.array(at[i + 1] + begins[at[0], i]) for i in range(3)]
            arrays.append(pa.array(data[at].astype(np.int64 if kind == "bigint" else np.float64)))
            if more:
                arrays.append(pa.array([h[8] for h in held], pa.string()).take(pa.array(at[0])))
            return pa.RecordBatch.from_arrays(arrays, names=["z", "y", "x", "value", *more])

        held, n = [], 0
        for r in rows_of(stream):
            own = (r.z, r.y, r.x, r.nz, r.ny, r.nx, r.dtype, r.data, *[getattr(r, c) for c in more])
            if held and (own[3:7] != held[0][3:7] or n >= LOT):
                yield rows(held)
                held, n = [], 0
            held.append(own)
            n += r.nz * r.ny * r.nx
        if held:
            yield rows(held)

    return chunks.mapInArrow(run, f"z bigint, y bigint, x bigint, value {kind}" + ", channel string" * len(more))


def chunks_in(chunks: DataFrame, roi: Roi, size: tuple[int, int, int]) -> DataFrame:
    """Chunks that a box touches, by ranges of their indices: with a table partitioned by bz, by, bx a partition filter."""
    for a, lo, hi, n in zip(AXES, roi.begin, roi.end, size):
        chunks = chunks.filter((F.col(f"b{a}") >= lo // n) & (F.col(f"b{a}") <= (hi - 1) // n))
    return chunks


def read_roi(chunks: DataFrame, roi: Roi, size: tuple[int, int, int]) -> DataFrame:
    """Voxels of a box; what no chunk holds is absent (fill with ``volume.filled``)."""
    return voxels_of(chunks_in(chunks, roi, size)).filter(roi.contains())


def translated(voxels: DataFrame, offset: tuple[int, int, int], roi: Roi) -> DataFrame:
    """out[p] = in[p + offset] for p in a box."""
    source = roi.shift(offset)
    return voxels.filter(source.contains()).withColumns({a: F.col(a) - o for a, o in zip(AXES, offset)})


def tiles(spark: SparkSession, path: str, pattern: str, tile: tuple[int, int]) -> DataFrame:
    """path, section, y, x of tile files; ``pattern`` captures section, row and column numbers."""
    files = spark.read.format("binaryFile").load(path).select("path")
    part = lambda i: F.regexp_extract("path", pattern, i).cast("bigint")
    return files.filter(F.col("path").rlike(pattern)).select("path", part(1).alias("z"), (part(2) * tile[0]).alias("y"), (part(3) * tile[1]).alias("x"))


def decoded(content: bytes) -> np.ndarray:
    """Pixels of a grey image: a binary graymap (P5) or an uncompressed TIFF of 8 or 16 bits."""
    if content[:2] == b"P5":
        fields, at = [], 2
        while len(fields) < 3:
            while content[at : at + 1].isspace() or content[at : at + 1] == b"#":
                at = content.index(b"\n", at) + 1 if content[at : at + 1] == b"#" else at + 1
            end = at
            while not content[end : end + 1].isspace():
                end += 1
            fields.append(int(content[at:end]))
            at = end
        width, height, most = fields
        return np.frombuffer(content, ">u2" if most > 255 else np.uint8, width * height, at + 1).reshape(height, width)
    order = {b"II": "<", b"MM": ">"}.get(content[:2])
    if order is None:
        raise ValueError("neither a graymap nor a TIFF")
    import struct

    at = struct.unpack_from(order + "I", content, 4)[0]
    tags = {}
    for k in range(struct.unpack_from(order + "H", content, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * k)
        form, place = {1: "B", 3: "H", 4: "I"}.get(kind), at + 10 + 12 * k
        if form is None:
            continue
        if struct.calcsize(form) * count > 4:
            place = struct.unpack_from(order + "I", content, place)[0]
        tags[tag] = struct.unpack_from(f"{order}{count}{form}", content, place)
    if tags.get(259, (1,))[0] != 1 or tags.get(277, (1,))[0] != 1:
        raise ValueError("compressed or coloured TIFF")
    width, height = tags[256][0], tags[257][0]
    pixels = b"".join(content[a : a + n] for a, n in zip(tags[273], tags[279]))
    return np.frombuffer(pixels, order + "u2" if tags.get(258, (8,))[0] == 16 else np.uint8, width * height).reshape(height, width)


def tile_voxels(spark: SparkSession, path: str, pattern: str, tile: tuple[int, int], bad: tuple[int, ...] = ()) -> DataFrame:
    """Voxel rows (z, y, x, value) of the tiles that ``tiles`` names. A section that is listed as bad, or black all over, takes the one before that is not."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    part = lambda i: F.regexp_extract("path", pattern, i).cast("bigint")
    own = files.filter(F.col("path").rlike(pattern)).select(part(1).alias("z"), (part(2) * tile[0]).alias("y"), (part(3) * tile[1]).alias("x"), "content")

    def look(stream):
        for rows in stream:
            yield rows[["z"]].assign(usable=[bool(decoded(c).any()) for c in rows.content])

    sections = own.select("z", "content").mapInPandas(look, "z bigint, usable boolean").groupBy("z").agg((F.max("usable") & ~F.col("z").isin(*bad) if bad else F.max("usable")).alias("usable"))
    ends = sections.agg(F.min("z"), F.max("z")).first()

    def pixels(stream):
        import pandas as pd

        for rows in stream:
            for r in rows.itertuples(index=False):
                values = decoded(r.content)
                at = np.indices(values.shape)
                yield pd.DataFrame({"z": r.to_z, "y": r.y + at[0].ravel(), "x": r.x + at[1].ravel(), "value": values.ravel().astype(np.int64)})

    if ends[0] is None:
        return spark.createDataFrame([], "z bigint, y bigint, x bigint, value bigint")
    carried = sections_carried(sections, ends[0], ends[1]).select(F.col("from_z").alias("z"), F.col("z").alias("to_z"))
    return own.join(carried, "z").select("to_z", "y", "x", "content").mapInPandas(pixels, "z bigint, y bigint, x bigint, value bigint")


def sections_carried(sections: DataFrame, first: int, last: int) -> DataFrame:
    """(z, from_z): for each section the nearest usable one at or before it; ``sections`` has z and usable."""
    from pyspark.sql import Window as W

    good = sections.filter("usable").select("z").distinct().withColumn("next", F.lead("z").over(W.orderBy("z")))
    span = good.select(F.col("z").alias("from_z"), F.explode(F.sequence(F.greatest(F.col("z"), F.lit(first)), F.coalesce(F.col("next") - 1, F.lit(last)))).alias("z"))
    return span.filter(F.col("z").between(first, last)).select("z", "from_z")
