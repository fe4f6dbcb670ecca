"""Chunked array folders as a Spark data source: one file a chunk, and a JSON file that describes the array.

The layout is that of version 2 of the Zarr format: ``.zarray`` names shape, chunk size, data type (in array-protocol notation),
order, fill value and compressor; the chunk at grid place (k, j, i) is the file ``k.j.i`` (or ``k/j/i``), always of
the full chunk size; a chunk without a file is all fill value. Raw, zlib and gzip chunks are read and written; other compressors are
named in the error.

    spark.dataSource.register(ArrayFolder)
    spark.read.format("array_folder").option("begin", "0,0,0").option("end", "64,64,64").load("file:///data/raw")
    chunks.write.format("array_folder").option("shape", "100,200,300").option("size", "64,64,64").mode("append").save("file:///data/out")

Reading gives chunk rows. Only chunks in the box of ``begin`` and ``end`` (voxels, half-open) are opened; ``in_box`` sets them. Filters are
not pushed to the source: Spark 4.1 keeps the reader of a frame that a filter was pushed to, and gives later uses of
the same frame the filtered rows. A partition is ``per_task``
neighbouring chunks, by default as many as make at most MOST_TASKS of them. Writing gives one file a row, put in place by renaming it, so that a task which runs twice does
no harm; the description is written when all tasks are done. Files are opened through Arrow's file systems.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tessera.geometry import Roi
from tessera.sources.volumes import CHUNKS

MOST_TASKS = 10_000
#: What a description holds, by name.
DESCRIPTION, FORMAT = ".zarray", 2
NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def description(path: str) -> dict:
    """The array's description; raises where it is not one that can be read."""
    files, root = _opened(path)
    with files.open_input_stream(f"{root}/{DESCRIPTION}") as f:
        found = json.loads(f.read())
    if found.get("zarr_format") != FORMAT or len(found["shape"]) != 3 or found.get("order", "C") != "C" or found.get("filters"):
        raise ValueError("not a plain array of three dimensions")
    if (found.get("compressor") or {"id": "zlib"})["id"] not in ("zlib", "gzip"):
        raise ValueError(f"chunks are compressed by {found['compressor']['id']}")
    return found


def packed(values: np.ndarray, about: dict) -> bytes:
    """A chunk's file: values filled up to the chunk's size."""
    full = np.full(about["chunks"], about.get("fill_value") or 0, about["dtype"])
    full[tuple(slice(0, n) for n in values.shape)] = values
    data, how = full.tobytes(), about.get("compressor")
    if not how:
        return data
    return zlib.compress(data, how.get("level", 1)) if how["id"] == "zlib" else gzip.compress(data, how.get("level", 1), mtime=0)


def unpacked(data: bytes, about: dict) -> np.ndarray:
    how = about.get("compressor")
    if how:
        data = zlib.decompress(data) if how["id"] == "zlib" else gzip.decompress(data)
    return np.frombuffer(data, about["dtype"]).reshape(about["chunks"])


def _place(text: str | None, default: list[int]) -> list[int]:
    return [int(x) for x in text.split(",")] if text else default


class _Chunks(InputPartition):
    def __init__(self, blocks: list[tuple[int, int, int]]):
        self.blocks = blocks


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.about = description(self.path)
        begin, end = _place(options.get("begin"), [0, 0, 0]), _place(options.get("end"), self.about["shape"])
        self.low = [max(0, b) // c for b, c in zip(begin, self.about["chunks"])]
        self.high = [-(-min(e, n) // c) for e, n, c in zip(end, self.about["shape"], self.about["chunks"])]
        self.per_task = int(options.get("per_task", 0))

    def partitions(self):
        blocks = list(product(*[range(a, b) for a, b in zip(self.low, self.high)]))
        step = self.per_task or max(1, -(-len(blocks) // MOST_TASKS))
        return [_Chunks(blocks[k : k + step]) for k in range(0, len(blocks), step)] or [_Chunks([])]

    def read(self, partition) -> Iterator:
        import pyarrow as pa

        kinds = [*[pa.int64()] * 6, *[pa.int32()] * 3, pa.string(), pa.binary()]
        files, root = _opened(self.path)
        about, mark = self.about, self.about.get("dimension_separator", ".")
        for block in partition.blocks:
            try:
                with files.open_input_stream(f"{root}/{mark.join(map(str, block))}") as f:
                    values = unpacked(f.read(), about)
            except FileNotFoundError:
                values = np.full(about["chunks"], about.get("fill_value") or 0, about["dtype"])
            begin = [b * c for b, c in zip(block, about["chunks"])]
            shape = [min(c, n - o) for c, n, o in zip(about["chunks"], about["shape"], begin)]
            own = np.ascontiguousarray(values[tuple(slice(0, n) for n in shape)])
            own = own.astype(own.dtype.newbyteorder("="))
            row = [*block, *begin, *shape, str(own.dtype), own.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=NAMES)


class _Written(WriterCommitMessage):
    def __init__(self, dtypes: set[str]):
        self.dtypes = dtypes


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        kind = options.get("compressor", "zlib")
        how = None if kind == "none" else {"id": kind, "level": int(options.get("level", 1))}
        if kind not in ("none", "zlib", "gzip"):
            raise ValueError(f"compressor {kind}")
        self.about = {
            "zarr_format": FORMAT, "shape": _place(options["shape"], []), "chunks": _place(options["size"], []), "dtype": np.dtype(options.get("dtype", "uint8")).str,
            "compressor": how, "fill_value": int(options.get("fill_value", 0)), "order": "C", "filters": None, "dimension_separator": options.get("separator", "."),
        }

    def write(self, iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        files, root = _opened(self.path)
        files.create_dir(root, recursive=True)
        dtypes: set[str] = set()
        own = TaskContext.get()
        for batch in iterator:
            for r in batch.to_pylist():
                block, shape = (r["bz"], r["by"], r["bx"]), (r["nz"], r["ny"], r["nx"])
                if [r["z"], r["y"], r["x"]] != [b * c for b, c in zip(block, self.about["chunks"])] or any(n > c for n, c in zip(shape, self.about["chunks"])):
                    raise ValueError(f"chunk {block} is not on the grid of {self.about['chunks']}: rechunk first")
                values = np.frombuffer(r["data"], r["dtype"]).reshape(shape)
                if not np.can_cast(values.dtype, np.dtype(self.about["dtype"]), "safe"):
                    raise ValueError(f"{values.dtype} does not fit {self.about['dtype']}")
                name = f"{root}/{self.about['dimension_separator'].join(map(str, block))}"
                if self.about["dimension_separator"] == "/":
                    files.create_dir(name.rpartition("/")[0], recursive=True)
                part = f"{root}/.part-{'-'.join(map(str, block))}-{own.taskAttemptId()}"
                with files.open_output_stream(part) as f:
                    f.write(packed(values, self.about))
                files.move(part, name)
                dtypes.add(str(values.dtype))
        return _Written(dtypes)

    def commit(self, messages) -> None:
        files, root = _opened(self.path)
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/{DESCRIPTION}") as f:
            f.write(json.dumps(self.about, indent=1).encode())

    def abort(self, messages) -> None:
        """What was written stays: it is put in place again by the next try."""


class ArrayFolder(DataSource):
    """Register it, then read and write with the format ``array_folder``."""

    @classmethod
    def name(cls) -> str:
        return "array_folder"

    def schema(self) -> str:
        return CHUNKS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


def in_box(spark: SparkSession, path: str, roi: Roi, **options) -> DataFrame:
    """The chunks of an array that touch a box of voxels; no other is opened."""
    spark.dataSource.register(ArrayFolder)
    ends = {k: ",".join(map(str, v)) for k, v in (("begin", roi.begin), ("end", roi.end))}
    return spark.read.format("array_folder").options(**ends, **options).load(path)
