"""Chunked array folders: read, write, boxes, filters."""

import gzip
import json
import os
import zlib

import numpy as np
import pytest

from tessera.geometry import Roi
from tessera.sources import volumes
from tessera.sources.arrays import ArrayFolder, in_box
from tests.test_chunk_work import chunked, whole


@pytest.fixture(scope="module")
def source(spark):
    spark.dataSource.register(ArrayFolder)
    return spark


def made(path, array, size, compress=lambda b: b, compressor=None, mark="."):
    """A folder written by hand."""
    os.makedirs(path)
    about = {"zarr_format": 2, "shape": list(array.shape), "chunks": list(size), "dtype": array.dtype.str, "compressor": compressor, "fill_value": 7, "order": "C", "filters": None, "dimension_separator": mark}
    with open(f"{path}/.zarray", "w") as f:
        json.dump(about, f)
    for b in np.ndindex(*[-(-n // s) for n, s in zip(array.shape, size)]):
        own = np.full(size, 99, array.dtype)
        part = array[tuple(slice(k * s, (k + 1) * s) for k, s in zip(b, size))]
        own[tuple(slice(0, n) for n in part.shape)] = part
        name = f"{path}/{mark.join(map(str, b))}"
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(name, "wb") as f:
            f.write(compress(own.tobytes()))


ARRAY = np.random.default_rng(7).integers(0, 2**15, (5, 9, 14)).astype(np.int16)


@pytest.mark.parametrize(("how", "compress"), [(None, lambda b: b), ({"id": "zlib", "level": 1}, zlib.compress), ({"id": "gzip", "level": 5}, gzip.compress)])
@pytest.mark.parametrize("mark", [".", "/"])
def test_folders_by_hand(source, tmp_path, how, compress, mark):
    big = ARRAY.astype(">i2") if how is None else ARRAY
    made(f"{tmp_path}/a", big, (2, 4, 5), compress, how, mark)
    got = source.read.format("array_folder").load(f"file://{tmp_path}/a")
    assert got.schema.simpleString() == source.createDataFrame([], volumes.CHUNKS).schema.simpleString()
    assert (whole(got, ARRAY.shape) == ARRAY).all() and got.count() == 27
    os.remove(f"{tmp_path}/a/{mark.join('111')}")
    want = ARRAY.copy()
    want[2:4, 4:8, 5:10] = 7  # a chunk without a file
    assert (whole(got, ARRAY.shape) == want).all()


def test_only_touched_chunks_are_opened(source, tmp_path):
    """All other files are damaged: reading one would fail."""
    made(f"{tmp_path}/b", ARRAY, (2, 4, 5), zlib.compress, {"id": "zlib", "level": 1})
    for name in os.listdir(f"{tmp_path}/b"):
        if name[0] != "." and name not in ("0.1.1", "0.1.2", "1.1.1", "1.1.2"):
            with open(f"{tmp_path}/b/{name}", "wb") as f:
                f.write(b"damaged")
    read = source.read.format("array_folder").option("per_task", 1)
    boxed = read.option("begin", "1,4,6").option("end", "4,8,14").load(f"file://{tmp_path}/b")
    assert {(r.bz, r.by, r.bx) for r in boxed.collect()} == {(0, 1, 1), (0, 1, 2), (1, 1, 1), (1, 1, 2)}
    assert boxed.rdd.getNumPartitions() == 4
    again = in_box(source, f"file://{tmp_path}/b", Roi((1, 4, 6), (4, 8, 14)))
    assert again.filter("bz = 0").count() == 2 and again.count() == 4
    with pytest.raises(Exception, match="decompress|incorrect header"):
        source.read.format("array_folder").load(f"file://{tmp_path}/b").count()


@pytest.mark.parametrize("options", [{}, {"compressor": "none", "separator": "/"}, {"compressor": "gzip", "level": "3"}])
def test_round_trip(source, tmp_path, options):
    blocks = chunked(source, ARRAY, (2, 4, 5), skip={(0, 0, 0)})
    write = blocks.repartition(3).write.format("array_folder").mode("append").options(shape="5,9,14", size="2,4,5", dtype="int16", **options)
    for _ in range(2):  # writing again puts the same files in place
        write.save(f"file://{tmp_path}/c")
    assert not [f for _, _, names in os.walk(f"{tmp_path}/c") for f in names if f.startswith(".part")]
    want = ARRAY.copy()
    want[:2, :4, :5] = 0
    assert (whole(source.read.format("array_folder").load(f"file://{tmp_path}/c"), ARRAY.shape) == want).all()
    about = json.load(open(f"{tmp_path}/c/.zarray"))
    assert about["shape"] == [5, 9, 14] and about["dtype"] == "<i2"


def test_what_cannot_be_read_or_written_is_said(source, tmp_path):
    made(f"{tmp_path}/d", ARRAY, (2, 4, 5), zlib.compress, {"id": "blosc"})
    with pytest.raises(Exception, match="blosc"):
        source.read.format("array_folder").load(f"file://{tmp_path}/d").count()
    with pytest.raises(Exception, match="rechunk first"):
        chunked(source, ARRAY, (2, 4, 5)).write.format("array_folder").mode("append").options(shape="5,9,14", size="2,4,4", dtype="int16").save(f"file://{tmp_path}/e")
    with pytest.raises(Exception, match="does not fit"):
        chunked(source, ARRAY, (2, 4, 5)).write.format("array_folder").mode("append").options(shape="5,9,14", size="2,4,5").save(f"file://{tmp_path}/f")
