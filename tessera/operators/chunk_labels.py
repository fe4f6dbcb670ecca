"""Labels of volumes in chunk rows: connected objects, look-up tables and volumes, without a voxel row.

*Objects* are found in two passes. Each chunk is labelled where it lies, by hooking and pointer jumping on its pairs of
neighbours; an object is known by its least voxel in the volume. Chunks then send their outer faces, and nothing else, to
those they touch: pairs of labels that meet there are links, and components of the links name the objects. In the second pass a
chunk meets the list of those of its own labels that change, and replaces them by binary search.

A look-up table is applied in the same way: the distinct labels of each chunk are joined with the table (a label that is in
very many chunks is dealt over many tasks), and a chunk gets the list of its own.
"""

from __future__ import annotations

from itertools import chain, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.geometry import AXES
from tessera.operators.chunks import NAMES, _array, _row
from tessera.operators.components import component_edges
from tessera.operators.skew import looked_up
from tessera.session import materialize
from tessera.sources.volumes import CHUNKS, dealt, groups_of, lots, rows_of

BLOCK = ["bz", "by", "bx"]
NAMED = f"{CHUNKS}, was binary, was_dtype string"
FACES = f"axis int, upper boolean, {NAMED}"


def united(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least of the numbers 0 to n - 1 that each one is connected with by links (u, v)."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        above = root[root]
        while (above != root).any():
            root, above = above, above[above]
    return root


def block_objects(values: np.ndarray, same: bool = False) -> np.ndarray:
    """For each voxel that is not 0 the index of the least voxel of its face-connected object in the block, -1 elsewhere.

    With ``same`` an object has one value.
    """
    on, index = values != 0, np.arange(values.size).reshape(values.shape)
    ends = []
    for axis in range(values.ndim):
        low, high = (tuple(s if i == axis else slice(None) for i in range(values.ndim)) for s in (slice(None, -1), slice(1, None)))
        met = on[low] & on[high] & ((values[low] == values[high]) if same else True)
        ends.append((index[low][met], index[high][met]))
    root = united(values.size, np.concatenate([u for u, _ in ends]), np.concatenate([v for _, v in ends]))
    return np.where(on, root.reshape(values.shape), -1)


def _named_by_voxel(r, root: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    z, y, x = np.unravel_index(np.maximum(root, 0), root.shape)
    at = ((z + int(r.z)) * shape[0] + y + int(r.y)) * shape[1] + x + int(r.x) + 1
    return np.where(root >= 0, at, 0).astype(np.int64)


def _faces(same: bool):
    """Rows (axis, block of the lower of two chunks, upper, place, labels and values) of each chunk's outer layers."""
    def run(stream):
        def made():
            for r in rows_of(stream):
                labels = _array(r)
                values = np.frombuffer(r.was, r.was_dtype).reshape(labels.shape) if same else None
                for axis, upper in product(range(3), (False, True)):
                    at = tuple((slice(0, 1) if upper else slice(-1, None)) if i == axis else slice(None) for i in range(3))
                    face = labels[at]
                    if face.any():
                        block = [b - (upper and i == axis) for i, b in enumerate((r.bz, r.by, r.bx))]
                        begin = [r.z, r.y, r.x]
                        begin[axis] += 0 if upper else labels.shape[axis] - 1
                        was = np.ascontiguousarray(values[at]).tobytes() if same else None
                        yield [axis, upper, *_row(block, begin, face), was, r.was_dtype if same else None]

        yield from lots(made(), FACES)

    return run


def _met(same: bool):
    def met(rows):
        low, high = [r for r in rows if not r.upper], [r for r in rows if r.upper]
        if len(low) != 1 or len(high) != 1:
            return []
        a, b = low[0], high[0]
        begins = [(a.z, a.y, a.x), (b.z, b.y, b.x)]
        if begins[0][a.axis] + 1 != begins[1][a.axis]:
            return []
        cuts = []
        for r, own in ((a, begins[0]), (b, begins[1])):
            at = []
            for i in range(3):
                first = 0 if i == a.axis else max(begins[0][i], begins[1][i]) - own[i]
                last = 1 if i == a.axis else min(begins[0][i] + (a.nz, a.ny, a.nx)[i], begins[1][i] + (b.nz, b.ny, b.nx)[i]) - own[i]
                at.append(slice(int(first), int(max(first, last))))
            cuts.append((tuple(at), _array(r), np.frombuffer(r.was, r.was_dtype).reshape(r.nz, r.ny, r.nx) if same else None))
        (p, u, x), (q, v, y) = cuts
        u, v = u[p].ravel(), v[q].ravel()
        both = (u != 0) & (v != 0) & ((x[p].ravel() == y[q].ravel()) if same else True)
        pairs = np.unique(np.stack([u[both], v[both]], axis=1), axis=0)
        return pairs.tolist()

    def run(stream):
        yield from lots(chain.from_iterable(met(rows) for rows in groups_of(stream, ["axis", *BLOCK])), "u bigint, v bigint")

    return run


def labelled(chunks: DataFrame, shape: tuple[int, int], same: bool = False) -> DataFrame:
    """Chunks (int64) of face-connected objects of voxels that are not 0; an object is 1 + the linear index of its least voxel, 0 stays 0.

    ``shape`` is the volume's extent in y and x, from which linear indices follow. With ``same`` an object has one value. One chunk is held at a time,
    and of two chunks that touch, their layers there.
    """
    def local(stream):
        def made():
            for r in rows_of(stream):
                values = _array(r)
                own = _named_by_voxel(r, block_objects(values, same), shape)
                yield [*_row((r.bz, r.by, r.bx), (r.z, r.y, r.x), own), *((r.data, r.dtype) if same else (None, None))]

        yield from lots(made(), NAMED)

    own = materialize(chunks.select(*NAMES).mapInArrow(local, NAMED), "chunk-labels")
    links = dealt(own.mapInArrow(_faces(same), FACES), "axis", *BLOCK).mapInArrow(_met(same), "u bigint, v bigint")
    found = component_edges(links.distinct()).filter("node <> component")
    return relabelled(own.select(*NAMES), found.select(F.col("node").alias("src"), F.col("component").alias("dst")))


def labels_in(chunks: DataFrame) -> DataFrame:
    """(bz, by, bx, label, n): the labels of each chunk but 0, and their voxels. No exchange."""
    schema = "bz bigint, by bigint, bx bigint, label bigint, n bigint"

    def run(stream):
        def made():
            for r in rows_of(stream):
                labels, n = np.unique(_array(r), return_counts=True)
                for label, k in zip(labels.tolist(), n.tolist()):
                    if label:
                        yield [r.bz, r.by, r.bx, label, k]

        yield from lots(made(), schema)

    return chunks.select(*NAMES).mapInArrow(run, schema)


def relabelled(chunks: DataFrame, lut: DataFrame) -> DataFrame:
    """Chunks (int64) whose labels are replaced by a table's dst (src, dst; a src once); 0 and labels that it lacks stay.

    A chunk meets only the rows of its own labels, which are hashed: chunks are not sorted.
    """
    own = labels_in(chunks).select(*BLOCK, F.col("label").alias("src"))
    pairs = looked_up(own, lut.select("src", "dst"), "src", F.xxhash64(*BLOCK), "inner")
    lists = pairs.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("src", "dst"))).alias("pairs"))
    lists = lists.select(*BLOCK, F.transform("pairs", lambda p: p["src"]).alias("src"), F.transform("pairs", lambda p: p["dst"]).alias("dst"))

    def run(stream):
        def made():
            for r in rows_of(stream):
                values = _array(r).astype(np.int64)
                if r.src is not None:
                    src, dst = np.asarray(r.src, np.int64), np.asarray(r.dst, np.int64)
                    at = np.minimum(np.searchsorted(src, values), len(src) - 1)
                    values = np.where(src[at] == values, dst[at], values)
                yield _row((r.bz, r.by, r.bx), (r.z, r.y, r.x), values)

        yield from lots(made(), CHUNKS)

    return chunks.select(*NAMES).join(lists.hint("shuffle_hash"), BLOCK, "left").mapInArrow(run, CHUNKS)


def volumes(chunks: DataFrame) -> DataFrame:
    """(label, n): voxels of each label but 0; chunks count their own first."""
    return labels_in(chunks).groupBy("label").agg(F.sum("n").alias("n"))


def boxes(chunks: DataFrame) -> DataFrame:
    """(label, n, begin and end of its box on each axis): each chunk names its part of a label, parts are combined."""
    names = [f"{a}{e}" for a in AXES for e in (0, 1)]

    def run(stream):
        import pandas as pd

        for rows in stream:
            for r in rows.itertuples(index=False):
                values = _array(r)
                at = np.nonzero(values)
                if not len(at[0]):
                    continue
                labels, own, n = np.unique(values[at], return_inverse=True, return_counts=True)
                out = {"label": labels.astype(np.int64), "n": n}
                for a, where, begin in zip(AXES, at, (r.z, r.y, r.x)):
                    low, high = np.full(len(labels), np.iinfo(np.int64).max), np.full(len(labels), np.iinfo(np.int64).min)
                    np.minimum.at(low, own, where + begin)
                    np.maximum.at(high, own, where + begin + 1)
                    out |= {f"{a}0": low, f"{a}1": high}
                yield pd.DataFrame(out)

    parts = chunks.select(*NAMES).mapInPandas(run, "label bigint, n bigint, " + ", ".join(f"{c} bigint" for c in names))
    return parts.groupBy("label").agg(F.sum("n").alias("n"), *[(F.min if c[1] == "0" else F.max)(c).alias(c) for c in names])
