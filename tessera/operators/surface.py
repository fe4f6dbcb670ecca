"""Surfaces of labels in chunk rows, by marching tetrahedra.

Every cube of eight neighbouring voxels is cut in six tetrahedra along its main diagonal, the same way everywhere, so that
faces of neighbours match. Where a label ends within a tetrahedron, one or two triangles go through the middles of
its edges. A middle is known by the sum of its two voxels' places, so vertices of different chunks have the same key without
any exchange, and each cube belongs to one chunk, that of its first voxel. What no chunk holds is label 0: surfaces are closed.

A label's mesh is rows, in fragments by block, and never one task. Volumes and areas are sums over rows.
"""

from __future__ import annotations

from itertools import permutations, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.chunks import Size, with_halo

#: Bits of a doubled place on one axis, in a vertex key; places from -1 voxel on.
BITS = 21
TRIANGLES = "label bigint, bz bigint, by bigint, bx bigint, a bigint, b bigint, c bigint"
CORNERS = np.array(list(product((0, 1), repeat=3)))


def tetrahedra() -> np.ndarray:
    """(6, 4) corner numbers: from the first corner to the last one along the axes, in every order of them."""
    out = []
    for order in permutations(range(3)):
        at = np.zeros(3, int)
        path = [0]
        for axis in order:
            at[axis] = 1
            path.append(int(at @ [4, 2, 1]))
        out.append(path)
    return np.array(out)


def _facing(points: np.ndarray, inside: np.ndarray, triangle: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The triangle, turned so that its normal leads away from the inner corners."""
    middles = [(points[i] + points[j]) / 2 for i, j in triangle]
    normal = np.cross(middles[1] - middles[0], middles[2] - middles[0])
    outward = points[~inside].mean(axis=0) - points[inside].mean(axis=0)
    return triangle if normal @ outward > 0 else [triangle[0], triangle[2], triangle[1]]


def triangles_of(corners: np.ndarray, inside: np.ndarray) -> list[list[tuple[int, int]]]:
    """Triangles of a tetrahedron (4 corner numbers, which of them are inside) as edges of the cube."""
    inner, outer = corners[inside].tolist(), corners[~inside].tolist()
    if not inner or not outer:
        return []
    if len(inner) == 2:
        (i, j), (k, m) = inner, outer
        found = [[(i, k), (j, k), (j, m)], [(i, k), (j, m), (i, m)]]
    else:
        found = [[(i, o) for i in inner for o in outer]]
    points = CORNERS.astype(float)
    mask = np.isin(np.arange(8), inner)
    used = np.isin(np.arange(8), corners)
    return [_facing(points[used], mask[used], [(int(np.flatnonzero(used).tolist().index(i)), int(np.flatnonzero(used).tolist().index(j))) for i, j in t]) for t in found]


def case_table() -> list[list[np.ndarray]]:
    """For each tetrahedron and each of its 16 cases the triangles' vertices as sums of two corners (n, 3, 3)."""
    table = []
    for corners in tetrahedra():
        used, cases = np.sort(corners), []
        for case in range(16):
            inside = np.array([case >> i & 1 for i in range(4)], bool)
            found = triangles_of(used, inside)
            cases.append(np.array([[CORNERS[used[i]] + CORNERS[used[j]] for i, j in t] for t in found]).reshape(-1, 3, 3))
        table.append(cases)
    return table


def block_triangles(values: np.ndarray, present: np.ndarray, begin: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(labels, (n, 3, 3) doubled places) of the cubes of a block that is grown by one voxel, whose first present voxel is its own."""
    def corner(a, d):
        return a[tuple(slice(k, n - 1 + k) for k, n in zip(d, a.shape))]

    shape = [n - 1 for n in values.shape]
    own = np.zeros(values.shape, bool)
    own[1:-1, 1:-1, 1:-1] = True
    mine, decided = np.zeros(shape, bool), np.zeros(shape, bool)
    for d in CORNERS:
        here = corner(present, d)
        mine |= here & ~decided & corner(own, d)
        decided |= here
    values = np.where(present, values, 0)
    labels = np.stack([corner(values, d) for d in CORNERS], axis=-1)
    mixed = mine & (labels != labels[..., :1]).any(axis=-1)
    at, labels = np.stack(np.nonzero(mixed), axis=1), labels[mixed]
    found_labels, found = [], []
    table, tets = case_table(), tetrahedra()
    for k in range(8):
        first = (labels[:, k] != 0) & ~(labels[:, :k] == labels[:, k : k + 1]).any(axis=1)
        inside, place, own_label = labels[first] == labels[first, k : k + 1], at[first], labels[first, k]
        for corners, cases in zip(tets, table):
            case = (inside[:, np.sort(corners)] * [1, 2, 4, 8]).sum(axis=1)
            for number, shapes in enumerate(cases):
                some = case == number
                if len(shapes) and some.any():
                    found.append((2 * (place[some] + begin)[:, None, None, None, :] + shapes[None, :, None]).reshape(-1, 3, 3))
                    found_labels.append(np.repeat(own_label[some], len(shapes)))
    if not found:
        return np.zeros(0, np.int64), np.zeros((0, 3, 3), np.int64)
    return np.concatenate(found_labels).astype(np.int64), np.concatenate(found)


def key_of(places: np.ndarray) -> np.ndarray:
    """One number for a doubled place, from -1 on."""
    moved = (places + 2).astype(np.int64)
    if moved.size and (moved.min() < 0 or moved.max() >= 1 << BITS):
        raise ValueError("a place does not fit its bits")
    return (moved[..., 0] << (2 * BITS)) | (moved[..., 1] << BITS) | moved[..., 2]


def triangles(chunks: DataFrame, size: Size = None) -> DataFrame:
    """(label, bz, by, bx, a, b, c): triangles of all labels but 0, as vertex keys, normals outward."""
    def kernel(values, present, begin):
        import pandas as pd

        labels, places = block_triangles(values, present, begin)
        keys = key_of(places)
        inner = [(b + 1) // s for b, s in zip(begin, size)]
        return pd.DataFrame({"label": labels, "bz": inner[0], "by": inner[1], "bx": inner[2], "a": keys[:, 0], "b": keys[:, 1], "c": keys[:, 2]})

    if size is None:
        from tessera.operators.chunks import grid_size

        size = grid_size(chunks)
    return with_halo(chunks, (1, 1, 1), kernel, TRIANGLES, size=size)


def coordinates(key: str, voxel: tuple[float, float, float]) -> list:
    """z, y, x in world units of a vertex key."""
    shifts = (2 * BITS, BITS, 0)
    return [((F.shiftright(F.col(key), s) % (1 << BITS)) - 2) * (v / 2.0) for s, v in zip(shifts, voxel)]


def vertices(mesh: DataFrame, voxel: tuple[float, float, float]) -> DataFrame:
    """(label, key, z, y, x): each vertex of a label once, wherever its triangles are."""
    keys = mesh.select("label", F.explode(F.array("a", "b", "c")).alias("key")).distinct()
    return keys.select("label", "key", *[c.alias(a) for a, c in zip("zyx", coordinates("key", voxel))])


def measures(mesh: DataFrame, voxel: tuple[float, float, float]) -> DataFrame:
    """(label, triangles, volume, area) in world units: the volume from signed tetrahedra to the origin."""
    (az, ay, ax), (bz, by, bx), (cz, cy, cx) = (coordinates(k, voxel) for k in "abc")
    cross = ((by - ay) * (cx - ax) - (bx - ax) * (cy - ay), (bx - ax) * (cz - az) - (bz - az) * (cx - ax), (bz - az) * (cy - ay) - (by - ay) * (cz - az))
    signed = (az * cross[0] + ay * cross[1] + ax * cross[2]) / 6
    area = F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2]) / 2
    return mesh.groupBy("label").agg(F.count(F.lit(1)).alias("triangles"), F.sum(signed).alias("volume"), F.sum(area).alias("area"))


def open_edges(mesh: DataFrame) -> DataFrame:
    """(label, u, v, n): directed edges that are not met by as many the other way: none, for closed surfaces."""
    ends = mesh.select("label", F.explode(F.array(*[F.struct(F.col(p).alias("u"), F.col(q).alias("v")) for p, q in ("ab", "bc", "ca")])).alias("e")).select("label", "e.u", "e.v")
    way = F.when(F.col("u") < F.col("v"), 1).otherwise(-1)
    sums = ends.groupBy("label", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.sum(way).alias("n"))
    return sums.filter("n <> 0")
