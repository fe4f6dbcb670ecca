"""Volumes as chunk rows: one row holds a dense block (bz, by, bx, z, y, x, nz, ny, nx, dtype, data), a byte or a few a voxel.

Steps that look at one block run where it lies, without an exchange. Steps that look at neighbours
get them by ``with_halo``: a chunk goes to its own group, and only what lies in their halos goes to the groups
of other blocks. A group holds one block and its halo, whatever the volume's size. Voxels that no chunk holds are
told to the kernel as absent. Chunks lie on the grid of their size; those at a volume's end may be smaller.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi
from tessera.sources.volumes import CHUNKS, NAMES, arrow_schema, dealt, groups_of, lots, rows_of

#: Size of whole chunks; None: measure it.
Size = tuple[int, int, int] | None


def _array(r) -> np.ndarray:
    return np.frombuffer(r.data, r.dtype).reshape(r.nz, r.ny, r.nx)


def _row(block, begin, values: np.ndarray) -> list:
    return [*map(int, block), *map(int, begin), *values.shape, str(values.dtype), np.ascontiguousarray(values).tobytes()]


def each(chunks: DataFrame, kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``kernel`` on every block, shape kept. No exchange."""
    def run(stream):
        yield from lots((_row((r.bz, r.by, r.bx), (r.z, r.y, r.x), kernel(_array(r))) for r in rows_of(stream)), CHUNKS)

    return chunks.select(*NAMES).mapInArrow(run, CHUNKS)


def grid_size(chunks: DataFrame) -> tuple[int, int, int]:
    """The size of whole chunks, from one pass over their shapes."""
    return tuple(n or 1 for n in chunks.agg(*[F.max(f"n{a}") for a in AXES]).first())


def with_halo(chunks: DataFrame, halo: tuple[int, int, int], kernel: Callable[..., np.ndarray | dict], schema: str = CHUNKS, size: Size = None) -> DataFrame:
    """``kernel(values, present, begin)`` on each block grown by ``halo``, cropped to the block; ``begin`` is the grown block's.

    A halo may be wider than a chunk: each chunk is sent to all blocks whose grown box it touches, cut to that box.
    ``size`` is that of whole chunks; if it is not given it is measured, which reads the chunks once more.
    A kernel that returns a dict gives a row of chunks for each entry, with its key in a column ``channel``; one that returns
    a pandas frame gives its rows: name them in ``schema``.
    """
    size = size or grid_size(chunks)

    def pieces(stream):
        def made():
            for r in rows_of(stream):
                values, begin, block = _array(r), (r.z, r.y, r.x), (r.bz, r.by, r.bx)
                reached = [range(min(k, (b - h) // s), max(k, (b + n - 1 + h) // s) + 1) if h else (k,) for k, b, n, h, s in zip(block, begin, values.shape, halo, size)]
                for to in product(*reached):
                    own = to == block
                    low = [b if own or not h else max(b, k * s - h) for k, b, h, s in zip(to, begin, halo, size)]
                    high = [b + n if own or not h else min(b + n, (k + 1) * s + h) for k, b, n, h, s in zip(to, begin, values.shape, halo, size)]
                    if all(lo < hi for lo, hi in zip(low, high)):
                        yield [*_row(to, low, values[tuple(slice(lo - b, hi - b) for lo, hi, b in zip(low, high, begin))]), own]

        yield from lots(made(), f"{CHUNKS}, own boolean")

    def grown(rows):
        """A group's block with its halo, where it is present, and its first row."""
        own = next((r for r in rows if r.own), None)
        if own is None:
            return None
        shape = [n + 2 * h for n, h in zip((own.nz, own.ny, own.nx), halo)]
        low = [b - h for b, h in zip((own.z, own.y, own.x), halo)]
        values, present = np.zeros(shape, own.dtype), np.zeros(shape, bool)
        for r in rows:
            # a block at the volume's end is smaller than the piece was cut for
            begin = [max(b - o, 0) for b, o in zip((r.z, r.y, r.x), low)]
            end = [min(b - o + n, m) for b, o, n, m in zip((r.z, r.y, r.x), low, (r.nz, r.ny, r.nx), shape)]
            if all(a < e for a, e in zip(begin, end)):
                at = tuple(slice(a, e) for a, e in zip(begin, end))
                values[at], present[at] = _array(r)[tuple(slice(a - b + o, e - b + o) for a, e, b, o in zip(begin, end, (r.z, r.y, r.x), low))], True
        return own, values, present, tuple(low)

    def run(stream):
        import pyarrow as pa

        frames = []

        def made():
            for rows in groups_of(stream, ["bz", "by", "bx"]):
                found = grown(rows)
                if found is None:
                    continue
                own, values, present, low = found
                inner = tuple(slice(h, h + n) for h, n in zip(halo, (own.nz, own.ny, own.nx)))
                out = kernel(values, present, low)
                place = ((own.bz, own.by, own.bx), (own.z, own.y, own.x))
                if isinstance(out, dict):
                    for k, v in out.items():
                        yield [*_row(*place, v[inner]), k]
                elif isinstance(out, np.ndarray):
                    yield _row(*place, out[inner])
                else:
                    frames.append(out)
                    yield None

        rows = made()
        for first in rows:
            if first is None:  # frames: one a block
                yield pa.RecordBatch.from_pandas(frames.pop(), arrow_schema(schema), preserve_index=False)
            else:
                yield from lots(chain([first], rows), schema)

    return dealt(chunks.select(*NAMES).mapInArrow(pieces, f"{CHUNKS}, own boolean"), "bz", "by", "bx").mapInArrow(run, schema)


def _near(a: np.ndarray, axis: int, step: int, fill) -> np.ndarray:
    """The array whose voxel p is a[p + step] along an axis; ``fill`` beyond."""
    out = np.full(a.shape, fill, a.dtype)
    put, get = [slice(None)] * 3, [slice(None)] * 3
    put[axis], get[axis] = (slice(0, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(0, step))
    out[tuple(put)] = a[tuple(get)]
    return out


def _axes(axes: str) -> list[int]:
    return [AXES.index(a) for a in axes]


def eroded_min(chunks: DataFrame, axes: str = "z", steps: int = 1, size: Size = None) -> DataFrame:
    """The least of a voxel and its neighbours along some axes, axis by axis, repeated; absent voxels count as nothing."""
    def kernel(values, present, begin):
        most = np.iinfo(values.dtype).max if values.dtype.kind in "iu" else np.inf
        values = np.where(present, values, most).astype(values.dtype)
        for _ in range(steps):
            for axis in _axes(axes):
                values = np.minimum(values, np.minimum(_near(values, axis, -1, most), _near(values, axis, 1, most)))
                values = np.where(present, values, most).astype(values.dtype)
        return values

    return with_halo(chunks, tuple(steps if a in axes else 0 for a in AXES), kernel, size=size)


def mask_propagated(chunks: DataFrame, xy_steps: int, z_steps: int, size: Size = None) -> DataFrame:
    """Zeros of a mask spread to face neighbours: in all axes while both counts last, then in the one that is left."""
    both = min(xy_steps, z_steps)

    def kernel(values, present, begin):
        values = np.where(present, values, 255).astype(np.uint8)
        for axes in [(0, 1, 2)] * both + [(1, 2)] * (xy_steps - both) + [(0,)] * (z_steps - both):
            before = values
            for axis in axes:  # all from the state before the step: a cross, not a cube
                values = np.minimum(values, np.minimum(_near(before, axis, -1, 255), _near(before, axis, 1, 255)))
            values = np.where(present, values, 255).astype(np.uint8)
        return values

    return with_halo(chunks, (z_steps, xy_steps, xy_steps), kernel, size=size)


def boundary_grown(chunks: DataFrame, steps: int = 1, axes: str = "zyx", size: Size = None) -> DataFrame:
    """A voxel with a neighbour of another label becomes 0; absent voxels count as the same."""
    def kernel(values, present, begin):
        for _ in range(steps):
            same = np.ones(values.shape, bool)
            for axis in _axes(axes):
                for step in (-1, 1):
                    same &= ~_near(present, axis, step, False) | (_near(values, axis, step, 0) == values)
            values = np.where(same, values, 0).astype(values.dtype)
        return values

    return with_halo(chunks, tuple(steps if a in axes else 0 for a in AXES), kernel, size=size)


def dilated(chunks: DataFrame, steps_3d: int = 1, steps_2d: int = 0, size: Size = None) -> DataFrame:
    """A mask (not 0) and its face neighbours, in space and then in the plane, within the chunks there are."""
    def kernel(values, present, begin):
        on = values != 0
        for axes in ["zyx"] * steps_3d + ["yx"] * steps_2d:
            before = on
            for axis in _axes(axes):
                on = on | _near(before, axis, -1, False) | _near(before, axis, 1, False)
            on &= present
        return on.astype(np.uint8)

    return with_halo(chunks, (steps_3d, steps_3d + steps_2d, steps_3d + steps_2d), kernel, size=size)


def probability_affinities(chunks: DataFrame, pad: int = 255, size: Size = None) -> DataFrame:
    """Chunks with a channel column aff_z, aff_y, aff_x: in the plane the value itself; along z the least of it and the section before."""
    def kernel(values, present, begin):
        before = np.where(_near(present, 0, -1, False), _near(values, 0, -1, 0), pad).astype(values.dtype)
        return {"aff_z": np.minimum(values, before), "aff_y": values, "aff_x": values}

    return with_halo(chunks, (1, 0, 0), kernel, f"{CHUNKS}, channel string", size=size)


def label_affinities(chunks: DataFrame, size: Size = None) -> DataFrame:
    """Chunks with a channel column: 255 where a voxel has the same label, not 0, as its lower neighbour along an axis."""
    def kernel(values, present, begin):
        same = lambda i: (values != 0) & _near(present, i, -1, False) & (_near(values, i, -1, 0) == values)
        return {f"aff_{a}": np.where(same(i), 255, 0).astype(np.uint8) for i, a in enumerate(AXES)}

    return with_halo(chunks, (1, 1, 1), kernel, f"{CHUNKS}, channel string", size=size)


_REDUCE = {"mean": None, "max": np.maximum, "min": np.minimum}


def downsampled(chunks: DataFrame, factor: tuple[int, int, int], how: str = "mean") -> DataFrame:
    """mean (float64), max, min, or ``label``: the voxel at index k // 2 of each cell. No exchange: chunks must begin on whole cells.

    Cells that a volume's end cuts are reduced over what there is; a label needs the whole way to its voxel.
    """
    def run(stream):
        def made():
            for r in rows_of(stream):
                begin, values = (r.z, r.y, r.x), _array(r)
                if any(b % k for b, k in zip(begin, factor)):
                    raise ValueError("a chunk begins inside a cell: rechunk first")
                if how == "label":
                    values = values[tuple(slice(k // 2, None, k) for k in factor)]
                else:
                    values = values.astype(np.float64) if how == "mean" else values
                    for axis, k in enumerate(factor):
                        at = np.arange(0, values.shape[axis], k)
                        if how == "mean":
                            sizes = np.diff(np.append(at, values.shape[axis])).reshape([-1 if i == axis else 1 for i in range(3)])
                            values = np.add.reduceat(values, at, axis) / sizes
                        else:
                            values = _REDUCE[how].reduceat(values, at, axis)
                if values.size:
                    yield _row((r.bz, r.by, r.bx), [b // k for b, k in zip(begin, factor)], values)

        yield from lots(made(), CHUNKS)

    return chunks.select(*NAMES).mapInArrow(run, CHUNKS)


def rechunked(chunks: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """The same volume in chunks of another size, on the grid from 0: each block is cut along the new grid, and the pieces meet by its key.

    What no chunk held is 0 where it lies between others; a chunk ends where its last piece does.
    """
    def cut(stream):
        import pandas as pd

        for rows in stream:
            out = []
            for r in rows.itertuples(index=False):
                values, begin = _array(r), (r.z, r.y, r.x)
                spans = [[(k, max(b, k * s), min(b + n, (k + 1) * s)) for k in range(b // s, (b + n - 1) // s + 1)] for b, n, s in zip(begin, values.shape, size)]
                for parts in product(*spans):
                    piece = values[tuple(slice(lo - b, hi - b) for (_, lo, hi), b in zip(parts, begin))]
                    out.append(_row([k for k, _, _ in parts], [lo for _, lo, _ in parts], piece))
            yield pd.DataFrame(out, columns=NAMES)

    def join(key, rows):
        import pandas as pd

        begin = [int(k) * s for k, s in zip(key, size)]
        shape = [int((rows[a] + rows[f"n{a}"]).max()) - b for a, b in zip(AXES, begin)]
        values = np.zeros(shape, rows["dtype"].iloc[0])
        for r in rows.itertuples(index=False):
            values[tuple(slice(b - o, b - o + n) for b, o, n in zip((r.z, r.y, r.x), begin, (r.nz, r.ny, r.nx)))] = _array(r)
        return pd.DataFrame([_row(key, begin, values)], columns=NAMES)

    return chunks.mapInPandas(cut, CHUNKS).groupBy("bz", "by", "bx").applyInPandas(join, CHUNKS)


def pyramid_levels(chunks: DataFrame, voxel: tuple[int, int, int], roi: Roi, size: tuple[int, int, int], factors: list[tuple[int, int, int]], labels: bool = False, whole_chunks: bool = False) -> list[tuple[tuple[int, int, int], Roi, DataFrame]]:
    """(voxel size, box, chunks) of levels s1, s2 and so on, each from the one before, in chunks of one size.

    A level's box is the one before grown to its voxels (to its chunks with ``whole_chunks``). Chunks are first
    dealt so that they begin on whole cells, which needs an exchange only where a factor does not divide their size.
    """
    out = []
    for factor in factors:
        voxel = tuple(v * k for v, k in zip(voxel, factor))
        roi = roi.snap_to_grid(voxel, "grow")
        if whole_chunks:
            roi = roi.snap_to_grid(tuple(v * s for v, s in zip(voxel, size)), "grow")
        if any(s % k for s, k in zip(size, factor)):
            chunks = rechunked(chunks, tuple(-(-s // k) * k for s, k in zip(size, factor)))
        chunks = rechunked(downsampled(chunks, factor, "label" if labels else "mean"), size)
        out.append((voxel, roi, chunks))
    return out


def predicted(chunks: DataFrame, model: Callable[[np.ndarray], np.ndarray | dict], context: tuple[int, int, int], xy_downsample: int = 1, schema: str = CHUNKS, size: Size = None) -> DataFrame:
    """A model on each block with its context: values scaled from bytes to -1 to 1, results (0 to 1) times 255, clipped to bytes.

    ``model`` takes a float array with context and returns one of the same shape, or a dict of them (then name a
    channel column in ``schema``); it is sent to the workers. With ``xy_downsample`` it sees means over cells of as many
    pixels, and its results are spread over them again. Cells lie on the grid from 0, whatever the block and the context;
    their means are over the voxels there are, 0 if there is none.
    """
    k = xy_downsample
    halo = (context[0], context[1] + k - 1, context[2] + k - 1)  # so that all cells that block and context touch are whole

    def kernel(values, present, begin):
        cut = [((b + k - 1) // k * k - b, (b + n) // k * k - b) for b, n in zip(begin[1:], values.shape[1:])]
        inside = (slice(None), *[slice(lo, hi) for lo, hi in cut])
        scaled = values[inside].astype(np.float32) / 255
        if k > 1:
            # sums of whole numbers are exact: the same whatever the block
            cells = lambda a: a.reshape(a.shape[0], a.shape[1] // k, k, a.shape[2] // k, k).sum(axis=(2, 4), dtype=np.float64)
            scaled = (cells(np.where(present, values, 0)[inside]) / np.maximum(cells(present[inside]), 1) / 255).astype(np.float32)
        made = model(scaled * 2 - 1)

        def bytes_of(v):
            out = np.zeros(values.shape, np.uint8)
            out[inside] = np.clip((np.repeat(np.repeat(v, k, 1), k, 2) if k > 1 else v) * 255, 0, 255).astype(np.uint8)
            return out

        return {c: bytes_of(v) for c, v in made.items()} if isinstance(made, dict) else bytes_of(made)

    return with_halo(chunks, halo, kernel, schema, size=size)


def emptiness(chunks: DataFrame) -> DataFrame:
    """(bz, by, bx, empty): blocks without a value other than 0. No exchange."""
    schema = "bz bigint, by bigint, bx bigint, empty boolean"

    def run(stream):
        yield from lots(([r.bz, r.by, r.bx, not _array(r).any()] for r in rows_of(stream)), schema)

    return chunks.select(*NAMES).mapInArrow(run, schema)


def constant(grid: DataFrame, size: tuple[int, int, int], value: int = 0, dtype: str = "uint8") -> DataFrame:
    """Chunks of one value for each row of a grid (``geometry.chunks``): null, dummy and constant masks."""
    data = np.full(size, value, dtype).tobytes()
    return grid.select("bz", "by", "bx", *AXES, *[F.lit(n).cast("int").alias(f"n{a}") for n, a in zip(size, AXES)], F.lit(dtype).alias("dtype"), F.lit(data).alias("data"))


def multiplied(chunks: DataFrame, mask: DataFrame) -> DataFrame:
    """Values times a mask's on the same grid, over the chunks that both have and as far as both reach. Chunks meet, not voxels."""
    block = ["bz", "by", "bx"]
    both = chunks.select(*NAMES).join(mask.select(*block, *[F.col(n).alias(f"m{n}") for n in ("nz", "ny", "nx", "dtype", "data")]), block)

    def run(stream):
        def made():
            for r in rows_of(stream):
                values, on = _array(r), np.frombuffer(r.mdata, r.mdtype).reshape(r.mnz, r.mny, r.mnx)
                inside = tuple(slice(0, min(n, m)) for n, m in zip(values.shape, on.shape))
                yield _row((r.bz, r.by, r.bx), (r.z, r.y, r.x), values[inside] * on[inside].astype(values.dtype))

        yield from lots(made(), CHUNKS)

    return both.mapInArrow(run, CHUNKS)


def distances(chunks: DataFrame, voxel: tuple[int, int, int], size: Size = None, most: int = 4_000_000) -> DataFrame:
    """Chunks (float64) of the world distance from each voxel to the nearest one of another label; NaN where there is none.

    Exact: a pass along each axis keeps the nearest two labels of every voxel. A pass's group is the part of a line of chunks that goes through a
    face, which is halved until the line has about ``most`` voxels or is one voxel thick.
    """
    from tessera.operators.kernels import nearest_two

    size = size or grid_size(chunks)
    names, kinds = ["l1", "d1", "l2", "d2"], [np.int64, np.float64, np.int64, np.float64]
    state = ", ".join([*[f"b{a} bigint" for a in AXES], *[f"{a} bigint" for a in AXES], *[f"n{a} int" for a in AXES], *[f"{n} binary" for n in names]])
    columns = [c.split()[0] for c in state.split(", ")]
    empty = lambda shape: (np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape, np.int64), np.full(shape, np.inf))

    def start(stream):
        import pandas as pd

        for rows in stream:
            out = []
            for r in rows.itertuples(index=False):
                held = empty((r.nz, r.ny, r.nx))
                held[0][:], held[1][:] = _array(r), 0
                out.append([r.bz, r.by, r.bx, r.z, r.y, r.x, r.nz, r.ny, r.nx, *[a.tobytes() for a in held]])
            yield pd.DataFrame(out, columns=columns)

    def parts(axis: int, pieces: list[int]):
        """Each chunk cut across its face; a part's key is its place there."""
        def run(stream):
            import pandas as pd

            for rows in stream:
                out = []
                for r in rows.itertuples(index=False):
                    begin, shape = (r.z, r.y, r.x), (r.nz, r.ny, r.nx)
                    held = [np.frombuffer(getattr(r, n), k).reshape(shape) for n, k in zip(names, kinds)]
                    for cut in product(*[range(0, n, p) for n, p in zip(shape, pieces)]):
                        at = tuple(slice(c, c + p) for c, p in zip(cut, pieces))
                        some = held[0][at].shape
                        out.append([r.bz, r.by, r.bx, *[b + c for b, c in zip(begin, cut)], *some, *[np.ascontiguousarray(a[at]).tobytes() for a in held]])
                yield pd.DataFrame(out, columns=columns)

        return run

    def along(axis: int):
        def run(rows):
            import pandas as pd

            rows = rows.sort_values(AXES[axis])
            shapes = [(r.nz, r.ny, r.nx) for r in rows.itertuples(index=False)]
            low = int(rows[AXES[axis]].iloc[0])
            upto = int((rows[AXES[axis]] + rows[f"n{AXES[axis]}"]).max()) - low
            line = empty(tuple(upto if i == axis else max(s[i] for s in shapes) for i in range(3)))
            starts = (rows[AXES[axis]] - low).tolist()
            spots = [tuple(slice(b, b + s[i]) if i == axis else slice(0, s[i]) for i in range(3)) for b, s in zip(starts, shapes)]
            for r, s, at in zip(rows.itertuples(index=False), shapes, spots):
                for whole, n, k in zip(line, names, kinds):
                    whole[at] = np.frombuffer(getattr(r, n), k).reshape(s)
            best = [np.moveaxis(a, 0, axis) for a in nearest_two(tuple(np.moveaxis(a, axis, 0) for a in line), voxel[axis])]
            out = rows.copy()
            for n, a in zip(names, best):
                out[n] = [np.ascontiguousarray(a[at]).tobytes() for at in spots]
            return out

        return run

    def end(stream):
        import pandas as pd

        for rows in stream:
            out = []
            for r in rows.itertuples(index=False):
                far = np.frombuffer(r.d2, np.float64).reshape(r.nz, r.ny, r.nx)
                out.append(_row((r.bz, r.by, r.bx), (r.z, r.y, r.x), np.where(np.isfinite(far), np.sqrt(far), np.nan)))
            yield pd.DataFrame(out, columns=NAMES)

    def joined(rows):
        import pandas as pd

        begin = [int(rows[a].min()) for a in AXES]
        shape = [int((rows[a] + rows[f"n{a}"]).max()) - b for a, b in zip(AXES, begin)]
        values = np.zeros(shape, np.float64)
        for r in rows.itertuples(index=False):
            values[tuple(slice(b - o, b - o + n) for b, o, n in zip((r.z, r.y, r.x), begin, (r.nz, r.ny, r.nx)))] = _array(r)
        return pd.DataFrame([_row([int(rows[f"b{a}"].iloc[0]) for a in AXES], begin, values)], columns=NAMES)

    ends = chunks.agg(*[F.max(F.col(a) + F.col(f"n{a}")).alias(a) for a in AXES], *[F.min(a).alias(f"low_{a}") for a in AXES]).first()
    if ends[0] is None:
        return chunks.limit(0).select(*NAMES)
    now = chunks.select(*NAMES).mapInPandas(start, state)
    for axis in (2, 1, 0):
        pieces, length = list(size), ends[axis] - ends[3 + axis]
        across = [i for i in range(3) if i != axis]
        while max(pieces[i] for i in across) > 1 and length * pieces[across[0]] * pieces[across[1]] > most:
            widest = max(across, key=lambda i: pieces[i])
            pieces[widest] = -(-pieces[widest] // 2)
        now = now.mapInPandas(parts(axis, pieces), state).groupBy(*[AXES[i] for i in across]).applyInPandas(along(axis), state)
    return now.mapInPandas(end, CHUNKS).groupBy("bz", "by", "bx").applyInPandas(joined, CHUNKS)
