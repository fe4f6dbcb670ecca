"""Column expressions over names and paths, and a viewer's view of a box."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold_of(name: Column) -> Column:
    """The threshold at the end of a dataset's name: ``.../segmentation_0.500`` is 0.5, ``....500`` is thousandths; null without one."""
    last = F.regexp_extract(name, r"(?:^|[_/])(\d+\.\d+)$", 1)
    thousandths = F.regexp_extract(name, r"[^\d.]\.(\d{3})$", 1)
    return F.when(last != "", last.cast("double")).when(thousandths != "", thousandths.cast("double") / 1000)


def model_of(path: Column) -> Column:
    """``setup<dd>_<iteration>`` from a path; an iteration ends in 00. Null if the path names no setup or iteration."""
    setup, iteration = F.regexp_extract(path, r"setup[0-9]{2}", 0), F.regexp_extract(path, r"[0-9]+00", 0)
    return F.when((setup != "") & (iteration != ""), F.concat_ws("_", setup, iteration))


def grid_of(offset: tuple[int, int, int], shape: tuple[int, int, int], context: tuple[int, int, int], voxel: tuple[int, int, int]) -> dict[str, int | str]:
    """A box in world units as a viewer's grid: its corner in voxels, the widths, offsets and sections."""
    z, y, x = (o // v for o, v in zip(offset, voxel))
    return {"corner": f"{x} {y} {z}", "grid_width": shape[2], "grid_height": shape[1], "grid_x_offset": offset[2] % shape[2], "grid_y_offset": offset[1] % shape[1], "z_begin": z, "z_end": z + shape[0] // voxel[0], "z_offset": z - context[0] // voxel[0]}
