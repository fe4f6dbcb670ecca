"""Coordinates and boxes on flat z, y, x columns, so that range filters reach the scan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


@dataclass(frozen=True)
class Roi:
    """A half-open box of world units: ``begin`` <= c < ``end``."""

    begin: tuple[int, int, int]
    end: tuple[int, int, int]

    @property
    def shape(self) -> tuple[int, int, int]:
        return tuple(b - a for a, b in zip(self.begin, self.end))

    @property
    def empty(self) -> bool:
        return any(s <= 0 for s in self.shape)

    def contains(self, prefix: str = "", suffix: str = "") -> Column:
        """Predicate on the columns ``<prefix>z<suffix>`` and so on."""
        parts = [(F.col(f"{prefix}{a}{suffix}") >= lo) & (F.col(f"{prefix}{a}{suffix}") < hi) for a, lo, hi in zip(AXES, self.begin, self.end)]
        return reduce(lambda p, q: p & q, parts)

    def covers(self, point: tuple[int, int, int]) -> bool:
        return all(a <= c < b for a, c, b in zip(self.begin, point, self.end))

    def grow(self, by: tuple[int, int, int], after: tuple[int, int, int] | None = None) -> Roi:
        after = by if after is None else after
        return Roi(tuple(a - n for a, n in zip(self.begin, by)), tuple(b + n for b, n in zip(self.end, after)))

    def shift(self, by: tuple[int, int, int]) -> Roi:
        return Roi(tuple(a + n for a, n in zip(self.begin, by)), tuple(b + n for b, n in zip(self.end, by)))

    def intersect(self, other: Roi) -> Roi:
        return Roi(tuple(map(max, self.begin, other.begin)), tuple(map(min, self.end, other.end)))

    def union(self, other: Roi) -> Roi:
        return Roi(tuple(map(min, self.begin, other.begin)), tuple(map(max, self.end, other.end)))

    def intersects(self, other: Roi) -> bool:
        return not self.intersect(other).empty

    def snap_to_grid(self, step: tuple[int, int, int], mode: str = "grow") -> Roi:
        """Ends on the grid: ``grow`` outwards, ``shrink`` inwards."""
        down = lambda c, s: c // s * s
        up = lambda c, s: -(-c // s) * s
        first, last = (down, up) if mode == "grow" else (up, down)
        return Roi(tuple(map(first, self.begin, step)), tuple(map(last, self.end, step)))


def voxel(world: Column, size: int) -> Column:
    """World units to a voxel index; floor, also below zero."""
    return F.floor(world / F.lit(size)).cast("bigint")


def distance(a: str, b: str) -> Column:
    """Euclidean distance between points with column prefixes ``a`` and ``b``."""
    return F.sqrt(reduce(lambda p, q: p + q, [F.pow((F.col(f"{a}{c}") - F.col(f"{b}{c}")).cast("double"), F.lit(2.0)) for c in AXES]))


def packed_id(z: Column, y: Column, x: Column) -> Column:
    """A 63-bit id of three 21-bit coordinates."""
    return F.shiftleft(z.cast("bigint"), 42).bitwiseOR(F.shiftleft(y.cast("bigint"), 21)).bitwiseOR(x.cast("bigint"))


def block_of(offset: tuple[int, int, int], size: tuple[int, int, int], prefix: str = "") -> list[Column]:
    """Block indices bz, by, bx of a point."""
    return [F.floor((F.col(f"{prefix}{a}") - o) / F.lit(s)).cast("bigint").alias(f"b{a}") for a, o, s in zip(AXES, offset, size)]


def chunks(spark: SparkSession, roi: Roi, size: tuple[int, int, int]) -> DataFrame:
    """All blocks of a grid over a box: bz, by, bx and their begins, made by the executors."""
    counts = [-(-s // n) for s, n in zip(roi.shape, size)]
    rows = spark.range(counts[0] * counts[1] * counts[2])
    z, y, x = F.floor(F.col("id") / (counts[1] * counts[2])), F.floor(F.col("id") / counts[2]) % counts[1], F.col("id") % counts[2]
    named = [i.cast("bigint").alias(f"b{a}") for i, a in zip((z, y, x), AXES)]
    return rows.select(*named).select("*", *[(F.col(f"b{a}") * n + o).alias(a) for a, n, o in zip(AXES, size, roi.begin)])


def base_path(label: Column, base: int, digits: int) -> Column:
    """A label's digits to a base, most significant last, joined by slashes: a bounded folder tree."""
    parts = [(F.floor(label / F.lit(base**k)).cast("bigint") % base).cast("string") for k in range(digits)]
    return F.concat_ws("/", *parts)


def threshold_key(t: float) -> int:
    """Whole hundredths of a threshold, rounded (0.29 -> 29)."""
    return round(t * 100)
