"""Distribution statistics over columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import counted, materialize


def histogram(df: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, n): equal bins from ``low`` to ``high``; the last takes its upper end, what is outside goes."""
    width = (high - low) / bins
    own = df.filter(F.col(column).between(low, high))
    return own.groupBy(F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cumulative(hist: DataFrame) -> DataFrame:
    """Adds running counts; a histogram has as many rows as bins."""
    return hist.withColumn("total", F.sum("n").over(W.orderBy("bin")).cast("bigint"))


def t_statistic(df: DataFrame, group: str, column: str, a: str, b: str) -> DataFrame:
    """(t, df) of the equal-variance two-sample test."""
    pick = lambda g: F.when(F.col(group) == g, F.col(column))
    s = df.agg(*[f(pick(g)).alias(f"{n}_{k}") for g, k in ((a, "a"), (b, "b")) for f, n in ((F.avg, "m"), (F.var_samp, "v"), (F.count, "n"))])
    free = F.col("n_a") + F.col("n_b") - 2
    shared = ((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_b") - 1) * F.col("v_b")) / free
    return s.select(((F.col("m_a") - F.col("m_b")) / F.sqrt(shared * (1 / F.col("n_a") + 1 / F.col("n_b")))).alias("t"), free.alias("df"))


#: Moments of a cell along each axis, and points beyond which a cell is summed up by them.
ORDER, CROWDED = 24, 40

#: Places that meet the moments in one group, at most about.
PLACES = 20_000


def _moments(own: DataFrame, at: DataFrame, middle: tuple[float, float], spread: tuple[float, float, float]) -> tuple[DataFrame, DataFrame | None]:
    """Points (x, y, w) of cells with at most CROWDED, and (i, near) of the places ``at``: the kernel sums over those of all other cells, if there are any.

    In coordinates in which the kernel is exp(-(s * s + t * t) / 2), cells are one wide. With the distance a of a place and b of a point from the middle
    of a cell along an axis, the kernel is exp(-a * a / 2) * exp(-b * b / 2) * exp(a * b), whose last factor is the sum of a ** k * b ** k / k!. With
    ORDER terms and b within a half, what is left out is below 1e-17 for any a: less than doubles round to. No cell is left out, however far.
    """
    import math

    xx, xy, yy = spread
    across, slope = 1 / math.sqrt(xx), xy / xx
    along = 1 / math.sqrt(yy - xy * slope)
    x, y = F.col("x").cast("double") - F.lit(middle[0]), F.col("y").cast("double") - F.lit(middle[1])
    s, t = x * F.lit(across), (y - x * F.lit(slope)) * F.lit(along)
    cell = [F.floor(c).cast("bigint").alias(n) for c, n in ((s, "cs"), (t, "ct"))]
    held = own.select("x", "y", "w", s.alias("s"), t.alias("t"), *cell)
    counts = held.groupBy("cs", "ct").agg(F.count(F.lit(1)).alias("n"))
    crowded, some, _ = counted(counts.filter(F.col("n") > CROWDED).select("cs", "ct"), "kde-cells")
    if not some:
        return own, None
    rest = held.join(crowded, ["cs", "ct"], "left_anti").select("x", "y", "w")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            cs, ct, w = (batch.column(c).to_numpy() for c in ("cs", "ct", "w"))
            one, other = (_powers(batch.column(n).to_numpy() - c - 0.5, True) for n, c in (("s", cs), ("t", ct)))
            order = np.lexsort((ct, cs))
            cuts = np.flatnonzero((np.diff(cs[order]) != 0) | (np.diff(ct[order]) != 0)) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                key = int(cs[rows[0]]), int(ct[rows[0]])
                sums[key] = sums.get(key, 0.0) + (one[rows] * w[rows, None]).T @ other[rows]
        if sums:
            keys = np.array(list(sums))
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))], names=["cs", "ct", "m"])

    parts = max(1, -(-at.count() // PLACES))
    inside = held.join(crowded, ["cs", "ct"], "left_semi").repartition("cs", "ct").select("cs", "ct", "s", "t", "w")
    cells = inside.mapInArrow(summed, "cs bigint, ct bigint, m array<double>")
    each = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    places = at.select("i", s.alias("s"), t.alias("t"), F.pmod(F.xxhash64("i", "x", "y"), F.lit(parts)).cast("int").alias("part"))

    def shares(here, moments):
        i, own_s, own_t = (here.column(c).to_numpy() for c in ("i", "s", "t"))
        near = np.zeros(len(i))
        cs, ct = (moments.column(c).to_numpy() for c in ("cs", "ct"))
        held = moments.column("m").combine_chunks().flatten().to_numpy().reshape(-1, ORDER, ORDER)
        columns, column = np.unique(ct, return_inverse=True)
        lines = [(line, np.flatnonzero(cs == line)) for line in np.unique(cs)]
        lines = [(line, column[k], held[k].transpose(1, 0, 2).reshape(ORDER, -1)) for line, k in lines]
        for k in range(0, len(i) if len(cs) else 0, 1_000):
            other = np.stack([_powers(own_t[k : k + 1_000] - c - 0.5, False) for c in columns], axis=1)
            for line, at_columns, sums in lines:
                one = _powers(own_s[k : k + 1_000] - line - 0.5, False)
                near[k : k + 1_000] += np.einsum("ij,ij->i", one @ sums, other[:, at_columns].reshape(len(one), -1))
        return pa.table({"i": pa.array(i, pa.int64()), "near": pa.array(near)})

    return rest, places.groupBy("part").cogroup(each.groupBy("part")).applyInArrow(shares, "i bigint, near double")


def _powers(a: np.ndarray, divided: bool) -> np.ndarray:
    """Rows of exp(-a * a / 2) * a ** k, ``divided`` by k!, for k below ORDER."""
    out = np.empty((len(a), ORDER))
    out[:, 0] = np.exp(-a * a / 2)
    for k in range(1, ORDER):
        out[:, k] = out[:, k - 1] * a / (k if divided else 1)
    return out


def density(points: DataFrame, at: DataFrame, reach: float | None = None, most: int = 8_000) -> DataFrame:
    """(i, density) at points ``at`` (i, x, y) of a Gaussian kernel estimate with the points' full covariance times Scott's factor n ** (-1/3).

    Every point counts at every place. Equal points are counted first. Points of a crowded cell are summed up by moments, from which the cell's
    share at any place follows (``_moments``), so that the work is that of places and cells, of which there are as many as bandwidths squared fit into
    the points' range. Other points meet each place: both are dealt to parts of about ``most``, each part of places meets each part of points in a
    group of its own, and the sums of a place are added. With ``reach``, only points within so many bandwidths along
    each axis count, and all meet each place. Fewer than two points give no rows.
    """
    import math

    s = points.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), *[F.covar_samp(a, b).alias(a + b) for a, b in (("x", "x"), ("x", "y"), ("y", "y"))]).first()
    if s["n"] < 2:
        return at.select("i", F.lit(0.0).alias("density")).limit(0)
    h = s["n"] ** (-1 / 3)
    xx, xy, yy = s["xx"] * h, s["xy"] * h, s["yy"] * h
    det = xx * yy - xy * xy
    own = materialize(points.groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("w")), "kde-points")
    summed = None
    if reach is None and det > 0:
        own, summed = _moments(own, at, (s["mx"], s["my"]), (xx, xy, yy))
    parts, spots = (max(1, -(-df.count() // most)) for df in (own, at))

    def dealt(df: DataFrame, name: str, n: int, other: str, m: int) -> DataFrame:
        own_part = F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int").alias(name)
        return df.select("*", own_part).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    places = dealt(at.select("i", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), "q", spots, "p", parts)

    def run(there, here):
        x, y, w = (there.column(c).to_numpy().astype(np.float64) for c in ("x", "y", "w"))
        i, px, py = here.column("i").to_numpy(), here.column("x").to_numpy(), here.column("y").to_numpy()
        near = np.zeros(len(i))
        for k in range(0, len(i), 64):
            dx, dy = px[k : k + 64, None] - x, py[k : k + 64, None] - y
            some = np.exp(-(dx * dx * yy - 2 * dx * dy * xy + dy * dy * xx) / (2 * det)) * w
            if reach is not None:
                some *= (np.abs(dx) <= reach * math.sqrt(xx)) & (np.abs(dy) <= reach * math.sqrt(yy))
            near[k : k + 64] = some.sum(axis=1)
        return pa.table({"i": pa.array(i, pa.int64()), "near": pa.array(near)})

    found = dealt(own, "p", parts, "q", spots).groupBy("p", "q").cogroup(places.groupBy("p", "q")).applyInArrow(run, "i bigint, near double")
    if summed is not None:
        found = found.union(summed)
    return found.groupBy("i").agg((F.sum("near") / F.lit(2 * math.pi * math.sqrt(det) * s["n"])).alias("density"))


def auto_bins(df: DataFrame, column: str) -> tuple[int, float, float]:
    """Number of bins, least and most value: the narrower of Sturges' and Freedman and Diaconis' widths."""
    import math

    quartile = lambda q: F.percentile(column, F.lit(q))
    s = df.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"), (quartile(0.75) - quartile(0.25)).alias("iqr")).first()
    if not s["n"] or s["low"] == s["high"]:
        return 1, float(s["low"] or 0) - 0.5 * (s["n"] > 0), float(s["high"] or 1) + 0.5 * (s["n"] > 0)
    widths = [(s["high"] - s["low"]) / (math.log2(s["n"]) + 1), 2 * s["iqr"] / s["n"] ** (1 / 3)]
    return math.ceil((s["high"] - s["low"]) / min(w for w in widths if w > 0)), float(s["low"]), float(s["high"])


def auto_histogram(df: DataFrame, column: str, running: bool = False) -> DataFrame:
    """(bin, n) in automatic bins; ``running`` adds the share of all values up to each bin."""
    bins, low, high = auto_bins(df, column)
    found = histogram(df, column, bins, low, high)
    return found if not running else cumulative(found).withColumn("share", F.col("total") / F.sum("n").over(W.partitionBy()))


def paired_histograms(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """(kind, bin, n): both frames' automatic histograms, each in its own bins."""
    return auto_histogram(a, column).select(F.lit("a").alias("kind"), "bin", "n").union(auto_histogram(b, column).select(F.lit("b"), "bin", "n"))


def node_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, n) with whole-number edges from 0 to the largest value; ten equal bins from least to most if it is smaller than ``bins``."""
    low, most = df.agg(F.min(column), F.max(column)).first()
    if most is None:
        return df.select(F.lit(0).cast("bigint").alias("bin"), F.lit(0.0).alias("low"), F.lit(0).cast("bigint").alias("n")).limit(0)
    edges = [low + (most - low) * i / 10 for i in range(11)] if bins > most else [float(int(i * most / bins)) for i in range(bins + 1)]
    if edges[0] == edges[-1]:
        edges = [edges[0] - 0.5 + i / 10 for i in range(11)]
    places = F.array(*[F.lit(float(e)) for e in edges[:-1]])
    own = df.filter(F.col(column).between(edges[0], edges[-1])).select((F.size(F.filter(places, lambda e: e <= F.col(column))) - 1).cast("bigint").alias("bin"))
    return own.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).select("bin", F.element_at(places, (F.col("bin") + 1).cast("int")).alias("low"), "n")


def _beta_share(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    import math

    if x in (0.0, 1.0):
        return x
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(1 - x, b, a)
    tiny, c, d = 1e-300, 1.0, 1 / (1 - (a + b) * x / (a + 1))
    out = d
    for m in range(1, 10_000):
        for even in (True, False):
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if even else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d = 1 / ((1 + term * d) or tiny)
            c = (1 + term / c) or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return out * math.exp(a * math.log(x) + b * math.log1p(-x) - math.lgamma(a) - math.lgamma(b) + math.lgamma(a + b)) / a


def t_test(df: DataFrame, group: str, column: str, a: str, b: str) -> DataFrame:
    """(t, df, p): the statistic and its two-sided probability; one row reaches the driver."""
    row = t_statistic(df, group, column, a, b).first()
    p = None if row["t"] is None else _beta_share(row["df"] / (row["df"] + row["t"] ** 2), row["df"] / 2, 0.5)
    return df.sparkSession.createDataFrame([(row["t"], row["df"], p)], "t double, df bigint, p double")


def density_by_area(points: DataFrame, mask: DataFrame, column: str = "mask") -> DataFrame:
    """(density): points for each unit of a mask's sum."""
    area = mask.agg(F.sum(column).alias("area"))
    return points.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(area)).select((F.col("n") / F.col("area")).alias("density"))
