"""Predicted synaptic sites against true ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.geometry import AXES, Roi, distance
from tessera.operators.skew import for_salts, salted
from tessera.session import materialize


def intra_removed(edges: DataFrame) -> DataFrame:
    """Edges between different neurons; the nodes of a removed edge take all their edges with them."""
    bad = edges.filter("pre_label = post_label")
    return _without(edges, bad.select(F.col("u").alias("n")).union(bad.select("v")).distinct())


def _without(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    for end in ("u", "v"):
        edges = edges.join(nodes.select(F.col("n").alias(end)), end, "left_anti")
    return edges


def in_roi(edges: DataFrame, roi: Roi) -> DataFrame:
    """A site stays if both its ends are in the box."""
    return edges.filter(roi.contains("pre_") & roi.contains("post_"))


def above_score(edges: DataFrame, score: float) -> DataFrame:
    """Strictly above an absolute score."""
    return edges.filter(F.col("score") > score)


def without_low_nodes(edges: DataFrame, scores: DataFrame, least: float) -> DataFrame:
    """Edges with neither end among the nodes (id, score) of ``least`` or less, nor among their mirrors -id."""
    low = scores.filter(F.col("score") <= least).select(F.explode(F.array(F.col("id"), -F.col("id"))).alias("n")).distinct()
    return _without(edges, low)


def nodes_without(nodes: DataFrame, edges: DataFrame, kind: str) -> DataFrame:
    """Nodes (id) that are no end of an edge on the side ``presyn`` (u) or ``postsyn`` (v)."""
    return nodes.join(edges.select(F.col("u" if kind == "presyn" else "v").alias("id")).distinct(), "id", "left_anti")


def postsynaptic(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with an edge that comes in, and the edges between two such."""
    own = nodes.join(edges.select(F.col("v").alias("id")).distinct(), "id", "left_semi")
    for end in ("u", "v"):
        edges = edges.join(own.select(F.col("id").alias(end)), end, "left_semi")
    return own, edges


def near_far(truth: DataFrame, found: DataFrame, met: DataFrame, reach: float) -> DataFrame:
    """(gt_u, gt_v, near, far) of the true sites that nothing met: predictions with the same post label and another pre label, those within ``reach``, as sorted [u, v] pairs, and the number of all.

    Near ones are listed where a true site meets the predictions around its cell, so that pairs are written nowhere; far ones are counted by
    label, so that no list of them is made. Sites of a cell with more than MOST_SITES are dealt over several groups.
    """
    missed = truth.join(met.select(F.col("gt_u").alias("u"), F.col("gt_v").alias("v")).distinct(), ["u", "v"], "left_anti")
    pairs = found.groupBy("pre_label", "post_label").agg(F.count(F.lit(1)).alias("same"))
    posts = pairs.groupBy("post_label").agg(F.sum("same").alias("all_"))
    counted = missed.join(pairs, ["pre_label", "post_label"], "left").join(posts, "post_label", "left")
    points, keys = [f"post_{a}" for a in AXES], ["post_label", *[f"c{a}" for a in AXES]]
    place = [F.when(F.col("pre_label").isNotNull(), F.col(p).cast("double")).alias(p) for p in points]  # without a label, no other one is near
    far = F.coalesce("all_", F.lit(0)) - F.coalesce("same", F.lit(0))
    asks = materialize(_cells(counted.select("u", "v", "pre_label", "post_label", *place, far.alias("far")), points, reach, False), "sites-missed")
    gives = _cells(found.dropna(subset=["pre_label", "post_label"]).select("u", "v", "pre_label", "post_label", *place, F.lit(None).cast("bigint").alias("far")), points, reach, True)
    cells = asks.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    crowded = cells.filter(F.col("n") > MOST_SITES)
    lone = asks.filter(" or ".join(f"{k} is null" for k in keys))
    both = salted(asks.dropna(subset=keys), keys, crowded, F.xxhash64("u", "v")).unionByName(for_salts(gives.join(cells.select(*keys), keys, "left_semi"), keys, crowded))
    listed = both.groupBy(*keys, "salt").applyInArrow(_near_lists(reach), "gt_u bigint, gt_v bigint, near array<array<bigint>>, far bigint")
    return listed.union(lone.select("u", "v", F.array().cast("array<array<bigint>>"), "far"))


#: True sites of a cell beyond which they are dealt over several groups, and pairs that are compared at once.
MOST_SITES, AT_ONCE = 50_000, 1_000_000


def _near_lists(reach: float) -> Callable:
    """From the true sites (with ``far``) and predictions of a group to (gt_u, gt_v, near, far), some true sites at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        valid = rows.column("far").is_valid().to_numpy()
        if not valid.any():
            return
        columns = {c: rows.column(c).to_numpy() for c in ("u", "v", "pre_label", "post_z", "post_y", "post_x")}
        asks, gives = np.flatnonzero(valid), np.flatnonzero(~valid)
        asks, gives = asks[np.argsort(columns["post_z"][asks])], gives[np.lexsort((columns["v"][gives], columns["u"][gives]))]
        here, there = ([columns[c][k] for c in ("post_z", "post_y", "post_x", "pre_label")] for k in (asks, gives))
        (u, v), ids, far = (columns[c][asks] for c in "uv"), np.column_stack([columns[c][gives] for c in "uv"]), rows.column("far").take(pa.array(asks)).to_numpy()
        again = len(ids) > 1 and (ids[1:] == ids[:-1]).all(axis=1).any()
        some = max(1, min(4096, AT_ONCE // max(1, len(ids))))
        for k in range(0, len(asks), some):
            z, y, x, own = (c[k : k + some, None] for c in here)
            level = np.flatnonzero((there[0] >= z[0] - reach) & (there[0] <= z[-1] + reach))
            oz, oy, ox, other = (c[level] for c in there)
            met = np.sqrt((z - oz) ** 2 + (y - oy) ** 2 + (x - ox) ** 2) <= reach
            met &= own != other
            at, which = np.nonzero(met)
            near = ids[level[which]]
            if again:  # a prediction of several rows is named once
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1]) | (near[1:] != near[:-1]).any(axis=1)
                at, near = at[new], near[new]
            ends = np.arange(0, 2 * len(near) + 1, 2, dtype=np.int32)
            starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(z)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(starts, pa.ListArray.from_arrays(ends, near.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(u[k : k + some]), pa.array(v[k : k + some]), lists, pa.array(far[k : k + some])], names=["gt_u", "gt_v", "near", "far"])

    return run


#: Width of a cell in reaches. A site goes to the cells that its reach touches: (1 + 2 / CELL) ** 3 on average, where cells of one reach take 27.
CELL = 2


def _cells(df: DataFrame, points: list[str], reach: float, around: bool) -> DataFrame:
    """Adds the cell (cz, cy, cx) of a point or, ``around``, one row for each cell within ``reach`` of it."""
    at = lambda p, d: F.floor((F.col(p) + F.lit(d)) / F.lit(CELL * reach)).cast("bigint")
    for p, a in zip(points, AXES):
        df = df.withColumn(f"c{a}", F.explode(F.sequence(at(p, -reach), at(p, reach))) if around else at(p, 0.0))
    return df


def matches(truth: DataFrame, found: DataFrame, reach: float) -> DataFrame:
    """(gt_u, gt_v, pred_u, pred_v, pre_d, post_d): equal labels at both ends and both ends within ``reach``.

    The label pair is an equi-join key, and the pre end's cell one more, so that a
    neuron pair with very many sites is not compared all with all.
    """
    points, ends = [f"pre_{a}" for a in AXES], [f"{k}_{a}" for k in ("pre", "post") for a in AXES]
    own = _cells(truth.select("u", "v", "pre_label", "post_label", *ends), points, reach, True).withColumnsRenamed({"u": "gt_u", "v": "gt_v"} | {e: f"g{e}" for e in ends})
    other = _cells(found.select("u", "v", "pre_label", "post_label", *ends), points, reach, False).withColumnsRenamed({"u": "pred_u", "v": "pred_v"})
    both = own.join(other, ["pre_label", "post_label", *[f"c{a}" for a in AXES]])
    both = both.withColumn("pre_d", distance("gpre_", "pre_")).withColumn("post_d", distance("gpost_", "post_"))
    return both.filter((F.col("pre_d") <= reach) & (F.col("post_d") <= reach)).select("gt_u", "gt_v", "pred_u", "pred_v", "pre_d", "post_d")


def node_matches(truth: DataFrame, found: DataFrame, reach: float, end: str = "post", *more: str) -> DataFrame:
    """(gt_u, gt_v, pred_u, pred_v, d): equal label and distance of one end. Columns ``more`` of both are added, as gt_ and pred_."""
    points = [f"{end}_{a}" for a in AXES]
    own, other = (df.select("u", "v", F.col(f"{end}_label").alias("label"), *points, *[F.col(m).alias(f"m_{m}") for m in more]) for df in (truth, found))
    own = _cells(own, points, reach, True).withColumnsRenamed({"u": "gt_u", "v": "gt_v"} | {p: f"g{p}" for p in points} | {f"m_{m}": f"gt_{m}" for m in more})
    other = _cells(other, points, reach, False).withColumnsRenamed({"u": "pred_u", "v": "pred_v"} | {f"m_{m}": f"pred_{m}" for m in more})
    both = own.join(other, ["label", *[f"c{a}" for a in AXES]])
    both = both.withColumn("d", distance(f"g{end}_", f"{end}_")).filter(F.col("d") <= reach)
    return both.select("gt_u", "gt_v", "pred_u", "pred_v", "d", *[f"{k}_{m}" for k in ("gt", "pred") for m in more])


def best(met: DataFrame, d: str = "pre_d") -> DataFrame:
    """The nearest prediction of each true site; ties by ids."""
    return met.groupBy("gt_u", "gt_v").agg(F.min(F.struct(F.col(d).alias("d"), "pred_u", "pred_v")).alias("m")).select("gt_u", "gt_v", "m.pred_u", "m.pred_v", "m.d")


def errors(truth: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """(tp, fn, fp, fp_distinct): true sites met and not; predictions less true positives, and predictions met by none."""
    n_gt, n_pred = truth.agg(F.count(F.lit(1)).alias("n_gt")), found.agg(F.count(F.lit(1)).alias("n_pred"))
    hit = met.agg(F.countDistinct("gt_u", "gt_v").alias("tp"), F.countDistinct("pred_u", "pred_v").alias("used"))
    return hit.join(F.broadcast(n_gt)).join(F.broadcast(n_pred)).select("tp", (F.col("n_gt") - F.col("tp")).alias("fn"), (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_pred") - F.col("used")).alias("fp_distinct"))


def node_errors(truth: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """(tp, fn, fp) in node mode: true nodes met and not, and predicted nodes that no true one met. ``met`` is of ``node_matches``."""
    return errors(truth, found, met).select("tp", "fn", F.col("fp_distinct").alias("fp"))


def full_sweep(truth: DataFrame, found: DataFrame, metrics: list[str], thresholds: list[float], reaches: list[float]) -> DataFrame:
    """(model, min_inf, metric, threshold, reach, tp, fp, fn) over all combinations, from one match at the widest reach.

    ``found`` has the predictions of all models and inference values (columns model, min_inf, which may hold a site once each)
    and a score for each metric; a site counts if its score is above the threshold.
    """
    sets = ["model", "min_inf"]
    spread = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("score")) for m in metrics])).alias("m")
    grid = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(float(r)).alias("reach")) for t in thresholds for r in reaches])).alias("p")
    scored = found.select(*sets, "u", "v", spread).select(*sets, "u", "v", "m.*")
    sites = found.select("u", "v", "pre_label", "post_label", *[f"{k}_{a}" for k in ("pre", "post") for a in AXES]).dropDuplicates(["u", "v"])
    met = matches(truth, sites, max(reaches)).join(scored.withColumnsRenamed({"u": "pred_u", "v": "pred_v"}), ["pred_u", "pred_v"])
    keys = [*sets, "metric", "p"]
    hit = met.select("*", grid).filter("score > p.threshold and pre_d <= p.reach and post_d <= p.reach").groupBy(*keys).agg(F.countDistinct("gt_u", "gt_v").alias("tp"))
    preds = scored.select(*sets, "metric", "score", grid).groupBy(*keys).agg(F.count_if(F.col("score") > F.col("p.threshold")).alias("n_pred"))
    both = preds.join(hit, keys, "left").join(F.broadcast(truth.agg(F.count(F.lit(1)).alias("n_gt")))).withColumn("tp", F.coalesce("tp", F.lit(0)).cast("bigint"))
    return both.select(*sets, "metric", "p.threshold", "p.reach", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"))


def error_curve(sweep: DataFrame) -> DataFrame:
    """A sweep's rows in the order of their thresholds."""
    return sweep.orderBy(*[c for c in ("model", "min_inf", "metric", "reach", "min_score", "threshold") if c in sweep.columns])


def error_sweep(truth: DataFrame, found: DataFrame, scores: list[float], reaches: list[float]) -> DataFrame:
    """(min_score, reach, tp, fp, fn) of all combinations from one match at the widest reach."""
    met = matches(truth, found.drop("score"), max(reaches)).join(found.select(F.col("u").alias("pred_u"), F.col("v").alias("pred_v"), "score"), ["pred_u", "pred_v"])
    grid = F.explode(F.array(*[F.struct(F.lit(s).alias("min_score"), F.lit(float(r)).alias("reach")) for s in scores for r in reaches])).alias("p")
    hit = met.select("*", grid).filter("score > p.min_score and pre_d <= p.reach and post_d <= p.reach").groupBy("p").agg(F.countDistinct("gt_u", "gt_v").alias("tp"))
    preds = found.select("score", grid).groupBy("p").agg(F.count_if(F.col("score") > F.col("p.min_score")).alias("n_pred"))
    n_gt = truth.agg(F.count(F.lit(1)).alias("n_gt"))
    both = preds.join(hit, "p", "left").join(F.broadcast(n_gt)).withColumn("tp", F.coalesce("tp", F.lit(0)).cast("bigint"))
    return both.select("p.min_score", "p.reach", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"))
