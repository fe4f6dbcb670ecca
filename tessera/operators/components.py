"""Connected components by alternating large-star and small-star rounds.

The algorithm of Kiveris et al. ("Connected Components in MapReduce and
Beyond", SoCC 2014): every round is two grouped minima and two joins, needs
O(log^2 n) rounds, and keeps at most one edge per input edge, so a chain, a
hub or one giant component behave alike. Nothing but two checksums, taken while a round is
written, reaches the driver. Each round is written to the shared scratch folder. The minima are
combined before the exchange; the join that hands a node's least neighbour to its links deals
the links of hubs over several tasks. Rounds have a session of their own, with tasks of about
TASK_ROWS rows, so that memory of a task does not grow with the links.

Longer lists are united within lots of near ids first, so that rounds only see what is left between lots. Edge lists of at most SMALL rows are finished by union-find in one task: SMALL bounds its memory. Longer ones
come to that after some rounds, where stars shrink them, or run to the end.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.skew import for_salts, salted
from tessera.session import counted, drop_table, materialize


SMALL = 200_000

#: Rows of a task of a round, about; links of a node beyond which it is a hub.
TASK_ROWS, HUB = 500_000, 100_000

#: Row groups that tasks can share a file by: about TASK_ROWS links.
ROW_GROUPS = {"parquet.block.size": str(4 << 20)}


def _sized(spark: SparkSession, rows: int) -> SparkSession:
    """A session over the same context, whose tasks get about TASK_ROWS of so many links in both directions; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * rows // TASK_ROWS))))
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        own.conf.set(key, "4m")
    return own


def _read_by(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A frame of ``materialize``, read by another session."""
    moved = spark.read.schema(table.schema).parquet(table._scratch)
    moved._scratch = table._scratch
    return moved


def _with_least(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (u, v) with the least m of u and all its v, and (u, m, n) by itself. A hub's rows are dealt over several tasks."""
    least, most = _degrees(both)
    if most <= HUB:
        return both.join(least.select("u", "m"), "u"), least
    hubs = least.filter(F.col("n") > HUB).select("u")
    return salted(both, "u", hubs, F.col("v")).join(for_salts(least.select("u", "m"), "u", hubs), ["u", "salt"]).drop("salt"), least


def _degrees(both: DataFrame) -> tuple[DataFrame, int]:
    """(u, m, n) with each u's least node and number of rows, and the largest such number."""
    from pyspark.sql import Observation

    seen = Observation()
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    table = materialize(least.observe(seen, F.max("n").alias("most")), "cc-least", **ROW_GROUPS)
    return table, seen.get["most"] or 0


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """One star round on (u, v) rows with u > v, and the table that it reads besides. Hubs are reduced map-side before the join."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    linked, least = _with_least(both)
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct(), least


def _round(edges: DataFrame) -> tuple[DataFrame, int, int | None]:
    """A large and a small star, written, with the number of rows and their checksum."""
    large, first = _star(edges, True)
    between = materialize(large, "cc-large", **ROW_GROUPS)
    drop_table(first)
    small, second = _star(between, False)
    found = counted(small, "cc", "u", "v", **ROW_GROUPS)
    drop_table(second, between)
    return found


def _least_reached(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) of links, whose first ends come before all second ones."""
    nodes, ends = np.unique(ends, return_inverse=True)
    half = len(ends) // 2
    root = list(range(len(nodes)))
    for a, b in zip(ends[:half].tolist(), ends[half:].tolist()):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a < b:  # nodes are sorted: the lesser place is the lesser id
            root[b] = a
        else:
            root[a] = b
    top = np.array(root)
    while True:
        above = top[top]
        if (above == top).all():
            return nodes, nodes[top]
        top = above


def _united(edges: DataFrame) -> DataFrame:
    """(node, component) of at most SMALL edges, in one task."""
    def run(stream):
        import pyarrow as pa

        u, v = [], []
        for batch in stream:
            u.append(batch.column("u").to_numpy())
            v.append(batch.column("v").to_numpy())
        if not u:
            return
        nodes, least = _least_reached(np.concatenate([*u, *v]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(run, "node bigint, component bigint")


def _stars(edges: DataFrame) -> DataFrame:
    """(node, least): each node of a lot of at most about TASK_ROWS links of a task, and the least that it reaches by them."""
    def run(stream):
        import pyarrow as pa

        def found():
            return pa.RecordBatch.from_arrays([pa.array(c) for c in _least_reached(np.concatenate([*u, *v]))], names=["node", "least"])

        u, v, held = [], [], 0
        for batch in stream:
            u.append(batch.column("u").to_numpy())
            v.append(batch.column("v").to_numpy())
            held += batch.num_rows
            if held >= TASK_ROWS:
                yield found()
                u, v, held = [], [], 0
        if held:
            yield found()

    return edges.mapInArrow(run, "node bigint, least bigint")


def _by_lots(links: DataFrame, rows: int) -> DataFrame:
    """(node, least, others): the least that a node reaches within one of its lots, and those of its other lots. Links between these are left.

    Lots are ranges of ids: where linked nodes have near ids, as those numbered by place have, few links are left.
    """
    lots = _stars(links.repartitionByRange(-(-rows // TASK_ROWS), "v"))
    own = lots.groupBy("node").agg(F.min("least").alias("least"), F.collect_set("least").alias("all"))  # one a lot at most
    own = materialize(own.select("node", "least", F.array_remove("all", F.col("least")).alias("others")), "cc-lots", **ROW_GROUPS)
    return own


def component_edges(edges: DataFrame, max_rounds: int = 60, small: int | None = None) -> DataFrame:
    """(u, v) links to (node, component): every linked node with the least node id it reaches.

    Self links and null ends are ignored; repeated and reversed links count once. ``small`` replaces SMALL, and leaves lots out.
    """
    lots, small = small is None, SMALL if small is None else small
    links = (
        edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
        .filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    caller = edges.sparkSession
    current, *before = counted(links, "cc", "u", "v", **ROW_GROUPS)
    if before[0] > small:
        current = _read_by(_sized(caller, before[0]), current)
        if lots:
            own = _read_by(caller, _by_lots(current, before[0]))
            drop_table(current)
            left = component_edges(own.select(F.explode("others").alias("u"), F.col("least").alias("v")), max_rounds, small)
            return own.join(left.withColumnRenamed("node", "least"), "least", "left").select("node", F.coalesce("component", "least").alias("component"))
    for _ in range(max_rounds):
        if before[0] <= small:
            found = materialize(_united(current), "cc-united")
            drop_table(current)
            return _read_by(caller, found)
        following, *after = _round(current)
        drop_table(current)
        current = following
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    current = _read_by(caller, current)
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id) nodes and (u, v) edges to (id, component); a node without edges is its own component.

    The component id is the least node id in it. Ends of edges that are no rows of
    ``nodes`` still connect but are not returned.
    """
    found = component_edges(edges)
    return nodes.select("id").distinct().join(found, F.col("id") == F.col("node"), "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )
