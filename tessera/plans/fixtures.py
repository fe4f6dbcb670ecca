"""Domain views over the driver's tables, for Spark, and the same as CTEs for SQL.

``views(spark, sf_dir)`` gives lazily built frames; ``with_views(query, *names)`` puts
the named CTEs (and those they need) before a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.geometry import packed_id

BLOCK = (50_000, 2_048, 4_096)

#: Rows of a table in a task of a self-join, at most about.
JOIN_ROWS = 1_000_000


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rag_nodes(self) -> DataFrame:
        o = self.table("orders").select(
            F.col("o_orderkey").cast("bigint").alias("id"),
            (F.lit(40) * F.datediff("o_orderdate", F.lit("1995-01-01"))).cast("bigint").alias("center_z"),
            (F.lit(4) * (F.col("o_custkey") % 1024)).cast("bigint").alias("center_y"),
            (F.lit(4) * (F.col("o_orderkey") % 2048)).cast("bigint").alias("center_x"),
        )
        block = [F.floor(F.col(f"center_{a}") / s).cast("bigint").alias(f"b{a}") for a, s in zip("zyx", BLOCK)]
        return o.select("*", *block).withColumn("block_id", F.col("bz") * 4 + F.col("by") * 2 + F.col("bx"))

    def rag_edges(self) -> DataFrame:
        li = self.table("lineitem").select("l_partkey", (F.col("l_suppkey") % 10).alias("s"), "l_linenumber", F.col("l_orderkey").cast("bigint").alias("o"), F.col("l_discount").alias("d"))
        tasks = -(-li.count() // JOIN_ROWS)
        large = tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if large:  # a task's memory does not grow with the table
            li = li.repartition(tasks, "l_partkey", "s", "l_linenumber")
        a, b = li.withColumnsRenamed({"o": "u", "d": "du"}), li.withColumnsRenamed({"o": "v", "d": "dv"})
        pairs = a.join(b, ["l_partkey", "s", "l_linenumber"]).filter("u < v")
        if large:
            pairs = pairs.repartition(tasks, "u", "v")
        return pairs.groupBy("u", "v").agg(F.min(F.round(F.abs(F.col("du") - F.col("dv")) * 10, 1)).alias("merge_score"))

    def seeds(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("bigint").alias("id"))

    def fragments(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").cast("bigint").alias("value"))

    def sf_neurons(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").cast("bigint").alias("sf"), F.concat(F.lit("n_"), (F.col("o_custkey") % 50).cast("string")).alias("neuron"))

    def neurons(self) -> DataFrame:
        c = self.table("customer").withColumn("neuron", F.concat(F.lit("n_"), (F.col("c_custkey") % 50).cast("string")))
        first = c.groupBy("neuron").agg(F.min_by(F.struct("c_custkey", "c_mktsegment", "c_nationkey"), "c_custkey").alias("c")).select("neuron", "c.*")
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return first.join(F.broadcast(nation), "c_nationkey").select(
            "neuron", F.lower("c_mktsegment").alias("cell_type"),
            (F.lit(40) * F.col("c_nationkey")).cast("bigint").alias("soma_z"), (F.lit(4) * (F.col("c_custkey") % 1024)).cast("bigint").alias("soma_y"), (F.lit(4) * (F.col("c_custkey") % 2048)).cast("bigint").alias("soma_x"),
            F.array("n_name").alias("tags"), (F.col("c_custkey") % 2 == 0).alias("finished"),
        )

    def synapses(self) -> DataFrame:
        n = self.rag_nodes()
        side = lambda key, kind: n.select(F.col("id").alias(key), *[F.col(f"center_{a}").alias(f"{kind}_{a}") for a in "zyx"])
        s = self.rag_edges().join(side("u", "pre"), "u").join(side("v", "post"), "v")
        middle = [F.floor((F.col(f"pre_{a}") + F.col(f"post_{a}")) / 2).cast("bigint").alias(a) for a in "zyx"]
        s = s.select("u", "v", "merge_score", *[f"{k}_{a}" for k in ("pre", "post") for a in "zyx"], *middle)
        return s.withColumn("id", packed_id(F.col("z"), F.col("y"), F.col("x"))).withColumn("score", F.round(1 - F.col("merge_score"), 1)).withColumnsRenamed({"u": "id_superfrag_pre", "v": "id_superfrag_post"})

    def treenodes(self) -> DataFrame:
        w = W.partitionBy("user_id").orderBy("ts", "event_id")
        e = self.table("events").withColumn("rn", F.row_number().over(w)).withColumn("arity", 1 + F.col("user_id") % 8)
        e = e.withColumn("parent_rn", F.when(F.col("rn") > 1, F.floor((F.col("rn") - 2) / F.col("arity")) + 1))
        e = e.select(F.col("event_id").alias("treenode_id"), F.col("user_id").alias("skeleton_id"), "rn", "parent_rn", (F.lit(40) * F.floor("value")).cast("bigint").alias("z"), (F.lit(4) * (F.col("event_id") % 1024)).cast("bigint").alias("y"), (F.lit(4) * (F.col("event_id") % 2048)).cast("bigint").alias("x"), "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
        parent = e.select("skeleton_id", F.col("rn").alias("parent_rn"), F.col("treenode_id").alias("parent_id"))
        label = F.when(F.col("event_type") == "error", F.col("skeleton_id") + 1_000_000).when(F.col("k") % 10 == 0, F.lit(-1)).otherwise(F.floor(F.col("skeleton_id") / 2)).cast("bigint")
        return e.join(parent, ["skeleton_id", "parent_rn"], "left").select("treenode_id", "skeleton_id", "parent_id", "z", "y", "x", label.alias("label"))

    def sites_all(self) -> DataFrame:
        s = self.synapses()
        m = self.sf_neurons()
        s = s.join(m.select(F.col("sf").alias("id_superfrag_pre"), F.substring("neuron", 3, 9).cast("bigint").alias("pre_label")), "id_superfrag_pre")
        s = s.join(m.select(F.col("sf").alias("id_superfrag_post"), F.substring("neuron", 3, 9).cast("bigint").alias("post_label")), "id_superfrag_post")
        return s

    def sites(self, kind: str, among: DataFrame | None = None) -> DataFrame:
        """Sites of a kind ``among`` those of sites_all, which a query that reads both kinds may have stored."""
        s = self.sites_all() if among is None else among
        if kind == "pred":
            s, move = s.filter("merge_score < 0.5"), F.lit(0)
        else:
            s, move = s.filter("id_superfrag_pre % 3 <> 0"), (F.col("id_superfrag_post") % 5) * 8
        return s.select(F.col("id_superfrag_pre").alias("u"), F.col("id_superfrag_post").alias("v"), "id", "score", "pre_label", "post_label", *[(F.col(f"{k}_{a}") + move).cast("bigint").alias(f"{k}_{a}") for k in ("pre", "post") for a in "zyx"])

    def voxels(self) -> DataFrame:
        e = self.table("embeddings").select(F.col("vec_id").cast("bigint").alias("z"), F.posexplode("embedding").alias("i", "e"))
        value = F.least(F.greatest(F.floor((F.col("e").cast("double") + 0.5) * 255), F.lit(0)), F.lit(255)).cast("bigint")
        return e.select("z", F.floor(F.col("i") / 8).cast("bigint").alias("y"), (F.col("i") % 8).cast("bigint").alias("x"), value.alias("value"))

    def label_voxels(self) -> DataFrame:
        e = self.table("embeddings").select(F.col("vec_id").cast("bigint").alias("z"), (F.col("label") + 1).cast("bigint").alias("l"))
        return self.voxels().join(e, "z").select("z", "y", "x", F.when(F.col("value") > 160, F.col("l")).otherwise(F.lit(0)).cast("bigint").alias("label"))

    def events_done(self) -> DataFrame:
        last = self.table("events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
        return last.select(F.col("user_id").alias("block_id"), F.col("last").isin("purchase", "view").alias("done"))


SQL = {
    "rag_nodes": """SELECT *, bz * 4 + "by" * 2 + bx AS block_id FROM (
        SELECT *, floor(center_z / 50000)::BIGINT AS bz, floor(center_y / 2048)::BIGINT AS "by", floor(center_x / 4096)::BIGINT AS bx FROM (
            SELECT o_orderkey::BIGINT AS id, (40 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE))::BIGINT AS center_z,
                   (4 * (o_custkey % 1024))::BIGINT AS center_y, (4 * (o_orderkey % 2048))::BIGINT AS center_x FROM orders))""",
    "rag_edges": """SELECT a.l_orderkey::BIGINT AS u, b.l_orderkey::BIGINT AS v, min(round(abs(a.l_discount - b.l_discount) * 10, 1)) AS merge_score
        FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey % 10 = b.l_suppkey % 10 AND a.l_linenumber = b.l_linenumber AND a.l_orderkey < b.l_orderkey GROUP BY 1, 2""",
    "seeds": "SELECT o_orderkey::BIGINT AS id FROM orders WHERE o_orderstatus = 'P'",
    "sf_neurons": "SELECT o_orderkey::BIGINT AS sf, 'n_' || (o_custkey % 50)::VARCHAR AS neuron FROM orders",
    "neurons": """SELECT 'n_' || (c_custkey % 50)::VARCHAR AS neuron, lower(c_mktsegment) AS cell_type, (40 * c_nationkey)::BIGINT AS soma_z, (4 * (c_custkey % 1024))::BIGINT AS soma_y,
        (4 * (c_custkey % 2048))::BIGINT AS soma_x, n_name AS tag, c_custkey % 2 = 0 AS finished
        FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey % 50 ORDER BY c_custkey) AS rn FROM customer) JOIN nation ON n_nationkey = c_nationkey WHERE rn = 1""",
    "synapses": """SELECT *, (z << 42) | (y << 21) | x AS id FROM (
        SELECT e.u AS id_superfrag_pre, e.v AS id_superfrag_post, e.merge_score, round(1 - e.merge_score, 1) AS score,
        a.center_z AS pre_z, a.center_y AS pre_y, a.center_x AS pre_x, b.center_z AS post_z, b.center_y AS post_y, b.center_x AS post_x,
        floor((a.center_z + b.center_z) / 2)::BIGINT AS z, floor((a.center_y + b.center_y) / 2)::BIGINT AS y, floor((a.center_x + b.center_x) / 2)::BIGINT AS x
        FROM rag_edges e JOIN rag_nodes a ON a.id = e.u JOIN rag_nodes b ON b.id = e.v)""",
    "ranked_events": """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events""",
    "treenodes": """SELECT c.event_id AS treenode_id, c.user_id AS skeleton_id, p.event_id AS parent_id, (40 * floor(c.value))::BIGINT AS z, (4 * (c.event_id % 1024))::BIGINT AS y, (4 * (c.event_id % 2048))::BIGINT AS x,
        (CASE WHEN c.event_type = 'error' THEN c.user_id + 1000000 WHEN (c.props->>'$.k')::BIGINT % 10 = 0 THEN -1 ELSE floor(c.user_id / 2) END)::BIGINT AS label
        FROM ranked_events c LEFT JOIN ranked_events p ON p.user_id = c.user_id AND c.rn > 1 AND p.rn = floor((c.rn - 2) / (1 + c.user_id % 8)) + 1""",
    "sites_all": """SELECT s.*, substr(a.neuron, 3)::BIGINT AS pre_label, substr(b.neuron, 3)::BIGINT AS post_label FROM synapses s JOIN sf_neurons a ON a.sf = id_superfrag_pre JOIN sf_neurons b ON b.sf = id_superfrag_post""",
    "sites_pred": "SELECT id_superfrag_pre AS u, id_superfrag_post AS v, id, score, pre_label, post_label, pre_z, pre_y, pre_x, post_z, post_y, post_x FROM sites_all WHERE merge_score < 0.5",
    "sites_gt": """SELECT id_superfrag_pre AS u, id_superfrag_post AS v, id, score, pre_label, post_label, pre_z + m AS pre_z, pre_y + m AS pre_y, pre_x + m AS pre_x, post_z + m AS post_z, post_y + m AS post_y, post_x + m AS post_x
        FROM (SELECT *, (id_superfrag_post % 5) * 8 AS m FROM sites_all WHERE id_superfrag_pre % 3 <> 0)""",
    "voxels": """SELECT vec_id::BIGINT AS z, floor(i / 8)::BIGINT AS y, (i % 8)::BIGINT AS x, least(greatest(floor((e::DOUBLE + 0.5) * 255), 0), 255)::BIGINT AS value, label
        FROM (SELECT vec_id, label, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)""",
    "label_voxels": "SELECT z, y, x, (CASE WHEN value > 160 THEN label + 1 ELSE 0 END)::BIGINT AS label FROM voxels",
    "completion": """SELECT user_id AS block_id, arg_max(event_type, (ts, event_id)) IN ('purchase', 'view') AS done FROM events GROUP BY user_id""",
}
NEEDS = {
    "synapses": ["rag_nodes", "rag_edges"], "treenodes": ["ranked_events"], "sites_all": ["synapses", "sf_neurons"], "sites_pred": ["sites_all"], "sites_gt": ["sites_all"], "label_voxels": ["voxels"],
}


def with_views(query: str, *names: str, recursive: bool = False, more: dict[str, str] | None = None) -> str:
    """The query after its CTEs; ``more`` are further CTEs (name, with a column list if recursive) in order."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        out.setdefault(name, SQL[name])

    for name in names:
        add(name)
    out |= more or {}
    body = ", ".join(f"{name} AS ({text})" for name, text in out.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{body} {query}"


def components_cte(edges: str, nodes: str, name: str = "cc") -> dict[str, str]:
    """CTEs for (id, component) by reachability: the oracle's own way, independent of the engine's."""
    return {
        f"{name}_both": f"SELECT u AS a, v AS b FROM {edges} UNION SELECT v, u FROM {edges}",
        f"{name}_walk(id, component)": f"SELECT id, id FROM {nodes} UNION SELECT b.b, w.component FROM {name}_walk w JOIN {name}_both b ON b.a = w.id WHERE w.component < b.b",
        name: f"SELECT id, min(component) AS component FROM {name}_walk GROUP BY id",
    }
