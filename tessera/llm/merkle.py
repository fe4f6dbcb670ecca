"""Merkle manifest of a table: a tree for each source, a tree over the sources, and proofs by coordinate lookup.

1. *Leaves.* A row's leaf is the hash of its fields; the text is read once, for the leaf and its tampered twin.
2. *Places.* Leaves are dealt by ranges of (source, id, leaf) and sorted; a leaf's index in its tree is
   its place in its range less the source's first place there plus the rows of earlier ranges. Only one row a
   (range, source) is counted, so that a source with most of all rows is not one task.
3. *Node table.* TIER levels at a time: FANOUT**TIER neighbouring nodes are a group, which makes the nodes of the
   levels above them. Each tier is written to the shared folder with its coordinates (tree, level, index).
4. *Proofs.* From index and group size a node's required sibling coordinates follow; they are exploded,
   joined with the tier's nodes, and put in order. A key of that join is wanted by at most FANOUT**TIER nodes. A
   leaf does this for the lowest tier only: what stands above is that of its ancestor, looked up once there and handed
   down, so no node near the root is looked up by every leaf.
5. *Fold.* Siblings left and right of a node are concatenated around its digest and hashed, level by level.

Edge cases: null fields are ``-``; a null source comes first and is a tree of its own, not that of the empty string; null ids come
first in their tree; rows that share id and source are leaves each, in order of their leaf; a lone leaf
is its subroot, a lone subroot the root, and a proof without siblings is the hash of nothing; an empty
table gives no rows; texts of any length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import SMALL_STARTS, named, placed, table
from tessera.session import drop_table, materialize

FANOUT, TIER = 3, 4
#: Where a row's path goes on: its ancestor's index in the next tier, or the path of its whole tree.
_TOP = -1


def digest_of(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return digest_of(*[field(v) for v in values])


def tampered_id(doc_id: Column) -> Column:
    """Whether this row is tampered with: the crc32 of its decimal id is even. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and the leaf after every newline of the text was deleted, where ``tampered`` (over the five columns) says so."""
    rows = named(docs, **{c: c for c in ("doc_id", "source", "lang", "n_chars", "text")})
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    shorter = F.translate("text", "\n", "")
    changed = F.when(tampered_id(F.col("doc_id")) if tampered is None else tampered, leaf_of(*head, shorter))
    return rows.select("doc_id", "source", leaf_of(*head, F.col("text")).alias("leaf"), changed.alias("tampered"))


def height_of(n: Column, fanout: int = FANOUT) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    powers, power = [], 1
    while power < 1 << 63:
        powers.append(F.lit(power))
        power *= fanout
    return F.size(F.filter(F.array(*powers), lambda p: p < n))


def node_tiers(leaves_: DataFrame, fanout: int = FANOUT, tier: int = TIER) -> list[DataFrame]:
    """Tables (tree, n, level, index, digest): the k-th holds the levels k * tier to (k + 1) * tier, from rows (tree, n, index, digest).

    ``n`` stays the number of the tree's leaves. The last level of a table is the first of the next.
    """
    tall = leaves_.agg(F.max(height_of(F.col("n"), fanout))).first()[0] or 0
    base, out = leaves_.select("tree", "n", F.lit(0).alias("level"), "index", "digest"), []
    for low in range(0, max(1, tall), tier):
        members = base.filter(height_of(F.col("n"), fanout) > low)
        block = members.groupBy("tree", "n", F.expr(f"index div {fanout**tier}").alias("block"))
        made = block.agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "digest"))), lambda x: x["digest"]).alias("d0"))
        top = height_of(F.col("n"), fanout)
        for k in range(1, tier + 1):
            last, count = F.col(f"d{k - 1}"), F.ceil(F.size(f"d{k - 1}") / fanout).cast("int")
            run = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.sha2(F.array_join(F.slice(last, i * fanout + 1, fanout), ""), 256))  # noqa: B023
            made = made.withColumn(f"d{k}", F.when(F.lit(low + k) <= top, run).otherwise(F.array().cast("array<string>")))
        each = [F.transform(f"d{k}", lambda d, i: F.struct(F.lit(low + k).alias("level"), (F.col("block") * fanout ** (tier - k) + i).alias("index"), d.alias("digest"))) for k in range(1, tier + 1)]  # noqa: B023
        nodes = made.select("tree", "n", F.explode(F.concat(*each)).alias("x")).select("tree", "n", "x.level", "x.index", "x.digest")
        nodes = materialize(nodes, "merkle-nodes")
        out.append(base.unionByName(nodes))
        base = nodes.filter(F.col("level") == low + tier)
    return out


def tree_roots(tiers: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(tree, digest) of the topmost node of each tree."""
    tops = [t.filter(F.col("level") == height_of(F.col("n"), fanout)).select("tree", "digest") for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out.distinct()  # the last level of a tier is also the first of the next


def tier_paths(nodes: DataFrame, low: int, fanout: int = FANOUT, tier: int = TIER) -> DataFrame:
    """(tree, n, index, steps) of the nodes of level ``low``: array of (left, right), the siblings' digests level by level within this tier."""
    tall, none = height_of(F.col("n"), fanout), F.array().cast("array<struct<level:int,sibling:bigint,left:boolean>>")
    coordinates = []
    for level in range(low, low + tier):  # the siblings that the node's ancestor at this level has
        below, above = fanout ** (level - low), fanout ** (level - low + 1)
        mine, first = F.expr(f"index div {below}"), F.expr(f"index div {above} * {fanout}")
        last = F.least(first + fanout - 1, F.expr(f"(n - 1) div {fanout**level}"))
        others = F.filter(F.sequence(first, last), lambda i: i != mine)  # noqa: B023
        asked = F.transform(others, lambda i: F.struct(F.lit(level).alias("level"), i.alias("sibling"), (i < mine).alias("left")))  # noqa: B023
        coordinates.append(F.when(tall > level, asked).otherwise(none))
    start = nodes.filter(F.col("level") == low).select("tree", "n", "index", F.explode_outer(F.concat(*coordinates)).alias("x"))
    known = nodes.filter(F.col("level") < low + tier).select("tree", "level", F.col("index").alias("sibling"), "digest")
    met = start.select("tree", "n", "index", "x.*").join(known, ["tree", "level", "sibling"], "left")
    one = F.when(F.col("level").isNotNull(), F.struct("level", "sibling", "left", "digest"))
    got = met.groupBy("tree", "n", "index").agg(F.array_sort(F.collect_list(one)).alias("found"))

    def side(level: int, left: bool) -> Column:
        return F.array_join(F.transform(F.filter("found", lambda x: (x["level"] == level) & (x["left"] == left)), lambda x: x["digest"]), "")

    steps = [F.when(tall > level, F.struct(side(level, True).alias("left"), side(level, False).alias("right"))) for level in range(low, low + tier)]
    return got.select("tree", "n", "index", F.array_compact(F.array(*steps)).alias("steps"))


def forest_paths(tiers: list[DataFrame], above: DataFrame, fanout: int = FANOUT, tier: int = TIER) -> DataFrame:
    """(tree, index, n, subroot, steps) of all leaves; ``above`` has (tree, subroot, steps): a tree's topmost node and its own path."""
    tall = height_of(F.col("n"), fanout)
    out, written = None, []
    for k in reversed(range(len(tiers))):
        low = k * tier
        own = tier_paths(tiers[k], low, fanout, tier)
        ends = tall <= low + tier  # the tree's topmost node is in this tier
        own = own.filter((tall > low) | F.lit(low == 0)).withColumn("parent", F.when(ends, F.lit(_TOP)).otherwise(F.expr(f"index div {fanout**tier}")))
        ancestors = above.select("tree", F.lit(_TOP).cast("bigint").alias("parent"), "subroot", F.col("steps").alias("rest"))
        if out is not None:
            ancestors = ancestors.unionByName(out.select("tree", F.col("index").alias("parent"), "subroot", F.col("steps").alias("rest")))
        joined = own.join(ancestors, ["tree", "parent"]).select("tree", "index", "n", "subroot", F.concat("steps", "rest").alias("steps"))
        out = materialize(joined, "merkle-paths") if k else joined
        written.append(out)
    return out


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a digest and its siblings."""
    return F.aggregate(steps, start, lambda have, s: F.sha2(F.concat(s["left"], have, s["right"]), 256))


def proof_of(steps: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, tier: int = TIER) -> DataFrame:
    """A row for each row of ``docs``: doc_id, source, index (in its source's tree), leaf, tampered (null: as it is), subroot, root, steps."""
    key = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), "source"))
    own = materialize(leaves(docs, tampered).withColumn("key", key), "merkle-leaves")
    rows = placed(own, ["key"], ["doc_id", "leaf"])
    drop_table(own)
    trees = rows.groupBy("key").agg(F.max("n").alias("n_rows")).withColumn("all", F.lit(0))
    trees = materialize(placed(trees, ["all"], ["key"]).select("key", "n_rows", F.col("index").alias("tree"), F.col("n").alias("n_trees")), "merkle-trees")
    small = F.broadcast(trees) if trees.count() <= SMALL_STARTS else trees
    rows = rows.join(small.select("key", "tree"), "key").drop("key")
    rows = materialize(rows.select("doc_id", "source", "tree", "n", "index", "leaf", "tampered"), "merkle-rows")
    tiers = node_tiers(rows.select("tree", "n", "index", F.col("leaf").alias("digest")), fanout, tier)
    subroots = tree_roots(tiers, fanout).join(trees, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.col("n_trees").alias("n"), F.col("tree").alias("index"), "digest")
    subroots = materialize(subroots, "merkle-subroots")
    over = node_tiers(subroots, fanout, tier)
    found = tree_roots(over, fanout).first()
    root = F.lit(found["digest"] if found else None).cast("string")
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    top = subroots.select("tree", F.col("digest").alias("subroot"), no_steps.alias("steps")).limit(0) if found is None else tree_roots(over, fanout).select("tree", F.col("digest").alias("subroot"), no_steps.alias("steps"))
    paths = forest_paths(over, top, fanout, tier).select(F.col("index").alias("tree"), "steps").join(subroots.select(F.col("index").alias("tree"), F.col("digest").alias("subroot")), "tree")
    paths = materialize(paths, "merkle-over")
    whole = forest_paths(tiers, paths, fanout, tier)
    return rows.drop("n").join(whole.drop("n"), ["tree", "index"]).select("doc_id", "source", "index", "leaf", "tampered", "subroot", root.alias("root"), "steps")


def verified(manifest_: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of the rows of a manifest."""
    again = folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    out = manifest_.select("doc_id", "leaf", "subroot", "root", proof_of(F.col("steps")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return verified(manifest(table(spark, sf_dir, "documents")))


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
#: DuckDB has no crc32: eight rounds a byte, from the polynomial.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen({0}) + 1), lambda i:
    [-(ascii({0}[i]) + 1)::BIGINT, -1000, -1000, -1000, -1000, -1000, -1000, -1000, -1000]))), lambda c, x:
    CASE WHEN x = -1000 THEN CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END ELSE xor(c, -x - 1) END)"""
_UP = """SELECT tree, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 2) // 3
         FROM {0} WHERE n > 1 GROUP BY tree, level, i // 3"""
ORACLE = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree,
                sha256({_HEAD} || {_FIELD.format("text")}) AS leaf,
                CASE WHEN {_CRC.format("(doc_id::VARCHAR)")} % 2 = 1 THEN sha256({_HEAD} || {_FIELD.format("replace(text, chr(10), '')")}) END AS tampered
            FROM documents),
        rows_ AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
        nodes(tree, level, i, digest, n) AS (SELECT tree, 0, i, leaf, n FROM rows_ UNION ALL {_UP.format("nodes")}),
        subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        over_(tree, level, i, digest, n) AS (SELECT 'all', 0, i, digest, n FROM subroots UNION ALL {_UP.format("over_")}),
        steps AS (
            SELECT r.doc_id, r.leaf, r.tree, l.level, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i < r.i // (3 ** l.level)::BIGINT), '') AS lo,
                coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i > r.i // (3 ** l.level)::BIGINT), '') AS hi
            FROM rows_ r JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) l ON l.tree = r.tree
                JOIN nodes s ON s.tree = r.tree AND s.level = l.level AND s.i // 3 = r.i // (3 ** (l.level + 1))::BIGINT GROUP BY ALL),
        above AS (
            SELECT r.tree, r.digest AS subroot, 1000 + l.level AS level, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i < r.i // (3 ** l.level)::BIGINT), '') AS lo,
                coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i > r.i // (3 ** l.level)::BIGINT), '') AS hi
            FROM subroots r JOIN (SELECT DISTINCT level FROM over_ WHERE n > 1) l ON true
                JOIN over_ s ON s.level = l.level AND s.i // 3 = r.i // (3 ** (l.level + 1))::BIGINT GROUP BY ALL),
        paths AS (
            SELECT doc_id, leaf, tree, level, lo, hi FROM steps
            UNION ALL SELECT r.doc_id, r.leaf, r.tree, a.level, a.lo, a.hi FROM rows_ r JOIN above a ON a.tree = r.tree),
        whole AS (SELECT doc_id, leaf, tree, list(lo || '|' || hi ORDER BY level) AS p FROM paths GROUP BY ALL)
        SELECT r.doc_id, r.leaf, s.digest AS subroot, t.digest AS root, sha256(replace(array_to_string(coalesce(w.p, []), ''), '|', '')) AS proof_sha256,
            list_reduce(list_prepend(coalesce(r.tampered, r.leaf), coalesce(w.p, [])), lambda c, x: sha256(split_part(x, '|', 1) || c || split_part(x, '|', 2))) AS folded_root,
            folded_root = t.digest AS verified
        FROM rows_ r JOIN subroots s ON s.tree = r.tree JOIN over_ t ON t.n = 1 LEFT JOIN whole w ON w.doc_id = r.doc_id AND w.leaf = r.leaf AND w.tree = r.tree""",
}
