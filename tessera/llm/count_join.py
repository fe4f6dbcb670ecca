"""Exact n-gram Jaccard join by R-trees over vectors of group counts.

1. *Points.* A document's distinct shingles (64-bit hashes) are dealt into groups by their low bits; the
   counts by group are its point. Two sets share at most the sum of the lesser counts. Long sets have more groups, a power of two, so that a group
   holds about PER_GROUP shingles; counts fold to fewer groups by adding halves. Equal sets are one class from here on.
2. *Partitions.* Linked sets share one of each one's first ``prefix_size`` tokens in any order of all tokens. The
   order is by hash, with common tokens behind all others: a passage that many documents share
   is no partition of theirs unless they hold little else. What is common is read from counts of all tokens of all documents, by
   hash, in MOST_CELLS cells at most. Rows of a token are a partition of the join.
3. *Stars.* Each member of a partition first meets only the least one; pairs within the bound are verified, and
   verified links give components, so that copies of one text need no pairs among each other.
4. *Tree.* The other members of partitions with several components are bulk-loaded: those of one size band are sorted by large
   component and a Morton code of their counts, and cut in leaves of LEAF points. A leaf's box is the greatest count in each
   group. Leaves of the same or neighbouring bands meet if they are not of one component and the sum of the lesser
   box coordinates allows a link; in such pairs of leaves points meet by the same bound on their own counts.
5. *Verification.* Of the surviving pairs between two components the one of greatest bound is verified on the full sets first; the others
   only if the components are still apart.

No step loses a link: the order of tokens, bounds, bands and boxes are all exact; shingles are told apart by 64 bits.

Edge cases: as in the near-duplicate operator: null, empty and blank texts have no shingles and are linked with nothing;
fewer words than a shingle are one shingle of the whole sequence; a null id has no component;
rows that share an id are one node, linked with all that any of their texts is linked with, and each row has its own
text's n_shingles; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, placed, salted, slices, table
from tessera.llm.near_dedup import ORACLE as _NEAR
from tessera.llm.near_dedup import _beside, bucket_components, confirmed, row_components, shingle_sets
from tessera.operators.components import component_edges
from tessera.session import drop_table, materialize

WIDTH, PERCENT = 5, 80
GROUPS, PER_GROUP = 64, 2
#: Points of a leaf of the tree.
LEAF = 128
#: Rows of leaf members that one task of the tree join holds at about.
DEALT = 4000
#: Tokens of a cell with more than COMMON of them, and more than OVER_MEAN times a cell's mean, are common. Cells: one for LOAD tokens, within bounds.
COMMON, OVER_MEAN, LOAD, FEWEST_CELLS, MOST_CELLS, CELL_SLICE = 128, 4, 32, 1 << 16, 1 << 22, 1 << 13
#: Tokens that a document is taken to have where the number of cells is chosen.
TOKENS_PER_ROW = 512
#: Documents that a worker holds the tokens of at once.
ROWS = 500
#: Rows of small lists up to which they are sent to every executor; beyond it, a shuffled join.
SMALL_LIST = 200_000


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of n of which one at least is shared with any linked set."""
    return n - -(-percent * n // 100) + 1 if n else 0


def group_counts(shingles: np.ndarray, per_group: int = PER_GROUP) -> np.ndarray:
    """Counts by group of a set, uint8: GROUPS times a power of two of them, so many that every count fits."""
    groups = GROUPS
    while groups * per_group < len(shingles):
        groups *= 2
    counts = np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    while counts.max(initial=0) > 255:
        groups *= 2
        counts = np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return counts.astype(np.uint8)


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """Rows of counts in fewer groups: a group's number keeps its low bits."""
    return counts.reshape(len(counts), -1, groups).sum(axis=1, dtype=np.int32) if counts.shape[1] > groups else counts


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """The bound: the sum of the lesser counts."""
    groups = min(len(a), len(b))
    return int(np.minimum(fold(a[None], groups), fold(b[None], groups)).sum(dtype=np.int64))


def may_link(shared, n, m, percent: int):
    """Whether sets of n and m tokens that share at most ``shared`` may be linked."""
    return 100 * shared >= percent * (n + m - shared)


def morton(counts: np.ndarray) -> int:
    """Interleaved bits of eight coarse coordinates, as shares of the whole, in 32 levels."""
    coarse = fold(counts[None], 8)[0]
    level = np.minimum(31, coarse.astype(np.int64) * 8 * 16 // max(1, int(coarse.sum())))
    return int(sum(int((level[i] >> (4 - bit)) & 1) << (39 - bit * 8 - i) for bit in range(5) for i in range(8)))


def cell_of(tokens: np.ndarray, cells: int) -> np.ndarray:
    return ((tokens >> np.uint64(16)) & np.uint64(cells - 1)).astype(np.int64)


def common_cells(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Which cells hold common tokens, from all tokens of all rows (doc_id, text).

    A task counts in one array and sends it in slices, each count up to 255; sums of a slice are taken row by row. One bit a cell
    reaches the driver, and from there the workers: MOST_CELLS bits at most, whatever the corpus. Where cells are few for a corpus, fewer tokens
    stand out; that changes the order of tokens and with it the work, never a result.
    """
    cells = FEWEST_CELLS
    rows = docs.count()
    while cells < MOST_CELLS and cells * LOAD < rows * TOKENS_PER_ROW:
        cells *= 2

    def counted(stream):
        import pyarrow as pa

        counts, held, size = np.zeros(cells, np.int32), [], 0
        for batch in slices(stream, ROWS):
            for own in shingle_sets(batch.column("text"), width):
                held.append(own)
                size += len(own)
                if size > 1_000_000:
                    counts += np.bincount(cell_of(np.concatenate(held), cells), minlength=cells).astype(np.int32)
                    held, size = [], 0
        if held:
            counts += np.bincount(cell_of(np.concatenate(held), cells), minlength=cells).astype(np.int32)
        few = np.minimum(counts, 255).astype(np.uint8)
        for k in range(0, cells if few.any() else 0, CELL_SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([k // CELL_SLICE], pa.int32()), pa.array([few[k : k + CELL_SLICE].tobytes()], pa.binary())], names=["slice", "counts"])

    def summed(stream):
        import pyarrow as pa

        def row(at, total):
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([int(total.sum())], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["slice", "total", "sums"])

        at, total = None, None
        for batch in stream:
            for own, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                if own != at:
                    if at is not None:
                        yield row(at, total)
                    at, total = own, np.zeros(CELL_SLICE, np.int64)
                total += np.frombuffer(counts.as_buffer(), np.uint8)
        if at is not None:
            yield row(at, total)

    parts = docs.select("text").mapInArrow(counted, "slice int, counts binary").repartition("slice").sortWithinPartitions("slice")
    sums = materialize(parts.mapInArrow(summed, "slice int, total bigint, sums binary"), "join-cells")
    most = max(COMMON, OVER_MEAN * (sums.agg(F.sum("total")).first()[0] or 0) / cells)

    def marked(stream):
        import pyarrow as pa

        for batch in stream:
            bits = [np.packbits(np.frombuffer(x.as_buffer(), np.int64) > most).tobytes() for x in batch.column("sums")]
            yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(bits, pa.binary())], names=["slice", "bits"])

    out = np.zeros((cells // CELL_SLICE, CELL_SLICE // 8), np.uint8)
    for r in sums.select("slice", "sums").mapInArrow(marked, "slice int, bits binary").collect():
        out[r.slice] = np.frombuffer(r.bits, np.uint8)
    drop_table(sums)
    return np.unpackbits(out.ravel()).astype(bool)


def points(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, common: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_shingles, digest, counts, curve and the first tokens of every row (doc_id, text), in the order of (common cell, hash)."""
    shared = docs.sparkSession.sparkContext.broadcast(np.zeros(1, bool) if common is None else common)

    def run(stream):
        import pyarrow as pa

        last = shared.value
        for batch in slices(stream, ROWS):
            sizes, digests, counts, curves, tokens = [], [], [], [], []
            for own in shingle_sets(batch.column("text"), width):
                some = len(own) > 0
                count = group_counts(own)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if some else None)
                counts.append(count.tobytes() if some else None)
                curves.append(morton(count))
                tokens.append(reordered(own, last[cell_of(own, len(last))], percent).view(np.int64))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(counts, pa.binary()), pa.array(curves, pa.int64()), _lists(tokens)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "counts", "curve", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, counts binary, curve bigint, tokens array<bigint>")


def _lists(arrays: list[np.ndarray]):
    import pyarrow as pa

    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def reordered(own: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a sorted set; those marked ``last`` come behind the others."""
    most = prefix_size(len(own), percent)
    first = own[~last][:most]
    return first if len(first) == most else np.concatenate([first, own[last][: most - len(first)]])


def _near_list(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_LIST else df


def _bounded(percent: int):
    def run(stream):
        import pyarrow as pa

        for batch in stream:
            shared = [most_shared(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)) for a, b in zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist())]
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(may_link(np.array(shared, np.int64), n, m, percent)))

    return run


def _boxed(stream):
    """(node, box): counts in GROUPS coordinates."""
    import pyarrow as pa

    for batch in stream:
        boxes = [fold(np.frombuffer(c, np.uint8)[None], GROUPS)[0].astype(np.int64) for c in batch.column("counts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(boxes)], names=["node", "box"])


def leaves(members: DataFrame, nodes: DataFrame, stars: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """Members (key, node, component) with their place in the tree: band, leaf, n and whether the leaf is one of several of its band.

    A band holds sizes within a factor of the similarity, so linked sets are in the same or neighbouring bands.
    """
    band = F.floor(F.log("n_shingles") / (np.log(100 / percent) * (1 + 1e-9))).cast("int")
    large = stars.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= leaf).select("component", F.lit(True).alias("large"))
    large = materialize(large, "join-large")
    rows = members.select("key", "node", "component").join(nodes.select("node", "n_shingles", "curve"), "node")
    rows = rows.join(_near_list(large), "component", "left")
    order = F.when(F.col("large"), F.col("component")).otherwise(-1)
    rows = rows.select("key", band.alias("band"), "node", "component", "n_shingles", "curve", order.alias("block"))
    found = placed(rows, ["key", "band"], ["block", "curve", "node"])
    return found.select("key", "band", F.expr(f"index div {leaf}").alias("leaf"), "node", "component", "n_shingles", (F.col("n") > leaf).alias("cut"))


def meeting(placed_: DataFrame, boxes: DataFrame, percent: int) -> DataFrame:
    """(key, band_a, leaf_a, band_b, leaf_b, rows) of the pairs of leaves that may hold a link between two components."""
    ends = [f(c).alias(f"{name}_{c}") for c in ("component", "n_shingles") for f, name in ((F.min, "low"), (F.max, "high"))]
    own = placed_.groupBy("key", "band", "leaf").agg(*ends, F.count(F.lit(1)).alias("rows"))
    box = placed_.filter("cut").select("key", "band", "leaf", "node").join(boxes, "node")
    box = box.groupBy("key", "band", "leaf").agg(F.array(*[F.max(F.col("box")[i]) for i in range(GROUPS)]).alias("box"))
    own = materialize(own.join(box, ["key", "band", "leaf"], "left"), "join-leaves")
    a, b = (own.select("key", *[F.col(c).alias(f"{c}_{s}") for c in own.columns if c != "key"]) for s in "ab")
    a = a.withColumn("band_b", F.explode(F.array(F.col("band_a"), F.col("band_a") + 1)))
    met = a.join(b, ["key", "band_b"]).filter("band_a < band_b or leaf_a <= leaf_b")
    one = (F.col("low_component_a") == F.col("high_component_a")) & (F.col("low_component_b") == F.col("high_component_b")) & (F.col("low_component_a") == F.col("low_component_b"))
    shared = F.aggregate(F.zip_with("box_a", "box_b", lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    least = F.col("low_n_shingles_a") + F.col("low_n_shingles_b")
    sizes = (100 * F.col("high_n_shingles_a") >= percent * F.col("low_n_shingles_b")) & (100 * F.col("high_n_shingles_b") >= percent * F.col("low_n_shingles_a"))
    allowed = F.col("box_a").isNull() | F.col("box_b").isNull() | ((100 + percent) * shared >= percent * least)
    return met.filter(~one & sizes & allowed).select("key", "band_a", "leaf_a", "band_b", "leaf_b", (F.col("rows_a") + F.col("rows_b")).alias("rows"))


def crossing(nodes: np.ndarray, components: np.ndarray, sizes: np.ndarray, counts: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int, int, int, int]]:
    """(a, b, component of a, of b, bound) of the pairs of a left and a right point in two components that the bound leaves; a < b.

    Counts in GROUPS coordinates are tried first, all of them only for the pairs that these leave.
    """
    lengths = np.array([len(c) for c in counts])
    coarse = np.stack([fold(c[None], GROUPS)[0] for c in counts]).astype(np.int32)
    others = np.flatnonzero(right)
    out = []
    for x in np.flatnonzero(left):
        y = others[components[others] != components[x]]
        y = y[(100 * sizes[y] >= percent * sizes[x]) & (100 * sizes[x] >= percent * sizes[y])]
        y = y[~left[y] | (nodes[y] > nodes[x])]  # a pair within one leaf is met once
        if len(y):
            y = y[may_link(np.minimum(coarse[y], coarse[x]).sum(axis=1), sizes[x], sizes[y], percent)]
        for length in np.unique(lengths[y]):
            groups, own = min(int(length), int(lengths[x])), y[lengths[y] == length]
            shared = np.minimum(fold(np.stack([counts[i] for i in own]), groups), fold(counts[x][None], groups)).sum(axis=1, dtype=np.int64)
            for i, s in zip(own[may_link(shared, sizes[x], sizes[own], percent)], shared[may_link(shared, sizes[x], sizes[own], percent)]):
                a, b = (x, i) if nodes[x] < nodes[i] else (i, x)
                out.append((int(nodes[a]), int(nodes[b]), int(components[a]), int(components[b]), int(s)))
    return out


def _crossing(percent: int):
    names = ["a", "b", "ca", "cb", "shared"]

    def run(group):
        import pyarrow as pa

        group = group.sort_by("pair")
        pair = group.column("pair").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(pair[1:] != pair[:-1]) + 1, [len(pair)]])
        nodes, components, sizes = (group.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        counts = [np.frombuffer(c, np.uint8) for c in group.column("counts").to_pylist()]
        left, right = (group.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            out += crossing(nodes[a:b], components[a:b], sizes[a:b], counts[a:b], left[a:b], right[a:b], percent)
        columns = list(zip(*set(out))) if out else [[]] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return run


def tree_candidates(members: DataFrame, nodes: DataFrame, stars: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """Distinct (a, b, ca, cb, shared): pairs of points in two components that share a partition and pass all bounds."""
    spots = materialize(leaves(members, nodes, stars, percent, leaf), "join-spots")
    wanted = spots.filter("cut").select("node").distinct()
    boxes = nodes.select("node", "counts").join(wanted, "node").mapInArrow(_boxed, "node bigint, box array<bigint>")
    pairs = materialize(meeting(spots, boxes, percent).withColumn("pair", F.monotonically_increasing_id()), "join-pairs")
    rows = pairs.agg(F.sum("rows")).first()[0] or 0
    side = lambda s: pairs.select("key", "pair", F.col(f"band_{s}").alias("band"), F.col(f"leaf_{s}").alias("leaf"), F.lit(s == "a").alias("left"), F.lit(s == "b").alias("right"), (F.expr("band_a = band_b and leaf_a = leaf_b")).alias("self"))
    both = side("a").withColumn("right", F.col("self")).unionByName(side("b").filter("not self")).drop("self")
    dealt = spots.drop("cut").join(both, ["key", "band", "leaf"]).join(nodes.select("node", "counts"), "node")
    parts = max(1, -(-rows // DEALT))
    dealt = dealt.select("pair", "node", "component", "n_shingles", "counts", "left", "right", F.pmod(F.xxhash64("pair"), F.lit(parts)).alias("part"))
    found = dealt.groupBy("part").applyInArrow(_crossing(percent), "a bigint, b bigint, ca bigint, cb bigint, shared bigint")
    out = materialize(found.distinct(), "join-candidates")
    drop_table(spots, pairs)
    return out


def tree_links(members: DataFrame, nodes: DataFrame, stars: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links (u, v) between the components that share a partition: all that are needed to join them."""
    found = tree_candidates(members, nodes, stars, percent)
    best = found.groupBy(F.least("ca", "cb").alias("c"), F.greatest("ca", "cb").alias("d")).agg(F.max_by(F.struct("a", "b"), F.struct("shared", "a", "b")).alias("p"))
    first = materialize(best.select("p.*"), "join-first")
    sure = materialize(confirmed(first, texts, width, percent, True), "join-sure")
    ends = sure.select(F.col("u").alias("a"), F.col("v").alias("b")).join(found.select("a", "b", "ca", "cb"), ["a", "b"])
    whole = materialize(component_edges(ends.select(F.col("ca").alias("u"), F.col("cb").alias("v"))), "join-whole")
    of = lambda c: whole.select(F.col("node").alias(c), F.col("component").alias(f"{c}_whole"))
    apart = found.join(of("ca"), "ca", "left").join(of("cb"), "cb", "left").filter(F.coalesce("ca_whole", "ca") != F.coalesce("cb_whole", "cb"))
    rest = materialize(apart.select("a", "b").join(first, ["a", "b"], "left_anti"), "join-rest")
    return sure.union(confirmed(rest, texts, width, percent, True))


def linked_components(classes: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(node, component) of all classes (node, n_shingles, counts, curve, tokens) that are linked with another; ``texts`` has (node, text)."""
    every = classes.select(F.explode("tokens").alias("key"), "node")
    nodes = classes.select("node", "n_shingles", "counts", "curve")

    def likely(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
        held = nodes.join(wanted, "node")
        return _beside(pairs, held, {"n_shingles": "na nb", "counts": "ca cb"}).mapInArrow(_bounded(percent), "a bigint, b bigint")

    def rest(unsettled: DataFrame, stars: DataFrame, held: DataFrame) -> DataFrame:
        return tree_links(unsettled, nodes, stars, held, width, percent)

    return bucket_components(every, texts, likely, rest, width, percent, exact=True)


def _unique_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, reached (the least id of the component, null without an id) of rows (doc_id, text) whose ids do not repeat."""
    own = materialize(points(docs, width, percent, common_cells(docs, width)), "join-points")
    some = own.filter("digest is not null and doc_id is not null")
    sets = materialize(some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")), "join-classes")
    # points stay where they are: the few that are copies of another are taken out
    again = sets.filter("n > 1").select("digest", "node")
    hot = hot_keys(sets, "digest")
    copies = salted(some.select("doc_id", "digest"), "digest", hot, F.col("doc_id")).join(for_salts(again, "digest", hot), ["digest", "salt"]).filter("doc_id <> node")
    copies = materialize(copies.select(F.col("doc_id").alias("node")), "join-copies")
    shown = some.select(F.col("doc_id").alias("node"), "n_shingles", "counts", "curve", "tokens")
    classes = shown.join(_near_list(copies), "node", "left_anti")
    joined = linked_components(classes, docs.withColumnRenamed("doc_id", "node"), width, percent).withColumnRenamed("node", "member")
    of_class = sets.select("digest", "node").join(joined, F.col("node") == F.col("member"), "left").select("digest", F.coalesce("component", "node").alias("reached"))
    rows = salted(own.select("doc_id", "n_shingles", "digest"), "digest", hot, F.col("doc_id"))
    out = rows.join(for_salts(of_class, "digest", hot), ["digest", "salt"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id")).alias("reached"))


def components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id (the least id reachable by links)."""
    rows = named(docs, doc_id=id_column, text=text_column)
    found = row_components(rows, lambda r: _unique_components(r, width, percent), lambda r: points(r, width, percent).select("doc_id", "n_shingles"))
    return found.select("doc_id", "n_shingles", F.col("reached").alias("component_id"))


def op12_count_join(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return components(table(spark, sf_dir, "documents"))


QUERIES = {"op12_count_join": op12_count_join}
ORACLE = {"op12_count_join": _NEAR["op10_near_dedup"].replace(">= 75 *", ">= 80 *").replace(", doc_id = min(reached) AS kept", "")}
