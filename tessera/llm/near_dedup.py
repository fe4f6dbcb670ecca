"""Near-duplicate detection with HyperMinHash sketches.

1. *Sketch.* A document's distinct word shingles (64-bit hashes) fall into REGISTERS buckets;
   a bucket keeps its least hash as a count of leading zeros and MANTISSA further
   bits, 16 bits in all. An empty bucket takes the value of the first filled one in
   its own fixed random order, so that two documents' registers agree with the chance of
   their Jaccard similarity, however short they are.
2. *Classes.* Equal shingle sets are one class from here on.
3. *Candidates.* BANDS bands of compressed registers; classes that share a band are a bucket. First
   each member of a bucket meets only the bucket's least member.
4. *Estimate.* Registers agree by chance with probability CHANCE; the corrected share of
   equal registers must be within six deviations of the similarity.
5. *Verification* on the full shingle sets; verified links give components.
6. *Rest.* Buckets that still hold more than one component are gone through whole: a kernel counts what
   the members outside the largest component share with all others and names links
   between components only, so that a bucket gives as many rows as it has components. Those links
   are verified on the full sets, too. Only the members outside the largest component are copied to
   several groups, and joins by band key, or by the first end of a pair, deal the rows of a hot one over many tasks.

At similarity 0.75 a pair shares no band with probability (1 - 0.75**5)**40, about 2e-5.

Edge cases: null, empty and blank texts have no shingles and are linked with nothing;
fewer words than a shingle are one shingle of the whole sequence; a null id has no
component and stays; rows that share an id are one node, linked with all that any of
their texts is linked with, and each row has its own text's n_shingles; an empty table gives no
rows; other columns are ignored by ``components`` and kept by ``distinct``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, release, salted, table
from tessera.operators.components import component_edges
from tessera.session import drop_table, materialize

WIDTH, PERCENT = 5, 75
BANDS, PER_BAND, MANTISSA, FRACTION = 40, 5, 10, 40
REGISTERS = BANDS * PER_BAND
SLICE = 3_000_000
GROUP_ROWS, GROUP_SHINGLES = 1024, 400_000
#: Chance that two unequal minima agree: both have the same count of zeros (sum of 4**-z, a third) and mantissa.
CHANCE = 1 / 3 / (1 << MANTISSA)
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_orders: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts, width: int = WIDTH):
    """Sorted distinct 64-bit shingle hashes of each text of an Arrow string column, in order."""
    import pyarrow.compute as pc
    import xxhash

    release("near")
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    ends = pc.cumulative_sum(pc.binary_length(texts).cast("int64")).to_numpy(zero_copy_only=False) if len(texts) else []
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        pieces = pc.ascii_split_whitespace(texts.slice(at, upto - at))
        bounds = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        flat = pieces.flatten()
        filled = pc.not_equal(flat, "")
        starts = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[bounds].tolist()
        coded = flat.filter(filled).dictionary_encode()
        known = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        words = known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)
        rolled = words[: max(0, len(words) - width + 1)].copy()
        for k in range(1, width):
            rolled = rolled * _P + words[k : k + len(rolled)]
        rolled = _mixed(rolled)
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for w in words[a:b]:
                    whole = whole * _P + w
                yield _mixed(whole)
            else:
                yield np.zeros(0, np.uint64)
        at = upto


def sketch(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS uint16 registers of a sorted, non-empty set."""
    wide = (shingles >> np.uint64(64 - FRACTION)) * np.uint64(REGISTERS)
    bucket = (wide >> np.uint64(FRACTION)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    least = (wide[first] & np.uint64((1 << FRACTION) - 1)).astype(np.int64)
    zeros = FRACTION - np.frexp(least.astype(np.float64))[1]
    zeros[least == 0] = FRACTION
    mantissa = ((least << zeros) >> (FRACTION - 1 - MANTISSA)) & ((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[bucket[first]] = (zeros << MANTISSA) | mantissa
    if len(first) < REGISTERS:
        if not _orders:
            random = np.random.default_rng(11)
            _orders.append(np.stack([random.permutation(REGISTERS) for _ in range(REGISTERS)]))
        filled = np.zeros(REGISTERS, bool)
        filled[bucket[first]] = True
        empty = np.flatnonzero(~filled)
        order = _orders[0][empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(documents, REGISTERS) to (documents, BANDS) 64-bit keys."""
    parts = registers.reshape(len(registers), BANDS, PER_BAND).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(PER_BAND):
        keys = _mixed(keys * _P + parts[:, :, k])
    return keys.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    return np.maximum(0, ((a == b).mean(axis=-1) - CHANCE) / (1 - CHANCE))


def estimate_floor(percent: int) -> float:
    """Six standard deviations below the similarity."""
    j = percent / 100
    return j - 6 * np.sqrt(j * (1 - j) / REGISTERS)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity, counted exactly."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(a) + len(b)
    union = len(np.unique(np.concatenate([a, b])))
    return 100 * (both - union) >= percent * union


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set and registers of every row."""
    def run(stream):
        import pyarrow as pa

        for batch in stream:
            sizes, digests, registers = [], [], []
            for own in shingle_sets(batch.column("text"), width):
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                registers.append(sketch(own).tobytes() if len(own) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "registers"])

    return named(docs, doc_id=id_column, text=text_column).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, registers binary")


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(stream):
    import pyarrow as pa

    for batch in stream:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys = band_keys(_registers(part.column("registers")))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(part.column("node").to_numpy(), BANDS))], names=["key", "node"])


def _estimated(floor: float):
    def run(stream):
        import pyarrow as pa

        for batch in stream:
            if batch.num_rows:
                keep = similarity(_registers(batch.column("ra")), _registers(batch.column("rb"))) >= floor
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verified(width: int, percent: int):
    def run(stream):
        import pyarrow as pa

        held, own = None, None
        for batch in stream:
            keep = []
            for i in range(batch.num_rows):
                a = batch.column("a")[i].as_py()
                if a != held:
                    held, own = a, next(shingle_sets(batch.column("ta").slice(i, 1), width))
                other = next(shingle_sets(batch.column("tb").slice(i, 1), width))
                keep.append(linked(own, other, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _of_key(members: DataFrame, per_key: DataFrame) -> DataFrame:
    """Salted members with the columns of their key's row, dealt by (key, salt)."""
    return members.join(members.select("key", "salt").distinct().join(per_key, "key"), ["key", "salt"])


def _unsettled(members: DataFrame) -> DataFrame:
    """Rows (key, salt, node, component) of the buckets with more than one component."""
    mixed = members.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return _of_key(members, mixed.filter("least <> most").select("key"))


def _sets32(width: int):
    """Sorted low halves of the shingle hashes."""
    def run(stream):
        import pyarrow as pa

        for batch in stream:
            sets = [np.unique(own.astype(np.uint32)) for own in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "n", "shingles"])

    return run


def cross_links(nodes: np.ndarray, components_: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of a ``left`` and a ``right`` node in different components whose sets reach ``percent``; enough of them to join all such components.

    A pair that a few colliding hashes could have lifted over the bound is named, but joins nothing.
    """
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum([len(x) for x in sets])
    own = [codes[b - len(x) : b] for b, x in zip(ends, sets)]
    label = np.unique(components_, return_inverse=True)[1].astype(np.int64)
    others = np.flatnonzero(right)
    sizes = np.array([len(sets[y]) for y in others])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    every = np.concatenate([own[y] for y in others])
    out, mark = [], np.zeros(int(codes.max()) + 1, np.int32)
    for x in np.flatnonzero(left):
        size = len(own[x])
        mark[own[x]] = 1
        both = np.add.reduceat(mark[every], starts)
        mark[own[x]] = 0
        enough = (100 * both >= percent * (sizes + size - both)) & (label[others] != label[x])
        for k in np.flatnonzero(enough):
            y = others[k]
            if label[y] != label[x]:
                out.append((int(min(nodes[x], nodes[y])), int(max(nodes[x], nodes[y]))))
                if 100 * (both[k] - 3) >= percent * (sizes[k] + size - both[k] + 3):
                    label[label == label[y]] = label[x]
    return out


def _crossing(percent: int):
    def run(group):
        import pyarrow as pa

        sets = [np.frombuffer(v, np.uint32) for v in group.column("shingles").to_pylist()]
        left, right = (group.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
        found = cross_links(group.column("node").to_numpy(), group.column("component").to_numpy(), sets, left, right, percent) if left.any() and right.any() else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _beside(pairs: DataFrame, rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pairs (a, b) with columns of ``rows`` (node, ...) for both ends; ``columns`` names each one's two copies.

    A node that is the first end of very many pairs is dealt over many tasks.
    """
    hot = hot_keys(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "a")
    side = lambda c, i: rows.select(F.col("node").alias(c), *[F.col(old).alias(new.split()[i]) for old, new in columns.items()])
    met = pairs.select("a", "b").join(side("b", 1), "b")
    met = salted(met, "a", hot, F.col("b")).join(for_salts(side("a", 0), "a", hot), ["a", "salt"])
    return met.select("a", "b", *[c for new in columns.values() for c in new.split()])


#: Rows of a list of nodes up to which it is sent to every executor; beyond it, a shuffled join.
SMALL_LIST = 2_000_000


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int, all_texts: bool = False) -> DataFrame:
    """(u, v) of the pairs (a, b) whose full sets reach ``percent``; ``pairs`` are a written table. With ``all_texts``, most texts are no end: those of a list that is not too long are sought out first."""
    if all_texts and pairs.count() <= SMALL_LIST // 2:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        texts = texts.join(F.broadcast(ends), "node", "left_semi")
    sure = _beside(pairs, texts, {"text": "ta tb"}).mapInArrow(_verified(width, percent), "a bigint, b bigint")
    return sure.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _rest(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between the components that meet in a bucket; ``members`` are the unsettled buckets.

    Members outside a bucket's largest component (outer ones) meet all others, members of it only them.
    Both are dealt to parts of about GROUP_ROWS members and GROUP_SHINGLES shingles, and a group is two
    parts, one of them of outer members: so a task's memory has a bound, and the many members of a
    large component are copied once for each part of the few others.
    """
    wanted = members.select("node").distinct()
    sets = materialize(texts.join(wanted, "node").mapInArrow(_sets32(width), "node bigint, n bigint, shingles binary"), "near-sets")
    sized = members.join(sets.select("node", "n"), "node")
    of_component = sized.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    inner = F.max(F.struct("rows", "component", "n"))
    of_key = of_component.groupBy("key").agg(inner.alias("top"), F.sum("rows").alias("rows"), F.sum("n").alias("n"))
    parts = lambda rows, n: F.least(F.ceil(F.greatest(rows / GROUP_ROWS, n / GROUP_SHINGLES)), rows).cast("int")
    rest = (F.col("rows") - F.col("top.rows"), F.col("n") - F.col("top.n"))
    of_key = of_key.select("key", F.col("top.component").alias("largest"), parts(*rest).alias("outer_parts"), parts(F.col("top.rows"), F.col("top.n")).alias("inner_parts"))
    placed = _of_key(members, of_key).withColumn("outer", F.col("component") != F.col("largest"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("outer"), F.col("outer_parts")).otherwise(F.col("inner_parts"))).cast("int")
    placed = placed.withColumn("own", own)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    group = lambda i, j, left, right: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), left.alias("left"), right.alias("right"))
    me, yes, no = F.col("own"), F.lit(True), F.lit(False)
    # outer parts i <= j meet under (i, j); outer part i and inner part j under (i, -1 - j)
    with_outer = F.transform(upto("outer_parts"), lambda o: group(F.least(me, o), F.greatest(me, o), me <= o, me >= o))
    with_inner = F.transform(upto("inner_parts"), lambda p: group(me, -1 - p, yes, no))
    of_inner = F.transform(upto("outer_parts"), lambda o: group(o, -1 - me, no, yes))
    dealt = placed.select("key", "node", "component", F.explode(F.when(F.col("outer"), F.concat(with_outer, with_inner)).otherwise(of_inner)).alias("g")).select("key", "node", "component", "g.*")
    grouped = dealt.join(sets.select("node", "shingles"), "node").groupBy("key", "i", "j")
    pairs = materialize(grouped.applyInArrow(_crossing(percent), "a bigint, b bigint").distinct(), "near-crossing")
    drop_table(sets)
    return confirmed(pairs, texts, width, percent)


def bucket_components(every: DataFrame, texts: DataFrame, likely: Callable, rest: Callable, width: int, percent: int, exact: bool = False) -> DataFrame:
    """(node, component) of the nodes that are linked with another one; linked nodes share a key of ``every`` (key, node).

    First each member of a bucket meets only its least one: ``likely(pairs, nodes)`` keeps those of the pairs (a, b) that
    may be linked. Then ``rest(unsettled, stars, texts)`` gives the links between components that share a bucket.
    With ``exact``, ``likely`` leaves out no linked pair: all pairs with a bucket's least member are settled then, and the rest is without it; few pairs
    are verified, so that texts are read where they are. Else the texts of all members are written once.
    Buckets are joined by (key, salt): the members of a hot key are dealt over many tasks.
    """
    buckets = materialize(every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a")).filter("n > 1"), "near-keys")
    hot = hot_keys(buckets, "key")
    members = salted(every, "key", hot, F.col("node")).join(for_salts(buckets.select("key", "a"), "key", hot), ["key", "salt"])
    members = materialize(members.select("key", "salt", "node", "a"), "near-buckets")
    wanted = materialize(members.select("node").distinct(), "near-wanted")
    held = texts if exact else materialize(texts.join(wanted, "node"), "near-texts")
    pairs = materialize(members.filter("a <> node").select("a", F.col("node").alias("b")).distinct(), "near-pairs")
    close = materialize(likely(pairs, wanted), "near-likely")
    stars = materialize(component_edges(confirmed(close, held, width, percent, exact)), "near-stars")
    placed = (members.filter("a <> node") if exact else members).join(stars, "node", "left").select("key", "salt", "node", F.coalesce("component", "node").alias("component"))
    unsettled = materialize(_unsettled(placed), "near-unsettled")
    drop_table(buckets, members, wanted, pairs, close)
    if unsettled.isEmpty():
        drop_table(held, unsettled)
        return stars
    more = materialize(rest(unsettled, stars, held), "near-rest")
    out = joined_components(stars, more)
    drop_table(held, unsettled, more)
    return out


def joined_components(stars: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of components (node, component) and further links (u, v) between their nodes or others."""
    top = lambda c: stars.select(F.col("node").alias(c), F.col("component").alias(f"{c}_top"))
    lifted = links.join(top("u"), "u", "left").join(top("v"), "v", "left").select(F.coalesce("u_top", "u").alias("u"), F.coalesce("v_top", "v").alias("v"))
    joined = component_edges(lifted).select(F.col("node").alias("mid"), F.col("component").alias("top"))
    joined = materialize(joined, "near-joined")
    moved = stars.join(joined, F.col("component") == F.col("mid"), "left").select("node", F.coalesce("top", "component").alias("component"))
    alone = joined.join(stars.select(F.col("node").alias("mid")), "mid", "left_anti").select(F.col("mid").alias("node"), F.col("top").alias("component"))
    return moved.union(alone)


def component_links(classes: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(node, component) of all classes (node, registers) that are linked with another; ``texts`` has (node, text)."""
    every = classes.select("node", "registers").mapInArrow(_banded, "key bigint, node bigint")

    def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        registers = classes.select("node", "registers").join(nodes, "node")
        return _beside(pairs, registers, {"registers": "ra rb"}).mapInArrow(_estimated(estimate_floor(percent)), "a bigint, b bigint")

    return bucket_components(every, texts, likely, lambda unsettled, stars, held: _rest(unsettled, held, width, percent), width, percent)


def _unique_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, reached (the least id of the component, null without an id) of rows (doc_id, text) whose ids do not repeat."""
    own = materialize(sketches(docs, "doc_id", "text", width), "near-sketches")
    sets = own.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("registers").alias("registers"), F.count(F.lit(1)).alias("n"))
    sets = materialize(sets, "near-classes")
    joined = component_links(sets, docs.withColumnRenamed("doc_id", "node"), width, percent).withColumnRenamed("node", "member")
    of_class = sets.select("digest", "node").join(joined, F.col("node") == F.col("member"), "left").select("digest", F.coalesce("component", "node").alias("reached"))
    hot = hot_keys(sets, "digest")
    rows = salted(own.select("doc_id", "n_shingles", "digest"), "digest", hot, F.col("doc_id"))
    out = rows.join(for_salts(of_class, "digest", hot), ["digest", "salt"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id")).alias("reached"))


def _repeated_components(docs: DataFrame, unique: Callable, sizes: Callable) -> DataFrame:
    """As ``unique(docs)`` for ids that repeat: rows are numbered and linked, then components with an id in common are one."""
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    rows = materialize(docs.select(number.alias("row"), "doc_id", "text"), "near-rows")
    found = unique(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "n_shingles", F.col("reached").alias("part"))
    found = materialize(rows.select("row", "doc_id").filter("row is not null").join(found, "row"), "near-parts")
    first = found.groupBy("doc_id").agg(F.min("part").alias("u"), F.max("part").alias("v")).filter("u <> v")
    links = found.select("doc_id", "part").distinct().join(first.select("doc_id", "u"), "doc_id").select("u", F.col("part").alias("v"))
    of_part = component_edges(links).select(F.col("node").alias("part"), F.col("component").alias("whole"))
    parts = found.groupBy("part").agg(F.min("doc_id").alias("least")).join(of_part, "part", "left").withColumn("whole", F.coalesce("whole", "part"))
    parts = materialize(parts, "near-wholes")
    reached = parts.join(parts.groupBy("whole").agg(F.min("least").alias("reached")), "whole").select("part", "reached")
    counts = found.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, "part")
    out = salted(found, "part", hot, F.col("row")).join(for_salts(reached, "part", hot), ["part", "salt"]).select("doc_id", "n_shingles", "reached")
    nameless = sizes(rows.filter("row is null")).select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("reached"))
    return out.union(nameless)


def row_components(docs: DataFrame, unique: Callable, sizes: Callable) -> DataFrame:
    """doc_id, n_shingles, reached of all rows (doc_id, text): ``unique`` gives it where ids do not repeat, ``sizes`` gives doc_id and n_shingles."""
    return _repeated_components(docs, unique, sizes) if _repeats(docs) else unique(docs)


def components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id (the least id reachable), kept."""
    rows = named(docs, doc_id=id_column, text=text_column)
    found = row_components(rows, lambda r: _unique_components(r, width, percent), lambda r: sketches(r, "doc_id", "text", width))
    return found.select("doc_id", "n_shingles", F.col("reached").alias("component_id"), F.coalesce(F.col("reached") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _repeats(rows: DataFrame) -> bool:
    """Whether an id occurs twice."""
    return not rows.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty()


def distinct(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component has a lesser id. Rows with one id stay together."""
    dropped = components(docs, id_column, text_column, width, percent).filter("not kept").select(F.col("doc_id").alias("__dropped"))
    return docs.join(dropped.distinct(), F.col(f"`{id_column}`") == F.col("__dropped"), "left_anti")


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return components(table(spark, sf_dir, "documents"))


QUERIES = {"op10_near_dedup": op10_near_dedup}
ORACLE = {
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
        met AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_ FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT u, v FROM met JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * both_ >= 75 * (a.size + b.size - both_)),
        sides AS (SELECT u AS a, v AS b FROM links UNION ALL SELECT v, u FROM links),
        walk(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, reached FROM walk JOIN sides ON a = doc_id WHERE reached < b)
        SELECT doc_id, coalesce(any_value(size), 0) AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
        FROM walk LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
}
