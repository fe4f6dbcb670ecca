"""How filters interact: what each removes in every order, from one pass over the texts and a count of failure masks.

1. *Masks.* One scan takes a text's four own conditions, its length in code points and the hashes of its BLOCKS.
2. *Duplicates by partition refinement.* Rows are split by length, then by the hash of one block after the other;
   after every split, classes of one row are dropped. Only narrow rows are counted and joined, counts combine
   before the exchange, and the rows of a large class are dealt over many tasks.
3. *Comparison.* The full texts of the classes that are left are grouped by class and text, combined within each task
   first; a row whose id is not the least of its text fails the duplicate filter. Classes that hold several texts (equal hashes) find
   their row by text, so equal hashes decide nothing.
4. *Counts.* Rows are counted by part, mask and label. All orders and steps, and the Shapley values, are sums over at
   most 2**5 masks a part.

Edge cases: a null text counts as empty; of equal texts the rows with an id above the least one fail, so repeated rows of
the least id do not, nor does a null id, which is no smaller id either; null and empty sources are one part; a document
with several labels is good or toxic if one of them says so, one without is neither; a null id has no label; an
empty table gives no rows; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, salted, table
from tessera.session import drop_table, materialize

FILTERS = "ABCDE"
#: Code points at which a text is cut into blocks; the last block is the rest, however long.
BLOCKS = [0, 64, 1024, 16384]
#: Rows of the list of classes up to which it is sent to every executor; beyond it, a shuffled join.
SMALL_CLASSES = 500_000


def conditions(text: Column) -> dict[str, Column]:
    """Which of the filters that look at one text it fails."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    count, distinct = F.size(words).cast("bigint"), F.size(F.array_distinct(words)).cast("bigint")
    points = F.char_length(text).cast("bigint")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint")
    return {"A": count < 200, "B": 100 * distinct < 50 * count, "C": 100 * capitals > 2 * points, "D": text.rlike(r"[#$%&*|]")}


def _blocks(text: Column) -> list[Column]:
    ends = [*BLOCKS[1:], None]
    cut = lambda a, b: F.substring(text, a + 1, b - a if b else 2**31 - 1 - a)
    return [F.xxhash64(cut(a, b)) for a, b in zip(BLOCKS, ends)]


def _class_after(k: int, before: Column, block: Column) -> Column:
    return F.xxhash64(before, block, F.lit(k))


def refined(rows: DataFrame) -> DataFrame:
    """(doc_id, class) of the rows (doc_id, size, h0, h1, ...) that still share their class after all blocks."""
    at = rows.withColumn("class", F.col("size").cast("bigint"))
    for k in range(len(BLOCKS) + 1):
        if k:
            at = at.withColumn("class", _class_after(k, F.col("class"), F.col(f"h{k - 1}"))).drop(f"h{k - 1}")
        again = materialize(at.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "audit-classes")
        hot = hot_keys(again, "class")
        kept = salted(at, "class", hot, F.coalesce("doc_id", F.lit(0))).join(for_salts(again.select("class"), "class", hot), ["class", "salt"]).drop("salt")
        kept = materialize(kept, "audit-refined")
        drop_table(again, at)
        at = kept
    return at.select("doc_id", "class")


def least_ids(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, text, least) of the texts of the surviving classes (class); ``docs`` has doc_id and text, without null texts."""
    text = F.col("text")
    key = F.char_length(text).cast("bigint")
    for k, block in enumerate(_blocks(text)):
        key = _class_after(k + 1, key, block)
    rows = docs.select("doc_id", "text", key.alias("class"))
    if classes.count() <= SMALL_CLASSES:
        rows = rows.join(F.broadcast(classes), "class", "left_semi")
    else:
        hot = hot_keys(rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "class")
        rows = salted(rows, "class", hot, F.coalesce("doc_id", F.lit(0))).join(for_salts(classes, "class", hot), ["class", "salt"]).drop("salt")
    return rows.groupBy("class", "text").agg(F.min("doc_id").alias("least"))


def masks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """(doc_id, part, mask) of every row: bit i of the mask is set if the text fails the i-th of FILTERS."""
    own = named(docs, doc_id=id_column, text=text_column, part=part_column)
    own = own.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    bits = reduce(lambda a, b: a + b, [F.when(fails, F.lit(1 << FILTERS.index(name))).otherwise(0) for name, fails in conditions(F.col("text")).items()])
    hashes = [h.alias(f"h{k}") for k, h in enumerate(_blocks(F.col("text")))]
    rows = materialize(own.select("doc_id", "part", bits.alias("mask"), F.char_length("text").alias("size"), *hashes), "audit-rows")
    shared = refined(rows.drop("part", "mask"))
    texts = materialize(least_ids(own, shared.select("class").distinct()), "audit-texts")
    of_class = materialize(texts.groupBy("class").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("n_texts")), "audit-least")
    key = F.col("size").cast("bigint")
    for k in range(len(BLOCKS)):
        key = _class_after(k + 1, key, F.col(f"h{k}"))
    keyed = rows.select("doc_id", "part", "mask", key.alias("class"))
    hot = hot_keys(shared.groupBy("class").agg(F.count(F.lit(1)).alias("n")), "class")
    out = salted(keyed, "class", hot, F.coalesce("doc_id", F.lit(0))).join(for_salts(of_class, "class", hot), ["class", "salt"], "left")
    bit = F.when(F.col("doc_id") > F.col("least"), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    several = of_class.filter("n_texts > 1").select("class")
    if several.isEmpty():
        return out.select("doc_id", "part", (F.col("mask") + bit).alias("mask"))
    one = out.filter("n_texts is null or n_texts = 1").select("doc_id", "part", (F.col("mask") + bit).alias("mask"))
    text_key = F.char_length("text").cast("bigint")
    for k, block in enumerate(_blocks(F.col("text"))):
        text_key = _class_after(k + 1, text_key, block)
    met = own.select("doc_id", "part", "text", bits.alias("mask"), text_key.alias("class")).join(several, "class", "left_semi").join(texts, ["class", "text"])
    return one.unionByName(met.select("doc_id", "part", (F.col("mask") + bit).alias("mask")))


def labelled_masks(masks_: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask, and those labelled good and toxic."""
    yes = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    marks = named(labels, doc_id="doc_id", quality="quality", toxic="toxic").filter("doc_id is not null")
    marks = marks.groupBy("doc_id").agg(yes("quality").alias("good"), yes("toxic").alias("toxic"))
    met = masks_.join(marks, "doc_id", "left")
    sums = [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("good", "toxic")]]
    return met.groupBy("part", "mask").agg(*sums)


def audit(counts: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from the counts by part and mask."""
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = F.array(*[F.lit(k + 1) for k in range(len(FILTERS))])
    rows = per_part.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    bit = reduce(lambda other, i: F.when(F.substring("filter_order", F.col("step"), F.lit(1)) == FILTERS[i], F.lit(1 << i)).otherwise(other), range(len(FILTERS)), F.lit(0))
    earlier = reduce(lambda a, b: a + b, [F.when(F.locate(f, F.col("filter_order")) < F.col("step"), F.lit(1 << i)).otherwise(0) for i, f in enumerate(FILTERS)])
    rows = rows.withColumn("bit", bit).withColumn("earlier", earlier)
    total = lambda what, which: F.aggregate("masks", F.lit(0).cast("bigint"), lambda have, m: have + F.when(which(m["mask"]), m[what]).otherwise(0))
    fails, gone = (lambda m: m.bitwiseAND(F.col("bit")) != 0), (lambda m: m.bitwiseAND(F.col("earlier")) != 0)
    here = lambda m: fails(m) & ~gone(m)
    # of all orders, a filter comes first among k failing ones in one of k
    n_orders = factorial(len(FILTERS))
    share = lambda m: F.when(fails(m["mask"]), m["n"] * n_orders / F.bit_count(m["mask"])).otherwise(0).cast("bigint")
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        F.aggregate("masks", F.lit(0).cast("bigint"), lambda have, m: have + share(m)).alias("shapley"),
    )


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` with all of ``labels``."""
    counts = labelled_masks(masks(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))
    return audit(materialize(counts, "audit-counts"))


QUERIES = {"op13_filter_audit": op13_filter_audit}
_ORDERS = " UNION ALL ".join(f"SELECT '{''.join(p)}' AS filter_order" for p in permutations(FILTERS))
_FAILS = "(m.mask >> (ascii({0}) - 65)) % 2 = 1"
_BEFORE = "len(list_filter(range(1, s.step), lambda k: (m.mask >> (ascii(o.filter_order[k]) - 65)) % 2 = 1)) > 0"
ORACLE = {
    "op13_filter_audit": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        m AS (
            SELECT doc_id, part, (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
                + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END)
                + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
                + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS mask FROM d),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
        o AS ({_ORDERS}),
        x AS (SELECT m.part, o.filter_order, s.step, m.mask, m.n, m.good, m.toxic, {_FAILS.format("o.filter_order[s.step]")} AS fails, {_BEFORE} AS gone,
                 1 << (ascii(o.filter_order[s.step]) - 65) AS own, bit_count(m.mask) AS k
             FROM c m, o, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step) s)
        SELECT part, filter_order, step, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
            sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
            sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
            sum(CASE WHEN fails THEN n * (120 // k) ELSE 0 END)::BIGINT AS shapley
        FROM x GROUP BY part, filter_order, step""",
}
