"""Exact deduplication that a hot text cannot unbalance. DataFrame functions only.

1. Digests that occur twice or more are counted, combined within each task before the
   exchange; the texts of all other rows are unlike any other and never move.
2. Local and salted: rows of those digests are grouped by (digest, salt, text). Spark combines
   within each task before the exchange, and the salt (a block of neighbouring ids)
   spreads a text with very many copies over SALTS tasks.
3. Global: the salt winners, at most SALTS for each text, are grouped by
   (digest, text).
4. A digest that stands for one text only has been proven by these two comparisons
   of full content, so rows find their group by digest; should two texts ever share a
   digest, rows of that digest find it by digest and text. Joins by digest deal the rows of a
   hot digest over many tasks.

Edge cases: null text counts as empty; of equal texts the largest id stays, and a
repeated id counts as a row each; a null id never wins over another; an empty table
gives no rows; other columns are ignored by ``groups`` and kept by ``distinct``, where of rows with
the same id and text the one of least hash over all columns stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, salted, table
from tessera.session import materialize

SALTS = 64
#: Rows of the list of dropped rows up to which it is sent to every executor; beyond it, a shuffled join.
SMALL_LIST = 200_000


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = named(docs, doc_id=id_column, text=text_column).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def copied_texts(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, text, keep_id, group_size) of the texts whose digest occurs twice or more; ``rows`` has doc_id, digest, text."""
    salt = F.pmod(F.floor(F.col("doc_id") / 512), F.lit(salts))
    local = rows.groupBy("digest", salt.alias("salt"), "text").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    return local.groupBy("digest", "text").agg(F.max("winner").alias("keep_id"), F.sum("n").alias("group_size"))


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _rows(docs, id_column, text_column)
    again = materialize(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "again")
    hot = hot_keys(again, "digest")
    spread = lambda df: salted(df, "digest", hot, F.col("doc_id")).withColumnRenamed("salt", "at")
    keyed = lambda df: for_salts(df, "digest", hot).withColumnRenamed("salt", "at")
    texts = copied_texts(spread(rows).join(keyed(again.select("digest")), ["digest", "at"]).drop("at"), salts)
    found = materialize(texts.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("n_texts")), "copies")
    out = spread(rows.select("doc_id", "digest")).join(keyed(found), ["digest", "at"], "left").drop("at")
    shared = found.filter("n_texts > 1").select("digest")
    if not shared.isEmpty():
        other = rows.join(shared, "digest", "left_semi").join(texts, ["digest", "text"])
        out = out.filter("n_texts is null or n_texts = 1").drop("n_texts").unionByName(other.drop("text"))
    return out.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("keep_id").isNull() | F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are not kept; of repeated rows one stays.

    Full rows are not shuffled while the list of dropped (id, digest) pairs is at most SMALL_LIST long.
    """
    copied = groups(docs, id_column, text_column, salts).filter("group_size > 1")
    copied = materialize(copied.select("doc_id", "kept", F.unhex("text_sha256").alias("digest")), "copied-rows")
    dropped = copied.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    if dropped.count() <= SMALL_LIST:
        dropped = F.broadcast(dropped)
    id_, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    same = lambda df: id_.eqNullSafe(df["__id"]) & (F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)) == df["__digest"])
    out = docs.join(dropped, same(dropped), "left_anti")
    again = copied.filter("kept").groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).count().filter("count > 1").drop("count")
    if again.isEmpty():
        return out
    again = materialize(again, "repeated-rows")
    order = W.partitionBy(id_, F.coalesce(text, F.lit(""))).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    one = out.join(again, same(again), "left_semi").withColumn("__rn", F.row_number().over(order)).filter("__rn = 1").drop("__rn")
    return out.join(again, same(again), "left_anti").union(one)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return groups(table(spark, sf_dir, "documents"))


QUERIES = {"op4_exact_dedup": op4_exact_dedup}
ORACLE = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
