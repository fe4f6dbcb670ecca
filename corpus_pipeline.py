"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but
the last return the columns of ``documents``. A row taken more than once by the mixture
is packed as often.

Edge cases, in all stages: a null or empty text is scored like any other, is a copy of other
empty texts, has no near copies, no tokens, and is one piece (the end id) if taken; a null id is no near
copy of anything; texts of any length are read whole; of ties in exact copies the largest id stays,
in near copies the least; repeated rows are copies of each other; further columns, whatever their names, are kept
up to the last stage; an empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, mixing, near_dedup, pack, quality
from tessera.llm.base import table
from tessera.llm.tokens import default_path
from tessera.session import drop_table, materialize


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it learns from the labels that are not held out."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the least id stays."""
    return near_dedup.distinct(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token budget of half of what is left, by the mixture's weights."""
    return mixing.mix(docs, mixing.WEIGHTS, mixing.SHARE, epoch_column=None)


def pack_best(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces placed in sequences of 4096 tokens."""
    return pack.pack(docs, default_path("word_bpe_49k.json"), 1)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack_best),
]

#: The classifier and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
        drop_table(before)
    return STAGES[-1][1](spark, docs, sf_dir)
