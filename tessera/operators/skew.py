"""Joins on keys that a large share of all rows may have: such rows are dealt over several tasks. Very many small groups, the other way, share a call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

#: A key with more rows than this, and more than one in MOST_HOT of all rows, is hot and dealt over SALTS tasks.
HOT_ROWS, MOST_HOT, SALTS = 100, 10_000, 64

#: Rows that the groups of one pack have together, unless a single group has more.
PACK_ROWS = 20_000


def packs(rows: int, key: str | list[str]) -> Column:
    """The pack of a group, for a frame of so many rows: Python is called once a pack, and not for each of very many small groups."""
    return F.pmod(F.xxhash64(*_names(key)), F.lit(max(1, -(-rows // PACK_ROWS)))).cast("int")


def in_packs(df: DataFrame, rows: int) -> GroupedData:
    """The packs of a frame of so many rows as groups, dealt to as many tasks, whatever their bytes: what Python does with them takes longer than to read them."""
    return df.repartition(max(1, -(-rows // PACK_ROWS)), "pack").groupBy("pack")


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def hot_keys(counts: DataFrame, key: str | list[str], n: str = "n") -> DataFrame:
    """The hot keys of a table with one row a key and its number of rows: MOST_HOT keys at most, whatever its size.

    A key with more than total / MOST_HOT rows is one of fewer than MOST_HOT; where that is less
    than HOT_ROWS, so are those with more than HOT_ROWS of at most HOT_ROWS * MOST_HOT rows.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) > max(HOT_ROWS, total / MOST_HOT)).select(*_names(key))


def salted(rows: DataFrame, key: str | list[str], hot: DataFrame, by: Column, salts: int = SALTS) -> DataFrame:
    """Adds ``salt``: 0, but for rows of a hot key a number below ``salts`` by a hash of ``by``."""
    marks = F.broadcast(hot.select(*_names(key), F.lit(True).alias("__hot")))
    return rows.join(marks, key, "left").withColumn("salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(0).cast("int")).drop("__hot")


def for_salts(keyed: DataFrame, key: str | list[str], hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row a key to one for each of its salts: joins a ``salted`` table by (key, salt), so that no task gets all rows of a hot key."""
    marks = F.broadcast(hot.select(*_names(key), F.lit(True).alias("__hot")))
    each = F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    return keyed.join(marks, key, "left").select(*keyed.columns, each.alias("salt"))


def looked_up(rows: DataFrame, lut: DataFrame, key: str, by: Column, how: str = "left") -> DataFrame:
    """``rows`` joined with a table of one row a key, whatever share of the rows a key has."""
    hot = hot_keys(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key)
    return salted(rows, key, hot, by).join(for_salts(lut, key, hot), [key, "salt"], how).drop("salt")
