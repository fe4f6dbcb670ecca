"""Mixing sources to target weights by budgets that flow through a domain, language and source tree.

The tree is given by nested weights. A token budget is shared among a node's children
by weight; what a child cannot take (its rows times EPOCHS, at most) goes to its
siblings by weight first, and only what all of them together cannot take goes up to
the parent's siblings. Leaves that the weights do not name get the weight of ``default``.

A leaf takes its tokens as a prefix of seeded epochs: epoch e is all of its rows in
the order of a hash of (seed, e, id); a row is taken if the tokens before it in the
prefix are fewer than the budget. Full epochs are counted, not ordered. In the last, the
row that crosses the budget is found by a descent through hash ranges: token sums
of FANOUT ranges, then of the ranges within the crossing one, and so on, so that no
task ever orders more than FANOUT ranges or, in the last step, about SMALL rows of a leaf, whatever its size.

The tree is the table of leaves (a domain, language and source that occur together): token sums go up it by grouping,
budgets come down it level by level, and one task shares a node's budget among the node's children. Only the sum of all tokens
reaches the driver. The leaves' plan is broadcast up to
SMALL_LEAVES leaves; beyond it, rows of hot leaves are salted. Tokens are words between blanks.

Edge cases: null language or source is a leaf of its own named by the empty string;
null or empty texts have no tokens and are taken with the rows before them (an
epoch's order still holds them); repeated rows are taken together; a budget over all
rows and epochs takes all; zero weights take nothing unless siblings fall short, and
then only if all of them are zero; very long texts count with all their tokens; an empty table gives no
rows; a column of the name of ``epoch_column`` is replaced, all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, salted, table
from tessera.session import drop_table, materialize

EPOCHS, SEED, FANOUT, SMALL, SMALL_LEAVES = 4, 17, 1 << 10, 20_000, 20_000
KEYS = ["domain", "lang_", "source_"]
#: Weights of the query: domains, then languages, then sources ("*": any other).
WEIGHTS = {
    "head": (0.3, {"en": (0.6, {}), "*": (0.2, {})}),
    "tail": (0.7, {"en": (0.5, {"src1": (2.0, {}), "*": (1.0, {})}), "de": (0.2, {}), "fr": (0.2, {}), "es": (0.1, {})}),
}
#: Tokens asked for, as a share of all tokens.
SHARE = 0.5


def tokens_of(text: Column) -> Column:
    """Number of words between blanks (space, tab, line ends)."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")


def domain_of(source: Column) -> Column:
    """The query's domains: src0 is the head, all others the tail."""
    return F.when(source == "src0", "head").otherwise("tail")


def fill(budget: float, capacity: list[float], weight: list[float]) -> list[float]:
    """Share a budget among siblings by weight; what one cannot take goes to the others by weight."""
    taken, open_ = [0.0] * len(capacity), [i for i, c in enumerate(capacity) if c > 0]
    left = min(budget, sum(capacity))
    while left > 1e-9 and open_:
        live = [i for i in open_ if weight[i] > 0] or open_
        total = sum(weight[i] for i in live)
        parts = {i: left * (weight[i] / total if total else 1 / len(live)) for i in live}
        full = [i for i in live if parts[i] >= capacity[i] - taken[i]]
        if not full:
            for i in live:
                taken[i] += parts[i]
            break
        for i in full:
            left -= capacity[i] - taken[i]
            taken[i] = capacity[i]
        open_ = [i for i in open_ if i not in full]
    return taken


def _below(weights: Mapping, path: tuple, default: float) -> Mapping:
    """The weights of a node's children."""
    for name in path:
        weights = weights.get(name, weights.get("*", (default, {})))[1]
    return weights


def budgets(available: DataFrame, total: float, weights: Mapping, epochs: int = EPOCHS, default: float = 1.0, keys: list[str] | None = None) -> DataFrame:
    """``available`` (keys, n: tokens of one epoch of each leaf) with ``budget``, whole tokens for each leaf."""
    keys = keys or KEYS

    def shared(depth: int):
        def run(rows):
            level = _below(weights, tuple(rows[k].iloc[0] for k in keys[:depth]), default)
            rows = rows.sort_values(keys[depth])
            own = [level.get(name, level.get("*", (default, {})))[0] for name in rows[keys[depth]]]
            return rows.assign(budget=fill(float(rows.budget.iloc[0]), [epochs * n for n in rows.n.tolist()], own))[[*keys[: depth + 1], "n", "budget"]]

        return run

    above = None
    for depth in range(len(keys)):
        sums = available.groupBy(*keys[: depth + 1]).agg(F.sum("n").alias("n"))
        asked = sums.withColumn("budget", F.lit(float(total))) if above is None else sums.join(above.drop("n"), keys[:depth])
        columns = ", ".join(f"{k} string" for k in keys[: depth + 1])
        above = asked.groupBy(*keys[:depth]).applyInPandas(shared(depth), f"{columns}, n bigint, budget double")
    return above.withColumn("budget", F.bround("budget").cast("bigint"))


def _rank(seed: int, epoch: Column, id_: Column, more: Column) -> Column:
    """63 bits that put an epoch's rows in order; ties go by id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, id_, more), 1)


def _of_leaf(rows: DataFrame, plan: DataFrame, leaves: DataFrame, few: bool) -> DataFrame:
    """Rows with the columns of their leaf's row in ``plan``; ``leaves`` has the number of rows of each leaf."""
    if few:
        return rows.join(F.broadcast(plan), KEYS)
    hot = hot_keys(leaves, KEYS, "rows")
    return salted(rows, KEYS, hot, F.col("id_")).join(for_salts(plan, KEYS, hot), [*KEYS, "salt"]).drop("salt")


def _cuts(rows: DataFrame, need: DataFrame, leaves: DataFrame, few: bool) -> DataFrame:
    """(leaf, bound): the rank up to which a leaf's rows make ``need`` tokens, found by descent through ranges of ranks.

    ``rows`` has the leaf's columns, id_, rank and n; ``need`` the leaf's columns and need, at most its tokens.
    """
    from pyspark.sql import Window as W

    by = W.partitionBy(*KEYS)
    state, span = need.withColumn("low", F.lit(0).cast("bigint")), 1 << 63

    def crossing(near: DataFrame, column: str) -> DataFrame:
        """Of each leaf the first group along a column within which the need is met."""
        sums = near.groupBy(*KEYS, "low", "need", column).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
        sums = sums.withColumn("upto", F.sum("n").over(by.orderBy(column)))
        return sums.filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))

    while span > 1:
        step = max(1, span // FANOUT)
        off = F.col("rank") - F.col("low")
        near = _of_leaf(rows, state, leaves, few).filter((off >= 0) & (off <= F.lit(span - 1))).withColumn("part", F.shiftright(off, step.bit_length() - 1))
        found = crossing(near, "part")
        following = materialize(found.select(*KEYS, (F.col("need") - F.col("upto") + F.col("n")).alias("need"), (F.col("low") + F.col("part") * step).alias("low"), "rows"), "mix-ranges")
        drop_table(state)
        state, span = following.drop("rows"), step
        state._scratch = following._scratch
        if (following.agg(F.max("rows")).first()[0] or 0) <= SMALL:
            break
    off = F.col("rank") - F.col("low")
    near = _of_leaf(rows, state, leaves, few).filter((off >= 0) & (off <= F.lit(span - 1)))
    bounds = materialize(crossing(near, "rank").select(*KEYS, F.col("rank").alias("bound")), "mix-bounds")
    drop_table(state)
    return bounds


def mix(docs: DataFrame, weights: Mapping, budget: int | float, domain: Column | None = None, seed: int = SEED, epochs: int = EPOCHS, default: float = 1.0, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source", epoch_column: str | None = "epoch") -> DataFrame:
    """All columns of the taken rows and the epoch (from 0; left out if ``epoch_column`` is None), one row for each time a row is taken.

    ``budget``: tokens, or a share of all tokens if below 1 (a float).
    """
    id_, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    source = F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit(""))
    leafed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != epoch_column]).alias("row"), id_.alias("id_"), F.coalesce(domain if domain is not None else domain_of(source), F.lit("")).alias("domain"),
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("")).alias("lang_"), source.alias("source_"), F.xxhash64(text).alias("of_text"), tokens_of(text).alias("n"),
    )
    named_epoch = [F.col("__epoch").alias(epoch_column)] if epoch_column else []
    slim = materialize(leafed.drop("row"), "mix-leaves")
    leaves = materialize(slim.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")), "mix-sums")
    total = leaves.agg(F.sum("n")).first()[0]
    if total is None:
        return leafed.limit(0).withColumn("__epoch", F.lit(0)).select("row.*", *named_epoch)
    want = budgets(leaves.select(*KEYS, "n"), budget * total if isinstance(budget, float) and budget < 1 else budget, weights, epochs, default)
    full = F.when(F.col("n") > 0, F.least(F.lit(epochs), F.expr("budget div n"))).otherwise(0)
    frame = want.withColumn("full", full.cast("int")).withColumn("need", F.when((F.col("n") > 0) & (F.col("full") < epochs), F.col("budget") - F.col("full") * F.col("n")).otherwise(0))
    frame = materialize(frame.select(*KEYS, "full", "need"), "mix-plan")
    few = leaves.count() <= SMALL_LEAVES
    ranked = lambda df: df.withColumn("rank", _rank(seed, F.col("full"), F.col("id_"), F.col("of_text")))
    cut = frame.filter("need > 0")
    cuts = _cuts(ranked(_of_leaf(slim, cut.select(*KEYS, "full"), leaves, few)).drop("full"), cut.select(*KEYS, "need"), leaves, few)
    whole = frame.select(*KEYS, "full").join(cuts, KEYS, "left")
    found = ranked(_of_leaf(leafed, whole, leaves, few))
    part = F.coalesce(F.col("rank") <= F.col("bound"), F.lit(False))
    times = F.col("full") + part.cast("int")
    out = found.filter(times > 0).select("row", F.explode(F.sequence(F.lit(0), times - 1)).alias("__epoch"))
    return out.select("row.*", *named_epoch)


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Half of all tokens of ``documents`` by the weights above."""
    mixed = mix(table(spark, sf_dir, "documents"), WEIGHTS, SHARE)
    return mixed.select("doc_id", "lang", "source", domain_of(F.coalesce("source", F.lit(""))).alias("domain"), tokens_of(F.col("text")).alias("n_tokens"), F.col("epoch").cast("int").alias("epoch"))


QUERIES = {"op3_mix_sources": op3_mix_sources}
ORACLE: dict[str, str] = {}
