"""URL filter: fixed host and path rules first, mined token rules for the rest. DataFrame functions and Spark ML only.

Spark's FP-growth mines combinations of URL tokens over labelled URLs, with the
label as one more item. Tokens that a fixed rule tests are no items: a rule on them would only repeat it. Sets
that occur in a share of SUPPORT of the URLs and whose confidence for
"block" is CONFIDENCE or more, and by Wilson's lower bound (95 %) LEAST or more, become rules if the blocked URLs that they match
lie on DOMAINS domains (last two host labels) or more; a rule is
dropped if a rule on a part of its tokens is as confident. One domain in HELD_OUT is kept out of the mining, with all its hosts: a rule that
is wrong there more often than its confidence allows goes, and ``precision`` counts what
the rest gets right there. Shares mean the same at every size; what is in
fewer than SUPPORT of the labelled URLs is not mined. So the frequent tokens, which Spark's
FP-growth keeps on the driver, are at most tokens a URL / SUPPORT.

Tokens that always occur together are one item, and a rule needs all of them; tokens of every
URL are no item. So a long list of tokens that only occur together is mined as one.

Rules are matched through an inverted index: each rule stands under its rarest token,
URL tokens join the index, and a URL that has all tokens of a rule is blocked. Without a
match a URL is allowed. Labels are a table (url, verdict); ``op8`` takes those URLs
that the fixed rules judge.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no
rule and is allowed; URLs are read whole, however long; repeated rows each get the verdict; no labels mine no rules;
an empty table gives no rows; other columns, also of the labels, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, salted, table
from tessera.session import materialize

#: Verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Index rows up to which the index is sent to every executor; beyond it, a salted join.
SMALL_INDEX = 20_000
SUPPORT, CONFIDENCE, LEAST, HELD_OUT, DOMAINS = 0.001, 0.9, 0.8, 5, 3
_RULES = "rule_id bigint, antecedent array<string>, confidence double, support double"


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    text = F.coalesce(url, F.lit(""))
    return df.withColumn("host", F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)).withColumn(
        "path", F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    )


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict, or nulls; equal lengths: the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name, verdict = F.when(fits, at + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def tested(rules: list[tuple[str, str, str]] = RULES) -> list[str]:
    """The marked tokens that fixed rules look at."""
    return sorted({f"h:{x}" for _, host, _ in rules for x in host.split(".")} | {f"p:{x}" for _, _, path in rules for x in path.split("/") if x})


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct marked tokens: host labels and their hyphened words, path segments, query keys, scheme."""
    labels = F.split(host, r"\.")
    words = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    mark = lambda kind, column: F.transform(F.filter(column, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(mark("h:", labels), mark("w:", words), mark("p:", F.split(path, "/")), mark("q:", keys)))


def _own(df: DataFrame) -> DataFrame:
    """url and verdict rows with their domain and tokens."""
    parts = with_parts(df)
    return parts.select("url", "verdict", domain_of(F.col("host")).alias("domain"), tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))


def _kept_out() -> Column:
    return F.pmod(F.xxhash64("domain"), F.lit(HELD_OUT)) == 0


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_INDEX else df


def _items(labelled: DataFrame, support: float, ignored: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """Transactions (items: class heads and the label), token classes (head, members, n) and the number of transactions."""
    rows = materialize(labelled.select(F.monotonically_increasing_id().alias("row"), F.concat(F.lit("="), "verdict").alias("label"), "tokens"), "url-labelled")
    size = rows.count()
    each = rows.select("row", F.explode("tokens").alias("token")).filter(~F.col("token").isin(ignored) if ignored else F.lit(True))
    where = F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("where")
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), where).filter((F.col("n") >= support * size) & (F.col("n") < size))
    classes = materialize(often.groupBy("n", "where").agg(F.sort_array(F.collect_list("token")).alias("members")).select(F.col("members")[0].alias("head"), "members", "n"), "url-classes")
    heads = rows.select("row", "label", F.explode_outer("tokens").alias("head")).join(_small(classes.select("head", F.lit(True).alias("known"))), "head", "left")
    items = heads.groupBy("row", "label").agg(F.collect_list(F.when(F.col("known"), F.col("head"))).alias("heads"))
    return materialize(items.select(F.concat("heads", F.array("label")).alias("items")), "url-items"), classes, size


def _lower_bound(confidence: Column, n: Column) -> Column:
    """Wilson's 95 % lower bound of a share seen in n cases."""
    z2 = 1.96**2
    return (confidence + z2 / (2 * n) - 1.96 * F.sqrt(confidence * (1 - confidence) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def mine(labelled: DataFrame, min_support: float = SUPPORT, min_confidence: float = CONFIDENCE, least: float = LEAST, domains: int = DOMAINS, ignored: list[str] | None = None) -> DataFrame:
    """(url, verdict) rows to rules: rule_id, antecedent, confidence, support. Null verdicts are left out; ``ignored`` tokens (default: those that fixed rules test) are no items."""
    from pyspark.ml.fpm import FPGrowth

    own = _own(labelled.select("url", "verdict").filter("verdict is not null"))
    seen = own.filter(~_kept_out())
    items, classes, size = _items(seen, min_support, tested() if ignored is None else ignored)
    if not size:
        return items.sparkSession.createDataFrame([], _RULES)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.filter(F.col("consequent") == F.array(F.lit("=block"))).filter(~F.exists("antecedent", lambda x: x.startswith("=")))
    found = found.filter(_lower_bound(F.col("confidence"), F.col("support") * size / F.col("confidence")) >= least)
    found = materialize(found.select(F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.explode("antecedent").alias("head"), "confidence", "support"), "url-found")
    rules = found.join(_small(classes), "head").groupBy("rule_id").agg(F.flatten(F.collect_list("members")).alias("antecedent"), F.max("confidence").alias("confidence"), F.max("support").alias("support"), F.min_by("head", F.struct("n", "head")).alias("rarest"))
    rules = materialize(rules, "url-rules")
    wide = _hits(seen.filter("verdict = 'block'").select("domain", "url", "tokens"), rules).groupBy("rule_id").agg(F.count_distinct("domain").alias("domains"))
    rules = materialize(rules.join(wide.filter(F.col("domains") >= domains).select("rule_id"), "rule_id"), "url-wide")
    # a rule with another one inside it that is as confident says nothing new; they meet under the inner one's rarest token
    part = rules.select(F.col("antecedent").alias("inner"), F.col("confidence").alias("held"), F.col("rarest").alias("token"))
    whole = rules.select("rule_id", "antecedent", "confidence", F.explode("antecedent").alias("token"))
    hot = hot_keys(whole.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token")
    idle = salted(whole, "token", hot, F.col("rule_id")).join(for_salts(part, "token", hot), ["token", "salt"]).filter(
        (F.size("inner") < F.size("antecedent")) & (F.size(F.array_except("inner", "antecedent")) == 0) & (F.col("held") >= F.col("confidence"))
    )
    rules = materialize(rules.join(idle.select("rule_id").distinct(), "rule_id", "left_anti"), "url-kept")
    # wrong more often than allowed on domains that the mining has not seen
    held = _hits(own.filter(_kept_out()), rules).groupBy("rule_id").agg(F.avg((F.col("verdict") == "block").cast("double")).alias("right"))
    return materialize(rules.join(held.filter(F.col("right") < min_confidence).select("rule_id"), "rule_id", "left_anti").select("rule_id", "antecedent", "confidence", "support"), "url-mined")


def _hits(own: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of ``own`` (url, tokens and more) with rule_id, for each rule all of whose tokens they have."""
    frequency = rules.select(F.explode("antecedent").alias("token")).groupBy("token").count()
    under = rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token")).join(frequency, "token")
    index = materialize(under.groupBy("rule_id").agg(F.first("antecedent").alias("antecedent"), F.min_by("token", F.struct("count", "token")).alias("token")), "url-index")
    each = own.withColumn("token", F.explode("tokens"))
    if index.count() <= SMALL_INDEX:
        met = each.join(F.broadcast(index), "token")
    else:
        hot = hot_keys(each.join(index.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token")
        met = salted(each, "token", hot, F.col("url")).join(for_salts(index, "token", hot), ["token", "salt"]).drop("salt")
    return met.filter(F.size(F.array_except("antecedent", "tokens")) == 0).drop("token", "antecedent")


def precision(labelled: DataFrame, rules: DataFrame) -> DataFrame:
    """(labelled, blocked, matched, right): of the labelled URLs on domains that ``mine`` kept out, how many are to be blocked, how many a rule matches, and how many of these are to be blocked."""
    own = _own(labelled.select("url", "verdict").filter("verdict is not null")).filter(_kept_out())
    hit = _hits(own, rules).select("url").distinct().withColumn("hit", F.lit(True))
    block = F.col("verdict") == "block"
    return own.join(hit, "url", "left").agg(F.count(F.lit(1)).alias("labelled"), F.count_if(block).alias("blocked"), F.count("hit").alias("matched"), F.count_if(block & F.col("hit")).alias("right"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that have all tokens of a rule."""
    own = _own(urls.select("url").filter("url is not null").distinct().withColumn("verdict", F.lit(None).cast("string")))
    return _hits(own, rules).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES, id_column: str = "page_id", url_column: str = "url", min_support: float = SUPPORT, min_confidence: float = CONFIDENCE) -> DataFrame:
    """A row for each row of ``pages``: page_id, url, host, path, rule, verdict."""
    rows = with_parts(named(pages, page_id=id_column, url=url_column))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("fixed", verdict)
    if labelled is None:
        labelled = rows.select("url", F.col("fixed").alias("verdict"))
    open_ = rows.filter("fixed is null and url is not null").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    blocked = materialize(open_.join(matched(open_, mine(labelled, min_support, min_confidence, ignored=tested(rules))), "url"), "url-blocked")
    hot = hot_keys(blocked, "url")  # one url may be that of many rows
    marks = for_salts(blocked.select("url", F.lit("block").alias("mined")), "url", hot)
    return salted(rows, "url", hot, F.col("page_id")).join(marks, ["url", "salt"], "left").select(
        "page_id", "url", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit("allow")).alias("verdict")
    )


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """All of ``pages``."""
    return judge(table(spark, sf_dir, "pages")).drop("url")


QUERIES = {"op8_url_filter": op8_url_filter}
ORACLE: dict[str, str] = {}
