"""Personal data: four exact patterns, and terms that reveal them. DataFrame functions only.

Base spans: the leftmost non-overlapping matches of each kind, found once by
``regexp_extract_all`` (the matches) and once by ``split`` (the text between),
whose running lengths are the places. Places are code points, ends exclusive.

Protected entities: each base span stands for its exact value, for an attribute that others
may share (the domain of an email, the first two parts of an ip, the issuer's six digits of
a card, the first four digits of a phone), and for its kind as a class.

Terms: whole words of three letters or more, in lower case. Over the whole corpus and
whole documents, n(e) counts documents with entity e, n(t) those with term t, n(e, t)
those with both, wherever they stand. The share of e that t discloses is PMI(e, t) / IC(e),
with IC(e) = log2(N / n(e)) and PMI = log2(N n(e,t) / (n(e) n(t))). With at least SUPPORT
such documents, a share of GENERALISE or more makes every occurrence of the term in the
documents of the entity a span ``term`` (to be generalised), REMOVE or more a span
``secret`` (to be removed); occurrences inside a base span are covered by that.
As n(e,t) <= n(e), a pair needs n(t) <= N (n(e)/N)^GENERALISE: others are never formed.

``sanitised`` puts ``[kind]`` for a run of overlapping spans, by the first one's kind, or
nothing for a secret.

Edge cases: null text counts as empty; texts without matches have zero counts and
empty lists (the digest of the empty string) and stay as they are; repeated rows each get a row and
count as documents; an entity in every document discloses nothing; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import for_salts, hot_keys, named, salted, table
from tessera.session import drop_table, materialize

KINDS = ["email", "ip", "card", "phone"]
#: The stated patterns with possessive repeats (nothing that follows could use what they took),
#: and a start that skips positions inside a run that has failed: linear on long runs, no deep recursion.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{3,}(?![\p{L}\p{N}@_%+-]|\.\p{L})"
SUPPORT, GENERALISE, REMOVE = 3, 0.9, 0.98
#: Entities, terms or pairs up to which they are sent to every executor; beyond it, a shuffled join.
SMALL_TERMS = 50_000


def running(lengths: Column) -> Column:
    """Running sums of an array of ints, in blocks of 64 so that long arrays stay cheap."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 64).cast("int")), lambda b: F.slice(lengths, b * 64 + 1, F.lit(64)))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    bases = F.aggregate(blocks, F.array(F.lit(0)), lambda s, b: F.concat(s, F.array(F.element_at(s, -1) + total(b))))
    sums = F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), lambda b, base: F.transform(b, lambda x, j: base + total(F.slice(b, F.lit(1), j + 1))))
    return F.when(F.size(lengths) > 0, F.flatten(sums)).otherwise(F.array().cast("array<int>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    def worth(i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) > 3, False).otherwise(part(p).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def found(text: Column, kind: str) -> Column:
    """Array of (start, rank, kind, end, value) of the valid matches of a kind."""
    pattern = PATTERNS[kind]
    hits, between = _matches(text, pattern), F.split(text, pattern)
    ends = running(F.zip_with(F.slice(between, F.lit(1), F.size(hits)), hits, lambda p, m: F.length(p) + F.length(m)))
    spans = F.transform(
        F.arrays_zip(hits.alias("value"), ends.alias("stop")),
        lambda x: F.struct(
            (x["stop"] - F.length(x["value"])).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), x["stop"].alias("end"), x["value"].alias("value"),
        ),
    )
    spans = F.filter(spans, lambda x: valid(kind, x["value"]))
    kind_of = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"
    possible = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
    return F.when(possible, spans).otherwise(F.array().cast(kind_of)).cast(kind_of)


def _met(rows: DataFrame, keyed: DataFrame, key: str | list[str], n: str) -> DataFrame:
    """Rows (with row_id) with the columns of their key; ``keyed`` has one row a key and in ``n`` a bound of its rows."""
    if keyed.count() <= SMALL_TERMS:
        return rows.join(F.broadcast(keyed), key)
    hot, on = hot_keys(keyed, key, n), [key] if isinstance(key, str) else key
    return salted(rows, key, hot, F.col("row_id")).join(for_salts(keyed, key, hot), [*on, "salt"]).drop("salt")


def entities(spans: Column) -> Column:
    """Distinct entities of base spans: kind:value, kind/attribute, kind."""
    digits = lambda s, n: F.substring(_digits(s["value"]), 1, n)
    attribute = lambda s: F.when(s["kind"] == "email", F.lower(F.substring_index(s["value"], "@", -1))).when(s["kind"] == "ip", F.substring_index(s["value"], ".", 2)).when(s["kind"] == "card", digits(s, 6)).otherwise(digits(s, 4))
    named_ = lambda s: F.array(F.concat_ws(":", s["kind"], s["value"]), F.concat_ws("/", s["kind"], attribute(s)), s["kind"])
    return F.array_distinct(F.flatten(F.transform(spans, named_)))


def base_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """row_id, doc_id, the sorted base spans of every row, the text of those with any and the sha256 of the others; written once, for row ids must not change."""
    rows = named(docs, doc_id=id_column, text=text_column).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = F.array_sort(F.concat(*[found(F.col("text"), k) for k in KINDS]))
    rows = rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", spans.alias("spans"), "text")
    some = F.size("spans") > 0
    return materialize(rows.select("row_id", "doc_id", "spans", F.when(~some, F.sha2("text", 256)).alias("plain_sha256"), F.when(some, F.col("text")).alias("text")), "pii-base")


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(_matches(text, TERM), F.lower))


def places(text: Column) -> Column:
    """All terms of a text with their places."""
    hits, between = _matches(text, TERM), F.split(text, TERM)
    ends = running(F.zip_with(F.slice(between, F.lit(1), F.size(hits)), hits, lambda p, m: F.length(p) + F.length(m)))
    return F.transform(F.arrays_zip(hits.alias("word"), ends.alias("stop")), lambda x: F.struct(F.lower(x["word"]).alias("term"), (x["stop"] - F.length(x["word"])).alias("start"), x["stop"].alias("end")))


def together(docs: DataFrame, base: DataFrame, size: int, text_column: str = "text", support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """row_id, entity, term, n_e, n_t of the entities and terms of each row, without pairs that cannot reach ``support`` and ``generalise``."""
    own = base.select("row_id", F.explode(entities(F.col("spans"))).alias("entity"))
    of_entity = materialize(own.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") >= support), "pii-entities")
    top = of_entity.agg(F.max("n_e")).first()[0] or 0
    own = _met(own, of_entity, "entity", "n_e").groupBy("row_id").agg(F.collect_list(F.struct("entity", "n_e")).alias("entities"))
    held = materialize(own.join(base.select("row_id", "text"), "row_id").select("row_id", "entities", terms(F.col("text")).alias("terms")), "pii-held")
    most = lambda n_e: size * F.pow(n_e / size, F.lit(generalise)) * (1 + 1e-9)
    # a term is in at least as many documents as it is here: what falls short never gets there
    known = materialize(held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= support) & (F.col("n") <= most(F.lit(top)))).select("term"), "pii-known")
    words = docs.select(F.explode(terms(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))).alias("term"))
    # counted before the exchange and the join, for some words are in all documents
    of_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(known, "term", "left_semi")
    of_term = materialize(of_term.filter(F.col("n_t") <= most(F.lit(top))), "pii-terms")
    pairs = _met(held.select("row_id", "entities", F.explode("terms").alias("term")), of_term, "term", "n_t").select("row_id", "term", "n_t", F.explode("entities").alias("e"))
    near = materialize(pairs.select("row_id", "e.entity", "term", "e.n_e", "n_t").filter(F.col("n_t") <= most(F.col("n_e"))), "pii-near")
    drop_table(of_entity, held, known, of_term)
    return near


def _share(size: int) -> Column:
    """PMI(e, t) / IC(e) of the columns n_e, n_t, n_et; 0 where e is in every document."""
    information = F.log2(F.lit(float(size)) / F.col("n_e"))
    mutual = F.log2(F.lit(float(size)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    return F.when(information > 0, mutual / information).otherwise(0.0)


def disclosing(near: DataFrame, size: int, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, share) of the pairs whose share reaches ``generalise``; counts cover the whole corpus."""
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t")).filter(F.col("n_et") >= support)
    return materialize(pairs.select("entity", "term", "n_et", _share(size).alias("share")).filter(F.col("share") >= generalise), "pii-pairs")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """row_id, doc_id, base (array of start, rank, kind, end, value), added (array of start, rank, kind, end), text (null without spans), plain_sha256 (of a text without) for each row."""
    base, size = base_spans(docs, id_column, text_column), max(1, docs.count())
    near = together(docs, base, size, text_column, support, generalise)
    reveal = disclosing(near, size, support, generalise)
    shares = _met(near.select("row_id", "entity", "term"), reveal, ["entity", "term"], "n_et").groupBy("row_id", "term").agg(F.max("share").alias("share"))
    shares = shares.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    hits = F.transform(places(F.col("text")), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.try_element_at("shares", p["term"]).alias("share")))
    hits = F.filter(hits, lambda p: p["share"].isNotNull())
    hits = F.filter(hits, lambda p: ~F.exists("spans", lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"])))
    rank = lambda p: (F.lit(len(KINDS)) + (p["share"] >= remove).cast("int")).alias("rank")
    kind = lambda p: F.when(p["share"] >= remove, "secret").otherwise("term").alias("kind")
    added = F.array_sort(F.transform(hits, lambda p: F.struct(p["start"].alias("start"), rank(p), kind(p), p["end"].alias("end"))))
    added = base.select("row_id", "spans", "text").join(shares, "row_id").select("row_id", added.alias("added"))
    return base.join(added, "row_id", "left").select(
        "row_id", "doc_id", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))).alias("base"),
        F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")).alias("added"), "text", "plain_sha256",
    )


def all_spans() -> Column:
    """Base and added spans of a row of ``detect``, sorted."""
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(F.concat(plain, "added"))


def digests(detected: DataFrame) -> DataFrame:
    """Counts, lists of spans and the sanitised text's sha256, one row for each row of ``detect``."""
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [number(k).alias(f"n_{k}") for k in KINDS]
    clean = F.coalesce("plain_sha256", F.sha2(sanitised(F.col("text"), all_spans()), 256))
    return detected.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(all_spans()).alias("spans"), F.size("added").cast("bigint").alias("n_added"), clean.alias("clean_sha256"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with spans (sorted; start, kind, end) replaced by ``[kind]``, those of kind ``secret`` by nothing; what overlapping ones cover goes whole."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        put = F.when(x["kind"] == "secret", "").otherwise(F.concat(F.lit("["), x["kind"], F.lit("]")))
        more = F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), put)
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], more).otherwise(s["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def op7_pii_sanitise(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return digests(detect(table(spark, sf_dir, "documents")))


QUERIES = {"op7_pii_sanitise": op7_pii_sanitise}
ORACLE: dict[str, str] = {}
