import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import privacy, urls

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), privacy.KINDS.index(k), k, m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0]))


TEXTS = [
    None, "", "no data", "a@b.c_d@e.f.g x@y", "mail éa.b+c@d-e.com, ünd 1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 and 5500 0000 0000 0004.", "+1 (389) 555-5010 +49-30-1234567 +12 +3 4 5",
    "a" * 20000, "1" * 20000, "1 " * 9000, ". " * 5000 + "x@y.zz", "a@b@c.d 𝔘𝔫 z@q.rs " * 200, "+1234567890123456 +123456789012345",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "q") for i, t in enumerate(TEXTS + TEXTS[3:5])], "doc_id bigint, text string, spans string")


def test_base_spans_equal_the_stated_patterns(spark, docs):
    got = {r.doc_id: r for r in privacy.digests(privacy.detect(docs)).collect()}
    assert len(got) == len(TEXTS) + 2
    for i, text in enumerate(TEXTS + TEXTS[3:5]):
        spans = brute(text)
        assert [got[i][f"n_{k}"] for k in privacy.KINDS] == [sum(s[2] == k for s in spans) for k in privacy.KINDS], text
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert privacy.detect(docs.limit(0)).count() == 0


def test_terms_that_reveal(spark):
    rows = [(i, f"the agent zorblax wrote to spy@hide.org about the weather {i}") for i in range(6)]
    rows += [(i, f"the weather about the agent was fine, wrote {i}") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = privacy.detect(docs).collect()
    for r in found:
        text = dict(rows)[r.doc_id]
        words = {text[s.start : s.end] for s in r.added}
        assert words == ({"zorblax"} if r.doc_id < 6 else set())
    clean = privacy.detect(docs).select("doc_id", privacy.sanitised(F.col("text"), privacy.all_spans()).alias("clean"))
    assert {r.clean for r in clean.collect() if r.doc_id == 1} == {"the agent  wrote to [email] about the weather 1"}
    digests = {r.doc_id: r for r in privacy.digests(privacy.detect(docs)).collect()}
    assert digests[1].clean_sha256 == hashlib.sha256(b"the agent  wrote to [email] about the weather 1").hexdigest() and digests[1].n_added == 1
    assert digests[10].clean_sha256 == hashlib.sha256(dict(rows)[10].encode()).hexdigest() and digests[10].n_added == 0


def test_overlapping_spans_go_whole(spark):
    text = "at 1.2.3.4 1111 1111 1119 or a@b.cd +1 (389) 555-5010"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = privacy.detect(docs)
    assert len(found.first().base) == 4
    clean = found.select(privacy.sanitised(F.col("text"), privacy.all_spans()).alias("c")).first().c
    assert clean == "at [ip] or [email] [phone]" and not re.search("[0-9]", clean)


def test_terms_are_counted_and_marked_in_whole_documents(spark):
    far = " and then some plain words" * 8
    rows = [(i, f"Zorblax knows{far} other{i % 4}@x.org writes to spy@hide.org{far} zorblax again") for i in range(6)]
    rows += [(i, f"knows writes again{far} {i}") for i in range(10, 60)] + [(60, "zorblax"), (61, "spy@hide.org")]
    found = privacy.detect(spark.createDataFrame(rows, "doc_id bigint, text string"), generalise=0.7).collect()
    for r in found:
        text = dict(rows)[r.doc_id]
        assert [text[s.start : s.end] for s in r.added] == (["Zorblax", "zorblax"] if r.doc_id < 6 else []), text


def own_entities(text):
    """Entities of a text, by the stated patterns and rules."""
    out = set()
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            if good(kind, m[0]):
                digits = re.sub("[^0-9]", "", m[0])
                out |= {f"{kind}:{m[0]}", kind, f"{kind}/" + {"email": m[0].rpartition("@")[2].lower(), "ip": ".".join(m[0].split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]}
    return out


WORD = r"(?<![^\W_])(?<![@._%+-])[^\W\d_]{3,}(?![^\W_]|[@_%+-]|\.[^\W\d_])"


def test_added_spans_of_the_tables_equal_brute_force(spark):
    """All added spans of a real table, from counts over its whole texts."""
    import math
    import os
    from collections import Counter, defaultdict

    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no tables")
    docs = spark.read.parquet(path)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    words = [{m[0].lower() for m in re.finditer(WORD, t)} for _, t in rows]
    entities = [own_entities(t) for _, t in rows]
    n, n_t, n_e, n_et = len(rows), Counter(w for s in words for w in s), Counter(e for s in entities for e in s), Counter()
    for s, es in zip(words, entities):
        n_et.update((e, w) for e in es for w in s)
    share = defaultdict(dict)
    for (e, w), both in n_et.items():
        if both >= privacy.SUPPORT and n_e[e] < n:
            of = math.log2(n * both / (n_e[e] * n_t[w])) / math.log2(n / n_e[e])
            if of >= privacy.GENERALISE:
                share[e][w] = of
    want = {}
    for (i, text), es in zip(rows, entities):
        reveal = {}
        for e in es:
            for w, of in share[e].items():
                reveal[w] = max(of, reveal.get(w, 0))
        base = brute(text)
        hits = [(m.start(), m.end(), reveal[m[0].lower()]) for m in re.finditer(WORD, text) if m[0].lower() in reveal]
        want[i] = [("secret" if of >= privacy.REMOVE else "term", a, b) for a, b, of in hits if not any(s[0] < b and a < s[3] for s in base)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.added] for r in privacy.detect(docs).collect()}
    assert got == want
    assert sum(map(len, want.values())) > 0


def test_disclosing_pairs_equal_brute_force(spark):
    import math
    import random

    rng = random.Random(5)
    rows = [(i, " ".join([*rng.choices([f"word{'abcdefghijkl'[k]}" for k in range(12)], k=5), "filler " * 30, *rng.choices([f"m{k}@x.org" for k in range(9)], k=rng.randrange(3))])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = [(own_entities(t), set(re.findall(r"(?<!\S)[a-z]{3,}(?!\S)", t))) for _, t in rows]
    want, n = {}, len(rows)
    for e in set().union(*[s[0] for s in sets]):
        for t in set().union(*[s[1] for s in sets]):
            n_e, n_t, n_et = sum(e in s[0] for s in sets), sum(t in s[1] for s in sets), sum(e in s[0] and t in s[1] for s in sets)
            if n_et >= 3 and (share := math.log2(n * n_et / (n_e * n_t)) / math.log2(n / n_e)) >= 0.1:
                want[e, t] = round(share, 9)
    near = privacy.together(docs, privacy.base_spans(docs), n, generalise=0.1)
    got = {(r.entity, r.term): round(r.share, 9) for r in privacy.disclosing(near, n, generalise=0.1).collect()}
    assert got == want and want


def test_running_sums(spark):
    got = spark.range(1).select(privacy.running(F.sequence(F.lit(1), F.lit(200))).alias("s"), privacy.running(F.array().cast("array<int>")).alias("e")).first()
    assert got.s == [i * (i + 1) // 2 for i in range(1, 201)] and got.e == []


def test_url_rules_and_parts(spark):
    rows = [(1, "HTTP://A.Example.NET/en/x?q#f"), (2, "http://a.example.net/de/"), (3, "https://example.com/de/1"), (4, "x://b.org/fr/"), (5, None), (6, "nothing"), (7, "a://net"), (8, "a://xnet/"), (9, "x://b.org/en/"), (9, "x://b.org/en/")]
    got = sorted(map(tuple, urls.judge(spark.createDataFrame([(*r, "h") for r in rows], "page_id int, url string, host string")).drop("url").collect()), key=str)
    want = [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "a.example.net", "/de/", "net/", "block"), (3, "example.com", "/de/1", "example.com/de/", "block"),
        (4, "b.org", "/fr/", "org/fr/", "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "net", "", None, "allow"), (8, "xnet", "/", None, "allow"),
        (9, "b.org", "/en/", None, "allow"), (9, "b.org", "/en/", None, "allow"),
    ]
    assert got == sorted(want, key=str)
    assert urls.judge(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_mined_rules(spark):
    seen = [(f"http://cheap-{w}.com/{i}", "block", 1) for i in range(10) for w in ("pills", "loans", "cars", "bets", "wins", "teas", "nuts")] + [(f"http://good{i % 7}.org/{i}", "allow", 2) for i in range(60)]
    labels = spark.createDataFrame(seen, "url string, verdict string, host int")
    rules = urls.mine(labels)
    assert ["w:cheap"] in [r.antecedent for r in rules.collect()]
    assert all(r.confidence >= 0.9 for r in rules.collect())
    pages = spark.createDataFrame([(1, "http://cheap-tricks.org/"), (2, "http://good.com/1"), (3, "http://new.org/"), (4, "http://cheap-a.org/" + "x/" * 30000), (1, "http://cheap-tricks.org/")], "page_id int, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, labels).collect()} == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert urls.judge(pages, labels).count() == 5 and urls.judge(pages, labels.limit(0)).filter("verdict = 'block'").count() == 0
    assert urls.mine(spark.createDataFrame([("http://a.com/", None)], "url string, verdict string")).count() == 0


def test_rules_equal_all_subsets(spark):
    """Mined rules against every set of tokens of every labelled URL, counted one by one."""
    import random
    from itertools import combinations

    rng = random.Random(3)
    words, rows = ["ad", "pop", "casino", "win", "news", "blog"], []
    for i in range(900):
        host = f"{rng.choice(words)}-{rng.choice(words)}.s{rng.randrange(40)}.com"
        path = "/".join(rng.choices(["es", "it", "de", "x", "y"], k=rng.randrange(3)))
        rows.append((f"http://{host}/{path}", "block" if ("casino" in host and "win" in host) or rng.random() < 0.03 else "allow"))
    labels = spark.createDataFrame(rows, "url string, verdict string")
    own = urls._own(labels).withColumn("out", F.pmod(F.xxhash64("domain"), F.lit(urls.HELD_OUT)) == 0).collect()
    mined, held = [(frozenset(r.tokens), r.verdict) for r in own if not r.out], [(frozenset(r.tokens), r.verdict) for r in own if r.out]
    domains = [r.domain for r in own if not r.out]
    assert not set(domains) & {r.domain for r in own if r.out}
    where = {}
    for t in set().union(*[s for s, _ in mined]) - {"h:com", "h:example", "h:net", "h:org", "p:de", "p:en", "p:fr"}:
        at = frozenset(i for i, (s, _) in enumerate(mined) if t in s)
        if 0.01 * len(mined) <= len(at) < len(mined):
            where.setdefault(at, []).append(t)
    members = {min(v): sorted(v) for v in where.values()}
    counts = {}
    for s, verdict in mined:
        heads = sorted(h for h, v in members.items() if h in s)
        for k in range(1, len(heads) + 1):
            for part in combinations(heads, k):
                n = counts.setdefault(part, [0, 0])
                n[0] += 1
                n[1] += verdict == "block"

    def bound(p, n, z2=1.96**2):
        return (p + z2 / (2 * n) - 1.96 * (p * (1 - p) / n + z2 / (4 * n * n)) ** 0.5) / (1 + z2 / n)

    found = {p: b / n for p, (n, b) in counts.items() if b >= 0.01 * len(mined) and b / n >= 0.9 and bound(b / n, n) >= urls.LEAST}
    wide = lambda p: {d for d, (s, v) in zip(domains, mined) if v == "block" and all(t in s for h in p for t in members[h])}
    found = {p: c for p, c in found.items() if len(wide(p)) >= urls.DOMAINS}
    kept = {p: c for p, c in found.items() if not any(set(q) < set(p) and d >= c for q, d in found.items())}
    want = {}
    for p, c in kept.items():
        tokens = frozenset(t for h in p for t in members[h])
        right = [v == "block" for s, v in held if tokens <= s]
        if not right or sum(right) / len(right) >= 0.9:
            want[tokens] = round(c, 9)
    rules = urls.mine(labels, 0.01)
    assert {frozenset(r.antecedent): round(r.confidence, 9) for r in rules.collect()} == want and want
    hit = [any(t <= s for t in want) for s, _ in held]
    got = urls.precision(labels, rules).first()
    assert tuple(got) == (len(held), sum(v == "block" for _, v in held), sum(hit), sum(h and v == "block" for h, (_, v) in zip(hit, held)))
    blocked = {r.url for r in urls.matched(labels, rules).collect()}
    assert blocked == {r.url for r in own if any(t <= set(r.tokens) for t in want)}


def test_tokens_that_only_occur_together_are_one_item(spark):
    path = "/".join(f"k{i}" for i in range(40))  # 2**40 sets, one by one
    seen = [(f"http://h{i}.bad{i % 9}.com/{path}", "block") for i in range(90)] + [(f"http://h{i}.good{i % 9}.com/", "allow") for i in range(90)]
    rules = urls.mine(spark.createDataFrame(seen, "url string, verdict string")).collect()
    assert any(len(r.antecedent) == 40 for r in rules)


def test_rules_of_one_domain_or_of_tested_tokens_are_none(spark):
    """Neither what only one domain shows nor what a fixed rule looks at becomes a rule."""
    seen = [(f"http://a{i}.one.com/junk/{i}", "block") for i in range(80)] + [(f"http://b{i}.d{i % 9}.net/x{i}", "block") for i in range(90)] + [(f"http://c{i}.e{i % 9}.org/fr/y{i}", "allow") for i in range(90)]
    rules = urls.mine(spark.createDataFrame(seen, "url string, verdict string")).collect()
    assert not [r for r in rules if set(r.antecedent) & {"h:net", "h:com", "h:one", "p:junk"}]
