"""URL rules, sharding and mixing: small tables, plan shapes, brute force."""

import collections

import pytest
from pyspark.sql import functions as F

from wattlake.llm import mixing, sharding, url_rules
from wattlake.llm import queries as Q
from wattlake.llm.common import prepare, table
from wattlake.llm.components import components

from ..conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op2_url_rules", "op4_sharding"])
def test_native_plans_have_no_python(spark, name):
    text = plan_of(Q.QUERIES[name](spark, SF_SMALL))
    assert not any(w in text for w in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_lookup_table_turns():
    """Every slot is claimed, shares differ by one slot at most, and losing a shard moves few keys."""
    names = [f"s{i}" for i in range(10)]
    full = sharding.lookup(names, 1009)
    assert sorted(collections.Counter(full).values()) == [100] * 1 + [101] * 9
    less = sharding.lookup(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 9)
    assert moved < 0.25 * 1009
    assert sharding.lookup(["only"], 2) == [0, 0]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup(bad, 7)
    with pytest.raises(ValueError):
        sharding.lookup(names, 1000)


def test_sharding_odd_rows(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "x", "old"), (1, "x", "old"), (None, None, None)], "doc_id long, text string, shard string")
    got = sharding.assign(df, "doc_id", ["a", "b", "c"], 7).collect()
    assert len(got) == 3 and len({r.shard for r in got if r.doc_id == 1}) == 1 and all(0 <= r.shard < 3 for r in got)
    assert sharding.assign(df.where("false"), "doc_id", ["a"], 7).count() == 0
    assert "BroadcastHashJoin" in plan_of(sharding.assign(df, "doc_id", ["a", "b", "c"], 7))


URLS = [(1, "http://www.Example.com/en/x?q"), (2, "https://example.com/en/"), (3, "http://example.com/en"), (4, "ftp://a.b.net/es/1#f"),
        (5, "http://net/fr/"), (6, "no scheme"), (7, None), (8, ""), (9, "http://x.org/my-casino-site"), (10, "http://x.org/mycasino"),
        (11, "http://xcom/a"), (12, "http://casino-win.org"), (12, "http://casino-win.org"), (13, "http://a.com"), (14, "x://y://net/es/"),
        (15, "http://ads-track.example.org/EN/"), (16, "http://example.com/en/%0Aé"), (None, "http://q.com/")]


def url_brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if r.site and (host == r.text.split("/", 1)[0] or host.endswith("." + r.text.split("/", 1)[0]))
            and path.startswith("/" + r.text.split("/", 1)[1])]
    best = max(fits, key=lambda r: (len(r.text), r.text), default=None)
    return host, path, best.text if best else None, best.action if best else None


def test_url_rules(spark):
    prepare(spark)
    df = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("token", F.lit(2))
    got = url_rules.judge(df, Q.URL_RULES).collect()
    assert len(got) == len(URLS)
    by = {}
    for r in got:
        by[r.page_id] = r
    for i, u in URLS:
        host, path, rule, action = url_brute(u, Q.URL_RULES)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule), u
        if action:
            assert by[i].verdict == action
    assert by[9].method_rule == "*-casino" or by[9].method_rule == "casino-*"
    assert by[10].method_rule is None and by[10].verdict == "allow"
    assert by[12].verdict == "block" and by[15].method_rule == "ads-track"
    assert url_rules.judge(df.where("false"), Q.URL_RULES).count() == 0


def test_rules_without_token_and_long_paths(spark):
    """A rule with no whole literal token is a candidate everywhere; a path prefix may end inside a token."""
    prepare(spark)
    df = spark.createDataFrame([(1, "http://a.org/abcdef"), (2, "http://b.org/x")], "page_id long, url string")
    rules = [url_rules.Rule("a.org/abc", "block"), url_rules.Rule("*x*", "block", site=False)]
    assert rules[1].tokens() == [] and rules[0].tokens() == ["a", "org"]
    got = {r.page_id: (r.rule, r.method_rule, r.verdict) for r in url_rules.judge(df, rules).collect()}
    assert got == {1: ("a.org/abc", None, "block"), 2: (None, "*x*", "block")}


def test_index_key_is_the_rarest_token(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, f"http://big.org/rare{i % 3}/page") for i in range(30)], "page_id long, url string")
    pages = df.select(F.explode(url_rules.url_tokens(F.col("url"))).alias("token"))
    idx = url_rules.rule_index(spark, [url_rules.Rule("big.org/rare1/", "block")], pages).collect()
    assert [r.token for r in idx] == ["rare1"]


def water_fill(budget, kids):
    """{name: (w, cap)} -> {name: alloc} in integers."""
    out, left, names = {}, budget, sorted(kids, key=lambda k: (kids[k][1] / kids[k][0], k))
    while names:
        k, w = names[0], sum(kids[n][0] for n in names)
        if kids[k][1] * w <= left * kids[k][0]:
            out[k] = kids[k][1]
            left -= kids[k][1]
            names.pop(0)
        else:
            out |= {n: min(left * kids[n][0] // w, kids[n][1]) for n in names}
            break
    return out


def mix_brute(rows, domain, weights, seed, epochs):
    import hashlib
    n = {}
    docs = collections.defaultdict(list)
    for i, t, lang, src in rows:
        leaf = (domain(src), lang or "?", src or "?")
        k = len((t or "").split())
        docs[leaf].append((i, k))
        n[leaf] = n.get(leaf, 0) + k
    w = lambda level, name: weights.get(level, {}).get(name, 1)
    cap = lambda p: sum(v * epochs for k, v in n.items() if k[:len(p)] == p)
    plan = {(): sum(n.values())}
    for depth, level in enumerate(("domain", "lang", "source")):
        nxt = {}
        for p, b in plan.items():
            kids = {k[depth] for k in n if k[:depth] == p}
            nxt |= {(*p, k): v for k, v in water_fill(b, {k: (w(level, k), cap((*p, k))) for k in kids}).items()}
        plan = nxt
    out = []
    for leaf, b in plan.items():
        if not n[leaf]:
            continue
        whole, rest = divmod(b, n[leaf])
        key = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()  # noqa: E731, B023
        sums = collections.Counter()
        for i, k in docs[leaf]:
            sums[key(i)] += k
        run, taken = 0, set()
        for u in sorted(sums):
            run += sums[u]
            if rest and run <= rest:
                taken.add(u)
        for i, _ in docs[leaf]:
            out += [(i, leaf[0], e) for e in range(whole + (key(i) in taken))]
    return sorted(out, key=str)


def test_mixing(spark):
    prepare(spark)
    rows = [(i, "w " * (i * 7 % 13), ["en", "de", None][i % 3], f"s{i % 5}") for i in range(200)]
    rows += [(7, "a b", "en", "s0"), (7, "a b", "en", "s0"), (None, "x", "en", None), (500, None, "fr", "s9"), (501, "", "fr", "s9"), (502, "w " * 3000, "es", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"epoch": F.lit("old"), "rest": F.lit(1), "__whole": F.lit("mine"), "__b": F.lit(2), "c0": F.lit(3), "given": F.lit(4)})
    weights = {"domain": {"odd": 3}, "lang": {"en": 1, "de": 5}}
    for epochs in (1, 3):
        got = mixing.select_mix(df, F.when(F.col("source").isin("s1", "s3"), "odd").otherwise("even"), weights, "s", (1, 1), epochs).collect()
        assert all((r.rest, r["__whole"], r["__b"], r.c0, r.given) == (1, "mine", 2, 3, 4) for r in got)
        assert sorted(((r.doc_id, r["__domain"], r.epoch) for r in got), key=str) == mix_brute(
            rows, lambda s: "odd" if s in ("s1", "s3") else "even", weights, "s", epochs)
    assert mixing.select_mix(df.where("false"), F.lit("d"), {}, "s").count() == 0


def test_shortage_goes_to_siblings_first(spark):
    """A short leaf's budget stays in its language as long as its siblings can take it."""
    prepare(spark)
    leaves = spark.createDataFrame([("a", "en", "x", 10), ("a", "en", "y", 1000), ("a", "de", "z", 1000), ("b", "en", "u", 2000)],
                                   "__domain string, __lang string, __source string, supply long")
    got = {r["__source"]: int(r["alloc"]) for r in mixing.budgets(leaves, {}, 2, 5, 1).collect()}
    assert got == {"x": 10, "y": 391, "z": 401, "u": 802}


def test_components(spark):
    prepare(spark)
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (-4, 9), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (3, 30)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 1 for k in (1, 2, 3, 30)} | {k: -4 for k in (8, 9, -4)} | {k: 20 for k in range(20, 25)} | {k: 100 for k in range(100, 141)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    """Every stage works on what its predecessor kept, keeps the columns, and its decision takes effect."""
    import corpus_pipeline as P
    from wattlake.llm import decontaminate

    from .test_dedup import near_brute
    from .util import UP
    docs = table(spark, SF_SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, step in P.STAGES:
        before = docs
        from wattlake.llm.common import stage
        docs = stage(spark, step(spark, docs, SF_SMALL), f"test-{name}")
        seen[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == columns
    before, after = seen["near_duplicates"]
    rows = [(r.doc_id, (r.text or "").translate(UP)) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == set(near_brute(rows, 5, 80, 100).values())
    before, after = seen["decontamination"]
    bad = {r.doc_id for r in decontaminate.hits(before, table(spark, SF_SMALL, "benchmark")).collect()}
    assert bad and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
    assert seen["quality"][1].count() < seen["quality"][0].count()
    last = seen["sharding"][1]
    assert last.count() == seen["mixing"][1].count() and set(last.columns) == {*columns, "slot", "shard"}
    for name, step in P.STAGES:
        odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0)], seen["quality"][0].schema)
        assert step(spark, odd, SF_SMALL).count() >= 0, name
        assert step(spark, odd.where("false"), SF_SMALL).count() == 0, name
