import random

from pyspark.sql import functions as F

from mesura.llm import url_filter as U

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:k], rest[k:]
    j = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return host.translate(str.maketrans(UPPER, LOWER)), tail[:j]


def rule(host, path):
    fit = [(len(h) + len(p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def urls(rng):
    out = [f"{rng.choice(['http', 'https'])}://{rng.choice(['', 'www.', 'm.', 'blog.'])}{rng.choice(['site', 'other', 'spam', 'example'])}.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randrange(300)}{rng.choice(['', '/', '.html', '?page=2&ref=x', '#top'])}" for _ in range(500)]
    return out + [None, "", "no scheme", "://", "http://", "HTTP://WWW.ÉXAMPLE.ORG/ES/", "http://example.org", "http://example.org?x=/es/", "http://example.org/es/?q", "http://notexample.org/es/1", "x://a://b.org/c", "http://org/",
                  "http://sub.example.org/en/1", "http://example.org/en/2", "http://a.com/de/?x#y", "http://a.com:80/de/", "http://a\n.org/b\nc?d", "http://x.org/" + "a/" * 5000] + ["http://dup.com/de/1"] * 300


def test_host_path_rule_and_verdict(spark):
    data = urls(random.Random(3))
    df = spark.createDataFrame([(k if k else None, u, "h", "t") for k, u in enumerate(data)], "page_id long, url string, host string, tokens string")
    got = {r["page_id"]: r for r in U.filter_urls(df).collect()}
    assert len(got) == len(data)
    rows = []
    for k, u in enumerate(data):
        r, (host, path) = got[k if k else None], parts(u)
        assert (r["host"], r["path"]) == (host, path), u
        name, verdict = rule(host, path)
        assert r["rule"] == name and r["verdict"] in ("allow", "block")
        if verdict:
            assert r["verdict"] == verdict and r["mined"] is None
            rows.append((U.url_tokens(u), verdict))
    # what was mined is as sure and as common as it says, by brute force over the labelled URLs
    p, n = U.Params(), len(rows)
    mined = {(r["mined"], r["verdict"], r["confidence"]) for r in got.values() if r["mined"]}
    assert mined
    for tokens, verdict, confidence in mined:
        own = set(tokens.split(" + "))
        fit = [v for t, v in rows if own <= set(t)]
        hits = fit.count(verdict)
        assert abs(hits / len(fit) - confidence) < 1e-6 and hits / len(fit) >= p.confidence and hits / n >= p.support - 1e-9
    # every unlisted URL takes the surest rule that fits
    for k, u in enumerate(data):
        r = got[k if k else None]
        if r["rule"] is None and r["mined"] is None:
            assert r["verdict"] == p.default
    assert got[data.index("http://example.org")]["rule"] is None


def test_index_takes_the_surest_whole_match():
    rules = [(("a",), "allow", 0.7, 0.5), (("a", "b"), "block", 0.9, 0.1), (("c",), "block", 0.9, 0.2), (("a", "d"), "allow", 0.9, 0.2)]
    index = U.RuleIndex(rules, "allow")
    assert index.match(["a"])[0] == "allow" and index.match(["b"]) == ("allow", None, 0.0)
    assert index.match(["b", "a"])[:2] == ("block", "a + b") and index.match(["a", "b", "c"])[:2] == ("block", "c")
    assert index.match(["c", "d", "a"])[:2] == ("allow", "a + d") and index.match([])[0] == "allow"


def test_empty_and_unlabelled_tables(spark):
    schema = "page_id long, url string"
    assert U.filter_urls(spark.createDataFrame([], schema)).count() == 0
    got = U.filter_urls(spark.createDataFrame([(1, "http://a.net/x"), (2, None)], schema)).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [(None, "allow")] * 2
    assert U.filter_urls(spark.createDataFrame([(1, "http://a.org/x")] * 3, schema)).filter(F.col("verdict") == "allow").count() == 3


def test_less_sure_rules_survive_many_redundant_ones(spark):
    rng = random.Random(5)
    parts = [f"p{chr(97 + k)}" for k in range(14)]
    data = ["http://a.org/" + "/".join(x for x in parts if rng.random() < 0.9) for _ in range(400)]
    data += [f"http://a.com/{'de' if k % 5 else 'fr'}/x.html" for k in range(50)] + ["ftp://b.net/y.html"]
    df = spark.createDataFrame(list(enumerate(data)), "page_id long, url string")
    (got,) = U.filter_urls(df).filter(F.col("rule").isNull()).collect()
    assert (got["verdict"], got["mined"], round(got["confidence"], 9)) == ("block", "ending:html", 0.8)


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(9)
    names = list("abcdefgh")
    rows = []
    for _ in range(120):
        t = [x for x in names if rng.random() < 0.5] + ["every"]
        t += ["twin"] if "a" in t else []
        rows.append((t, "block" if ("b" in t and "c" in t) or rng.random() < 0.3 else "allow"))
    rows += [(["every", "pure", *rng.sample(names[1:], 3)], "allow") for _ in range(20)]
    p = U.Params(support=0.03, confidence=0.6)
    index, n, rules = U.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), p), len(rows), {}
    tokens = [*names, "every", "twin", "pure"]
    for k in range(1, 1 << len(tokens)):
        own = frozenset(t for j, t in enumerate(tokens) if k >> j & 1)
        fit = [v for t, v in rows if own <= set(t)]
        for v in ("allow", "block"):
            if fit.count(v) >= p.support * n and fit.count(v) / len(fit) >= p.confidence:
                rules[own, v] = (round(fit.count(v) / len(fit), 9), round(fit.count(v) / n, 9))
    shortest = {(own, v) for (own, v), (c, _) in rules.items() if not any(o < own and w == v and d >= c for (o, w), (d, _) in rules.items())}
    named = {(frozenset(r[0]), r[1]) for r in index.rules}
    assert {(own - {"twin"} | ({"a"} if "twin" in own else set()), v) for own, v in shortest} == named
    for _ in range(300):
        own = [t for t in tokens if rng.random() < 0.4]
        fits = [(c, s, v) for (o, v), (c, s) in rules.items() if o <= set(own)]
        best = max(fits, key=lambda x: x[:2], default=(0.0, 0.0, p.default))
        got = index.match(own)
        assert got[2] == best[0] and got[0] in {v for c, s, v in fits if (c, s) == best[:2]} | ({p.default} if not fits else set())
