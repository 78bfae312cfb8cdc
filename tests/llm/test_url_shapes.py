"""Operator 2: urls of any length, rule lists of several shapes, empty tables."""

import random

from offblock.llm import url_filter

RULE = "verdict string, host string, path string"


def judge(url, rules):
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), v == "block", (h + p).encode(), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, "allow")


def run(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(df, spark.createDataFrame(rules, RULE)).collect()}


def test_very_long_urls(spark):
    urls = ["http://a.net" + "/x" * 100_000, "http://" + "a." * 50_000 + "net/", "http://b.org/" + "y" * 500_000, "http://example.net/en" + "/en" * 100_000]
    got = run(spark, urls, url_filter.RULES)
    assert got == {i: judge(u, url_filter.RULES) for i, u in enumerate(urls)}
    assert [v for _, v in got.values()] == ["block", "block", "allow", "allow"]  # the last by example.net/en/


def test_shapes_against_brute_force(spark):
    r = random.Random(5)
    hosts, parts = ["a", "b.a", "c.b.a", "a.b", "d..a", "a."], ["", "/", "/p", "/p/", "/p/q", "/p/q/", "/p//", "/p\nq/r/"]
    rules = sorted({(r.choice(["block", "allow"]), r.choice(hosts), r.choice(parts)) for _ in range(25)})
    urls = [f"s://{r.choice(['', 'x.', 'x.y.', '.'])}{r.choice(hosts)}{r.choice(parts)}{r.choice(['', 'z', '/z', '?u=/p/', '#/'])}" for _ in range(300)]
    assert run(spark, urls, rules) == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_empty_tables_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], RULE)
    assert [tuple(x) for x in url_filter.filter_urls(pages, none).orderBy("page_id").collect()] == [
        (None, "", "", None, "allow"), (1, "a.net", "/", None, "allow"), (1, "a.net", "/", None, "allow")]
    odd = spark.createDataFrame([("block", None, "/"), ("block", "net", None)], RULE)
    assert {x.rule for x in url_filter.filter_urls(pages.where("page_id = 1"), odd).collect()} == {"net"}
    assert url_filter.op2_url_filter(pages.limit(0)).collect() == []
