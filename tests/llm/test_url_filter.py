import re

import pytest

from tallyflow.llm import url_filter
from tallyflow.llm.url_filter import RULES, filter_urls

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/1", "http://a.example.com/en/", "https://example.com/en",
    "https://example.com?x=://b.net/fr/", "http://x.net/es/1#a", "http://x.net/ES/1", "http://net/fr/?q", "http://notnet.org/fr/", "http://xnet/fr/1", "http://com", "http://com/",
    "http://ÄX.com/ä/b", "http://user@h.org:80/a/b//c/d/e/f/g/h/", "ftp://a://b/c", "x\n://h.org/p\nq?r", "http://x.net/fr", "http://" + "y" * 5000 + ".org/" + "z/" * 3000,
]


def brute(url):
    rest = (url or "").partition("://")
    if not rest[1]:
        return "", "", None, None
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest[2]).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for domain, prefix, verdict in RULES:
        if (host == domain or host.endswith("." + domain)) and path.startswith(prefix) and (best is None or len(domain + prefix) > len(best[0])):
            best = domain + prefix, verdict
    return host, path, *(best or (None, None))


def pages(spark, urls):
    return spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS template", "2 AS _urls")


def test_rules(spark):
    rows = [*enumerate(URLS), (None, URLS[5]), (5, URLS[5])]
    got = filter_urls(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        host, path, rule, verdict = brute(by_id[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_variable_segments_become_wildcards_and_bad_branches_go(spark):
    urls = [(i, f"http://shop.org/{'spam' if i % 2 else 'item'}/{i}.html") for i in range(60)]
    urls += [(100 + i, "http://shop.org/about") for i in range(5)]
    table = pages(spark, urls)
    labels = spark.createDataFrame(
        [("shop.org", f"/{'spam' if i % 2 else 'item'}/{i}.html", 1, i % 2) for i in range(40)], "host string, path string, labelled long, bad long"
    )
    got = {r.page_id: r for r in filter_urls(table, rules=(), labels=labels).collect()}
    assert got[1].template == "/spam/*.html" and got[0].template == "/item/*.html" and got[100].template == "/about"
    assert all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(60)) and got[100].verdict == "allow"


def test_frequent_children_stay_below_a_varying_node(spark):
    urls = [(i, f"http://h.org/u/{i}") for i in range(40)] + [(100 + i, "http://h.org/u/login") for i in range(20)]
    got = {r.page_id: r.template for r in filter_urls(pages(spark, urls), rules=()).collect()}
    assert got[0] == "/u/*" and got[100] == "/u/login"


def test_similar_branches_are_pooled(spark):
    rows = [("h", f"/{a}/*", 3, 3) for a in ("aa", "bb", "cc", "dd")] + [("h", "/zz/*", 30, 0), ("h", "/new/*", 0, 0)]
    leaves = spark.createDataFrame(rows, "host string, template string, labelled long, bad long")
    got = {r.template: r for r in url_filter.pools(leaves).collect()}
    prior = 12 / 42
    assert got["/aa/*"].purity == got["/dd/*"].purity == pytest.approx((12 + 4 * prior) / 16) and got["/aa/*"].rejected
    assert not got["/zz/*"].rejected and got["/new/*"].purity == pytest.approx(prior) and not got["/new/*"].rejected


def test_no_rows(spark):
    assert filter_urls(pages(spark, [])).count() == 0
