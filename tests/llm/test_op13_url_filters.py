"""Operator 13 against SQL, and against a plain walk over aliases."""

from __future__ import annotations

import random

import pytest

from compare import connect, difference

from roadbook.llm import url_filters
from roadbook.llm.queries import ORACLE_SQL, QUERIES, URL_RULES
from roadbook.llm.url_filters import Rule, judge, named_urls

from .conftest import TINY


def test_query_equals_sql(spark):
    assert difference(QUERIES["op13_url_filters"](spark, TINY), connect(TINY), ORACLE_SQL["op13_url_filters"]) is None


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", "", None
    scheme, rest = url.split("://", 1)
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    tail = tail.split("#")[0]
    host, scheme = host.translate(LOWER), scheme.translate(LOWER)
    return host, tail.split("?")[0], f"{scheme}://{host}{tail}"


def own_rule(url, rules):
    host, path, _ = split(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), r.verdict == "allow", r.host + r.path), default=None)


def plain(pages, rules, redirects=()):
    links: dict = {}
    for a, b in [(u, t) for _, u, h in pages if u and "://" in u for t in named_urls(u, h or "")] + list(redirects):
        a, b = split(a)[2], split(b)[2]
        if a and b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    bad, todo = set(), [n for n in links if (r := own_rule(n, rules)) and r.verdict == "block"]
    while todo:
        if (n := todo.pop()) not in bad:
            bad.add(n)
            todo += links[n]
    out = []
    for page, url, _ in pages:
        host, path, node = split(url)
        rule = own_rule(url, rules)
        out.append((page, host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if node in bad else "allow"))
    return sorted(out, key=str)


def ours(spark, pages, rules, redirects=None):
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, node string")
    sent = redirects and spark.createDataFrame(redirects, "a string, b string")
    found = judge(df, rules, sent)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, found.collect()), key=str)


def canonical(url):
    return f'<html><head><link rel="canonical" href="{url}"></head><p>text</p></html>'


def refresh(url):
    return f"<meta http-equiv=refresh content='0; url={url}'>"


def test_blocks_reach_aliases_and_allow_has_precedence(spark):
    pages = [
        (1, "http://a.example.org/en/1", canonical("http://bad.net/x")),       # names a blocked url that is no page
        (2, "http://b.example.org/en/2", refresh("http://a.example.org/en/1#part")),  # two steps away
        (3, "http://c.example.org/fr/3", canonical("http://bad.net/x")),       # an allowing rule of its own
        (4, "http://d.example.org/en/4", canonical("http://c.example.org/fr/3")),  # through the allowed one
        (5, "http://e.example.org/en/5", canonical("http://e.example.org/en/5")),  # only itself
        (6, "HTTP://B.example.org/en/2", None),                                # the same url, fetched again
        (7, "https://b.example.org/en/2", None),                               # another scheme is another url
        (8, "http://www.example.net/en/8", None), (9, "http://www.example.net/de/8", None),
        (10, "http://example.com/de/8?x=/en/", None), (11, "http://net", None), (12, "http://xnet/", None), (13, "http://x.net/", None),
    ]
    got = ours(spark, pages, URL_RULES)
    assert got == plain(pages, URL_RULES)
    assert {r[0]: (r[3], r[4]) for r in got} == {
        1: (None, "block"), 2: (None, "block"), 3: ("org/fr/", "allow"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "block"),
        7: (None, "allow"), 8: ("example.net/en/", "allow"), 9: ("net/", "block"), 10: ("example.com/de/", "block"),
        11: (None, "allow"), 12: (None, "allow"), 13: ("net/", "block")}


def test_chains_hubs_and_redirects(spark):
    rng = random.Random(4)
    url = lambda i: f"http://h{i % 5}.example.{'net' if i % 97 == 3 else 'org'}/p{i}"
    pages = [(i, url(i), canonical(url(i + 1 if i % 8 else 1000 + i // 40)) if i % 7 else None) for i in range(200)]
    redirects = [(url(rng.randrange(300)), url(rng.randrange(300))) for _ in range(9)] + [(None, url(1)), ("x", url(2)), (url(5), url(5))]
    got = ours(spark, pages, URL_RULES, redirects)
    assert got == plain(pages, URL_RULES, redirects) and {r[4] for r in got} == {"allow", "block"}


def test_strange_pages(spark):
    pages = [(1, None, canonical("http://bad.net/")), (2, "", "x"), (3, "no scheme.net/", canonical("http://bad.net/")), (4, "://", ""),
             (5, "http://", None), (6, "http://A.Net/a b?c#d", "<p>"), (6, "http://A.Net/a b?c#d", "<p>"), (None, "ftp://É.Net/é", None),
             (7, "http://x.org/" + "long/" * 5000, canonical("http://bad.net/")), (8, "http://q?canonical/#", "<link rel=canonical href='//bad.net/'>")]
    assert ours(spark, pages, URL_RULES) == plain(pages, URL_RULES)


def test_rules(spark):
    rules = [Rule("block", "a.b"), Rule("allow", "b", "/xx"), Rule("block", "b", "/xx"), Rule("block", "b", "/x"), Rule("allow", "b", ""),
             Rule("allow", "b", "/xx")]
    pages = [(i, f"http://{h}{p}", None) for i, (h, p) in enumerate([("b", ""), ("a.b", ""), ("a.b", "/"), ("z.a.b", "/xx1"), ("b", "/x"),
                                                                    ("..b", "/"), ("b.", "/"), ("b:80", "/"), ("ab", "/")])]
    assert ours(spark, pages, rules) == plain(pages, rules)
    assert {r[4] for r in ours(spark, pages, [])} == {"allow"}
    for wrong in (("maybe", "a"), ("block", ""), ("block", "A.b")):
        with pytest.raises(ValueError):
            Rule(*wrong)


def test_empty_table(spark):
    assert ours(spark, [], URL_RULES) == []


@pytest.mark.parametrize("html,expected", [
    ('<LINK HREF="/a/b" data-x REL="nofollow Canonical"/>', ["http://h/a/b"]),
    ("<link rel=canonical href=../up?x=1&amp;y=2>", ["http://h/up?x=1&y=2"]),
    ('<base href="http://other/d/"><base href="http://third/"><link href="e" rel="canonical">', ["http://other/d/e"]),
    ('<!-- <link rel="canonical" href="/c"> --><script>"<link rel=canonical href=/s>"</script><title><link rel=canonical href=/t></title>', []),
    ('<!-- open <link rel="canonical" href="/c">', []),
    ('<meta http-equiv="Refresh" content="5;URL=\'http://x/y\'"><meta http-equiv=refresh content=30>', ["http://x/y"]),
    ('<meta content="0, /z" http-equiv="refresh">', ["http://h/z"]),
    ('<link rel="canonical" href="">' + '<link rel="canonical">' + '<link rel="stylesheet" href="/canonical.css">', []),
    ('<link rel="canonical" href="http://[bad">' + '<link rel="canonical" href="mailto:a@b">', []),
    ('<link rel="canonical" title="a > b" href="/q"><linkrel rel=canonical href=/n>', ["http://h/q"]),
    ('<link rel="canonical" href="/cut', []),
])
def test_named_urls(html, expected):
    assert named_urls("http://h/p/q", html) == expected


def test_edges_leave_out_loops_and_repeats(spark):
    pages = spark.createDataFrame([("http://A/x#1", canonical("http://a/x")), ("http://a/y", canonical("/x")), ("http://a/y", canonical("/x"))],
                                  "url string, html string")
    assert [tuple(r) for r in url_filters.alias_edges(pages).collect()] == [("http://a/y", "http://a/x")]
