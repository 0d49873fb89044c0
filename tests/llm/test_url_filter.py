"""URL verdicts against rules tried one by one."""

import pytest

from tidemark.llm import url_filter

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("Example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
    ("b.example.org", "/fr/x", "block"),  # a path that ends inside a name
    ("example.org", "/fr/x/y", "allow"),
    ("same.io", "/a", "allow"),
    ("same.io", "/a", "block"),
    ("bare.io", None, "block"),
    ("", "/", "block"),
    (None, "/", "block"),
]
URLS = [
    None, "", "no scheme", "http://", "http:///path", "http://net", "http://net/", "HTTP://A.NET/x?y#z",
    "http://xnet/", "http://example.net/en/1", "http://example.net/en", "http://www.example.net/en/?q=://x",
    "https://example.com/de/1", "https://example.com/en/de/", "https://notexample.com/de/", "http://a.org/fr/x",
    "http://b.example.org/fr/x", "http://a.b.example.org/fr/xyz", "http://a.b.example.org/fr/x/y",
    "http://same.io/abc", "http://bare.io", "http://bare.io?x", "http://net:80/", "http://a.net./", "http://é.NET/Ü",
    "http://" + "a." * 20_000 + "net/" + "b/" * 20_000, "http://a\n.net/\n", "x http://a.net/ y://b.org/fr/",
]


def slow(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([at for at in map(rest.find, "/?#") if at >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = (0, 0, 0, None, "allow")
    for rule_host, rule_path, verdict in RULES:
        rule_host, rule_path = (rule_host or "").lower(), rule_path or ""
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            text = rule_host + rule_path
            best = max(best, (len(text), len(rule_path), verdict == "block", text, verdict))
    return host, path, *best[3:]


@pytest.mark.parametrize("most_broadcast", [0, 1000])
def test_verdicts(spark, most_broadcast):
    rules = spark.createDataFrame(RULES, url_filter.RULES)
    rows = [(n if n % 5 else None, url, "h", "p", n) for n, url in enumerate(URLS)] * 2
    table = spark.createDataFrame(rows, "page_id long, url string, host string, path string, row int")
    got = url_filter.judge(table, rules, most_broadcast=most_broadcast).collect()
    want = [(n if n % 5 else None, *slow(url)) for n, url in enumerate(URLS)] * 2
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_rules_and_no_rows(spark):
    rules = spark.createDataFrame(RULES, url_filter.RULES)
    table = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge(table.where("false"), rules).count() == 0
    [row] = url_filter.judge(table, rules.where("false"), otherwise="block").collect()
    assert tuple(row) == (1, "a.net", "/", None, "block")
