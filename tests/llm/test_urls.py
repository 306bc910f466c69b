"""The URL filter against rules by hand and shrinkage by plain arithmetic."""

import math
import re

import pytest

from tokenlake.llm import url_filter
from tokenlake.llm.url_filter import RULES, UrlRule, filter_urls, host_reputation

URLS = {
    "http://A.Example.ORG/es/1?x#y": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "https://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
    "https://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
    "x://www.example.org/en/17": ("www.example.org", "/en/17", "example.org/en/1", "block"),
    "x://www.example.org/en/2": ("www.example.org", "/en/2", "org/", "allow"),
    "x://example.org/ES/": ("example.org", "/ES/", "org/", "allow"),
    "http://shop.com/fr/a": ("shop.com", "/fr/a", "com/fr/", "allow"),
    "http://shop.com/de/a": ("shop.com", "/de/a", "com/de/", "block"),
    "http://shop.com/de": ("shop.com", "/de", None, None),
    "http://telecom/de/": ("telecom", "/de/", None, None),
    "http://com/de/": ("com", "/de/", "com/de/", "block"),
    "http://org": ("org", "", None, None),
    "http://x.org?q=/": ("x.org", "", None, None),
    "http://x.net#a/b": ("x.net", "", None, None),
    "a://b://c.org/d": ("b:", "//c.org/d", None, None),
    "no scheme example.org/es/": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "http://ÄB.example.net/ü": ("Äb.example.net", "/ü", None, None),
    "http:// x.net /a\nb?c": (" x.net ", "/a\nb", None, None),
}
SCHEMA = "page_id long, url string, host string, n string, bound string, verdict string"
LABELS = "page_id long, good int"


def test_hosts_paths_and_rules(spark):
    pages = [(i, u, "x", "y", "z", "w") for i, u in enumerate(URLS)]
    rows = filter_urls(spark.createDataFrame(pages, SCHEMA), spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == len(URLS)
    for row, url in ((r, pages[r["page_id"]][1]) for r in rows):
        host, path, rule, verdict = URLS[url]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), url
        assert row["verdict"] == (verdict or ("allow" if row["bound"] >= url_filter.LEAST_GOOD else "block"))


def test_the_longest_rule_wins_whatever_the_order(spark):
    rules = [UrlRule("block", "a.org", "/"), UrlRule("allow", "x.a.org", "/"), UrlRule("block", "org", "/long/path")]
    page = spark.createDataFrame([(1, "u://x.a.org/long/path")], "page_id long, url string")
    none = spark.createDataFrame([], LABELS)
    for order in (rules, rules[::-1]):
        assert filter_urls(page, none, order).first()["rule"] == "org/long/path"


def names(host):
    bare = re.sub(":[0-9]*$", "", host)
    if re.match(url_filter.ADDRESS, bare):
        return bare, bare
    labels = bare.split(".")
    n = 2 if ".".join(labels[-2:]) in url_filter.TWO_LABEL_SUFFIXES else 1
    return ".".join(labels[-n - 1 :]), ".".join(labels[-n:])


def shrink(groups):
    """{name: (n, k, mu)} -> ({name: mean}, strength)"""
    excess = sum((k - n * mu) ** 2 - n * mu * (1 - mu) for n, k, mu in groups.values())
    pairs = sum(n * (n - 1) * mu * (1 - mu) for n, k, mu in groups.values())
    rho = excess / pairs if pairs else url_filter.UNKNOWN_CORRELATION
    rho = min(max(rho, url_filter.CORRELATION[0]), url_filter.CORRELATION[1])
    s = (1 - rho) / rho
    return {g: (s * mu + k) / (s + n) for g, (n, k, mu) in groups.items()}, s


def plain_bounds(hosts):
    def summed(key):
        out = {}
        for host, (n, k) in hosts.items():
            had = out.get(key(host), (0, 0))
            out[key(host)] = (had[0] + n, had[1] + k)
        return out

    total = summed(lambda h: "")[""]
    overall = (total[1] + 1) / (total[0] + 2)
    suffixes, _ = shrink({g: (*v, overall) for g, v in summed(lambda h: names(h)[1]).items()})
    above = {names(h)[0]: suffixes[names(h)[1]] for h in hosts}
    domains, _ = shrink({g: (*v, above[g]) for g, v in summed(lambda h: names(h)[0]).items()})
    means, s = shrink({h: (*v, domains[names(h)[0]]) for h, v in hosts.items()})
    return {h: m - url_filter.DEVIATIONS * math.sqrt(m * (1 - m) / (s + hosts[h][0] + 1)) for h, m in means.items()}


HOSTS = {
    "good.example.net": (400, 396),
    "bad.example.net": (50, 3),
    "new.example.net": (0, 0),
    "one.example.net": (1, 0),
    "a.shop.co.uk": (20, 19),
    "b.shop.co.uk:8080": (5, 5),
    "shop.co.uk": (0, 0),
    "co.uk": (0, 0),
    "10.0.0.1": (9, 1),
    "10.0.0.1:80": (2, 0),
    "[::1]": (0, 0),
    "localhost": (3, 3),
    "": (4, 2),
}


def test_bounds_as_by_plain_arithmetic(spark):
    df = spark.createDataFrame([(h, *v) for h, v in HOSTS.items()], "host string, n long, k long")
    got = {r["host"]: r["bound"] for r in host_reputation(df).collect()}
    want = plain_bounds(HOSTS)
    assert got == pytest.approx(want)
    # Few labels stay near the parent, many speak for themselves.
    assert got["good.example.net"] > 0.9 > got["new.example.net"] > got["one.example.net"] > got["bad.example.net"]


def test_verdicts_follow_the_outcomes_of_the_host(spark):
    pages = [(i, "http://fine.net/a") for i in range(300)] + [(1000 + i, "http://spam.net/b") for i in range(60)]
    pages += [(None, "http://fine.net/none"), (7, "http://fine.net/a"), (5000, "http://spam.net/b"), (6000, None)]
    labels = [(i, 1) for i in range(250)] + [(1000 + i, 0) for i in range(50)] + [(3, None), (None, 0), (9999, 0), (4, 1)]
    rows = filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len(pages)
    assert {r["verdict"] for r in rows if r["host"] == "fine.net"} == {"allow"}
    assert {r["verdict"] for r in rows if r["host"] == "spam.net"} == {"block"}
    # The repeated page takes part twice, the page with two labels counts both.
    want = plain_bounds({"fine.net": (252, 252), "spam.net": (50, 0), "": (0, 0)})
    assert {r["host"]: r["bound"] for r in rows} == pytest.approx(want)


def test_no_pages_and_a_long_url(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1)], LABELS)
    assert filter_urls(none, labels).count() == 0
    long = spark.createDataFrame([(1, "http://" + "a" * 500_000 + ".org/" + "b" * 500_000)], "page_id long, url string")
    row = filter_urls(long, labels).first()
    assert len(row["host"]) == 500_004 and len(row["path"]) == 500_001 and row["rule"] == "org/"


def test_the_rules_of_the_registered_query():
    assert [r.text for r in RULES] == ["org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/"]
