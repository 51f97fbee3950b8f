"""URL filters against plain string rules and regular expressions."""

import re

import pytest
from pyspark.sql import functions as F

from tallybeat.llm import twins, urls
from tallybeat.llm.urls import Glob, Rule

SCHEMA = "page_id long, url string, host string, path string, canonical string, rule int"
ODD = [
    "http://blog.example.net/en/1?q=/x#y",
    "http://example.net/en/",
    "http://example.net/en",
    "http://EXAMPLE.NET/EN/",
    "http://notexample.net/en/2",
    "https://a.example.com/de/",
    "https://a.example.com/de",
    "https://org/fr/9",
    "https://x.org/de?y=://z.net/",
    "http://net",
    "http://net/",
    "http://.net/",
    "http://kinet/",
    "http://foo.com/a.example.net/en/b",
    "http://foo.com#x.net/",
    "http://www.big-casino.com",
    "http://www.big-casino.com/a/b",
    "http://foo.com/big-casino/",
    "ftp://foo.de/a/b/login",
    "ftp://foo.de/login",
    "ftp://foo.de/café/x.zip",
    "http://fooÄ.net/Ä/",
    "http://u:p@foo.net:80/",
    "no scheme.net/",
    "://",
    "",
    " ",
    None,
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_verdict(host, path, rules=urls.RULES, globs=urls.GLOBS, default=urls.ALLOW):
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fits:
        best = max(fits, key=lambda r: (len(r.name), len(r.host)))
        return best.name, None, best.verdict
    hits = [g for g in globs if re.fullmatch(twins._as_regex(g.pattern), f".{host}{path}")]
    if hits:
        best = max(hits, key=lambda g: len(g.pattern))
        return None, best.pattern, best.verdict
    return None, None, default


def check(spark, given, **options):
    rows = [(i % 7 or None, u, "clash", "clash", "clash", 1) for i, u in enumerate(given)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = urls.judge(pages, **options)
    assert found.columns == ["page_id", "host", "path", "rule", "glob", "verdict"]
    wanted = []
    for i, url in enumerate(given):
        host, path = plain_parts(url)
        plain = {k: v for k, v in options.items() if k != "cells"}
        wanted.append((i % 7 or None, host, path, *plain_verdict(host, path, **plain)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    return found


def test_odd_urls(spark):
    found = check(spark, ODD + ODD)
    assert found.filter((F.col("rule") == "net/") & (F.col("host") == "net")).count() > 0


def test_no_rows_and_no_rules(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert urls.judge(pages).count() == 0
    check(spark, ODD, rules=(), globs=())
    check(spark, ODD, rules=(), globs=(), default=urls.BLOCK)


def test_patterns_over_many_words(spark):
    """Hundreds of patterns of odd lengths, so that many cross the borders of words."""
    rules = [Rule(f"h{i}.com", "/" + "p" * (i % 13), (urls.BLOCK, urls.ALLOW)[i % 2]) for i in range(120)]
    globs = [Glob(f"*.site{i}?.*/**/x{i % 5}*" + "y" * (i % 7), (urls.ALLOW, urls.BLOCK)[i % 2]) for i in range(90)]
    globs += [Glob(r"*.star\*.de/\?\\", urls.BLOCK), Glob("*.日?.jp/*/end", urls.BLOCK), Glob("**", urls.BLOCK)]
    given = [f"http://w{i}.h{i}.com/{'p' * (i % 17)}" for i in range(0, 140, 3)]
    given += [f"http://a.site{i}é.com/q/r/x{i % 5}zz{'y' * (i % 8)}" for i in range(0, 95, 2)]
    given += ["http://star*.de/?\\", "http://日本.jp/a/end", "http://日本語.jp/a/end", "http://日本.jp/a/b/end"]
    check(spark, given + ODD, rules=rules, globs=globs, cells=64)


@pytest.mark.parametrize("size", [100_000])
def test_very_long_urls(spark, size):
    check(spark, ["http://foo.net/" + "a/" * size, "http://foo.com/" + "a" * size + "/login", "x" * size, *ODD])
