"""The sweep against every rule tried on every URL."""

import re

import pytest

from sheetloom.llm import url_rules

URLS = [
    (1, "http://example.net/en/1"), (2, "https://www.example.net/en/x?q#f"), (3, "https://EXAMPLE.net/fr/"), (4, "http://net/"), (5, "http://net"), (6, "http://notnet/x"),
    (7, "http://a.example.com/de/1"), (8, "http://example.com/de"), (9, "http://x.org/fr/1"), (10, None), (11, "no scheme"), (12, ""), (13, "http://"), (14, "http:///path"),
    (15, "x://y://net/en/"), (16, "http://example.net:80/en/"), (17, "http://.net/x"), (18, "http://a..net/"), (19, "http://EXAMPLE.NET?x=/en/"), (None, "http://b.net/q"),
    (20, "http://example.network/en/"), (21, "http://exämple.net/en/\U0001f600"), (1, "http://example.net/en/1"), (22, "http://h\n.net/en/"), (23, "ftp://org/fr/a#b"),
]
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("www.example.net/e", "block"), ("a.example.com/", "allow"), ("net/en/", "block"), (None, "block"), ("org/fr/", "allow")]


def brute(urls, rules, default="allow"):
    out = []
    for i, u in urls:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        best = None
        for rule, verdict in rules:
            if rule is None:
                continue
            h, p = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best or (0, 0, "", ""), (len(rule), len(h), rule, verdict))
        out.append((i, host, path, best[2] if best else None, best[3] if best else default))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("parts", ["1", "7"])
def test_rules(spark, rows, parts):
    urls = spark.createDataFrame(URLS, "page_id bigint, url string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = rows(url_rules.judge(urls, spark.createDataFrame(RULES, "rule string, verdict string")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(URLS, RULES)


def test_many_equal_urls_and_clashing_columns(spark, rows):
    many = [(i, "http://www.example.net/en/same", "k", 1) for i in range(500)] + [(500 + i, f"http://{i}.com/de/", None, None) for i in range(50)]
    urls = spark.createDataFrame(many, "page_id bigint, url string, key string, part int")
    assert rows(url_rules.judge(urls, spark.createDataFrame(RULES, "rule string, verdict string"))) == brute([m[:2] for m in many], RULES)


def test_empty_tables(spark):
    urls, rules = spark.createDataFrame(URLS, "page_id bigint, url string"), spark.createDataFrame(RULES, "rule string, verdict string")
    assert url_rules.judge(urls.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.judge(urls, rules.limit(0), default="block").collect()} == {"block"}
