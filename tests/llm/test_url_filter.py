"""URL rules against a scan of all rules, collisions included."""

import random

import pytest
from pyspark.sql import functions as F

from vaultmart.llm import url_filter
from vaultmart.llm.queries import URL_RULES, op12_url_filter

SCHEMA = "page_id long, url string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]


def brute(pages, rules):
    out = []
    for page, url in pages:
        host, path = parts(url)
        best = None
        for h, p, action in rules:
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best or (0, 0, "", ""), (len(h + p), len(h), action, h + p))
        out.append((page, host, path, best and best[3], best[2] if best else "allow"))
    return sorted(out, key=repr)


def judged(spark, pages, rules, schema=SCHEMA, **options):
    made = spark.createDataFrame(rules, "host string, path string, action string")
    index = url_filter.write_rules(spark, made, **options)
    return sorted((tuple(r) for r in url_filter.judge(spark.createDataFrame(pages, schema), index).collect()), key=repr)


URLS = ["http://example.org/es/1", "https://EXAMPLE.org/en/17?x", "http://a.example.org/en/2", "http://org/", "http://org", "http://notexample.org/es/",
        "ftp://x.com/de/", "ftp://com/fr/#a", "http://x.com/d", None, "", "no scheme", "://", "http://", "http://?x=http://org/es", "http://ÄB.Org/é?",
        "a://b.c://example.org/es/", "http://org./", "http://.org/", "http://..com/fr/", "http://example.org\n/es/", "http://user@example.org:80/es/",
        "http://" + "a." * 20000 + "example.org/es/" + "x" * 50000, "http://example.org/" + "es/" * 30000]


def test_contract_rules_and_odd_urls(spark):
    pages = [(k, u) for k, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[0])]
    assert judged(spark, pages, URL_RULES) == brute(pages, URL_RULES)


@pytest.mark.parametrize("seed,part", [(1, 7), (2, 1 << 20), (3, 1)])
def test_random_rules_in_files_of_any_size(spark, seed, part):
    rng = random.Random(seed)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["", "/", "/x", "/y", "xy"]) for _ in range(rng.randint(0, 4)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), "/" + path() if rng.random() < .9 else "") for _ in range(200))}.values())
    pages = [(k, f"http://{host()}{path()}") for k in range(400)]
    assert judged(spark, pages, rules, part_entries=part) == brute(pages, rules)


def test_collisions_are_told_apart(spark, monkeypatch):
    """Equal digests, in one file and across the search: only the full string decides."""
    from vaultmart.llm import queries

    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    same = url_filter._entries(rules).withColumn("key", F.lit(99).cast("long"))
    monkeypatch.setattr(url_filter, "_entries", lambda r: same)
    index = url_filter.write_rules(spark, rules, part_entries=2)
    assert len(index["files"]) == 1
    monkeypatch.setattr(url_filter, "digest", lambda s: 99)
    from pyspark import SparkFiles
    url_filter._part.cache_clear()
    part = url_filter.RulePart(SparkFiles.get(index["files"][0]))
    for h, p, action in queries.URL_RULES:
        assert part.confirm(0, 99, h + p, False)[0] == (url_filter.BLOCK if action == "block" else url_filter.ALLOW)
    assert part.confirm(0, 99, "example.org/", False) is None and part.confirm(0, 99, "example.org", True)[1] == "4,5"


def test_given_twice_blocks_and_no_rules(spark):
    pages = [(1, "http://a/x"), (1, "http://a/x")]
    twice = [("a", "/", "allow"), ("a", "/", "block"), ("A", "/", "allow")]
    assert judged(spark, pages, twice) == [(1, "a", "/x", "a/", "block")] * 2
    assert judged(spark, pages, []) == [(1, "a", "/x", None, "allow")] * 2
    assert judged(spark, [], URL_RULES) == []


def test_digests_are_sparks_own(spark):
    for s in ("", "example.org/é", "x" * 1000):
        assert spark.range(1).select(F.xxhash64(F.lit(s))).first()[0] & 0xFFFFFFFFFFFFFFFF == url_filter.digest(s)


def test_query_with_clashing_columns(spark, tmp_path):
    pages = [(k, u) for k, u in enumerate(URLS)]
    df = spark.createDataFrame(pages, SCHEMA)
    for name in ("host", "path", "rule", "verdict", "v", "kind"):
        df = df.withColumn(name, F.lit("other"))
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = op12_url_filter(spark, str(tmp_path))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(pages, URL_RULES)
