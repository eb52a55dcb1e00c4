import itertools
import time

import pytest
from hypothesis import given, settings, strategies as st

from palate.llm import url_filters as uf

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de"), ("allow", "org/fr/"),
         ("allow", "a.example.com"), ("block", "org/fr/x/"), ("allow", "example.net/en/sec"), ("block", "org/fr/")]
URLS = [None, "", "no scheme", "http://", "http://NET", "http://net/", "https://x.net/a?b=http://y.org/fr/", "http://example.net/en/1",
        "http://example.net/en", "http://sub.EXAMPLE.net/en/section#x", "http://example.com/den", "http://a.example.com?x",
        "http://b.a.example.com/de/1", "http://notexample.com/de/", "http://q.org/fr/x/y", "http://q.org/fr/y", "http://.net/",
        "http://example.com:80/de/", "http://org/FR/", "http://u.net\n/en/"] + [
    f"http://{h}{p}" for h, p in itertools.product(["example.net", "z.org", "com"], ["", "/", "/en/", "/fr/x/1", "/de"])]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    fits = []
    for verdict, rule in RULES:
        rule_host, rule_path = uf.split_rule(rule)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((len(rule), rule_host.count("."), rule, verdict))
    best = max(fits, default=None)
    return (host, path, *(best[2:] if best else (None, "allow")))


@pytest.mark.parametrize("max_chars", [1 << 20, 0])
def test_trie_and_join_against_brute_force(spark, max_chars):
    pages = spark.createDataFrame([(u, "x") for u in URLS], "url string, VERDICT string")
    for row in uf.judge_urls(pages, RULES, max_chars=max_chars).collect():
        assert (row.host, row.path, row.rule, row.verdict) == expected(row.url), row.url


@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.text("ab/.", max_size=9)), max_size=14), st.text("ab/.", max_size=12))
@settings(max_examples=300, deadline=None)
def test_the_trie_against_all_rules(rules, address):
    host, slash, path = address.partition("/")
    path = slash + path
    fits = []
    for verdict, rule in rules:
        rule_host, rule_path = uf.split_rule(rule)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((len(rule), rule_host.count("."), verdict == "block", rule, verdict))
    found = uf.Trie(rules).find(host, path)
    assert (found and found[0]) == (max(fits)[3] if fits else None)
    assert (found and found[1]) == (max(fits)[4] if fits else None)


def test_openings_that_nest():
    starts = uf.Starts({s: (s,) for s in ["a", "ab", "abc", "abcz", "ac", "b", "abd"]})
    found = {s: starts.longest(s) for s in ["abcy", "abc", "abx", "a", "", "c", "abczz", "abe", "ad", "bb"]}
    assert {s: f and f[0] for s, f in found.items()} == {
        "abcy": "abc", "abc": "abc", "abx": "ab", "a": "a", "": None, "c": None, "abczz": "abcz", "abe": "ab", "ad": "a", "bb": "b"}


def test_many_open_rules_on_one_host_cost_a_search_by_halves():
    rules = [("block", f"example.com/p{i}") for i in range(50_000)] + [("allow", "example.com/p")]
    trie, urls = uf.Trie(rules), [f"/p{i * 7}/x" for i in range(2000)] + ["/pq", "/q"] * 1000
    began = time.perf_counter()
    found = [trie.find("www.example.com", u) for u in urls]
    assert (time.perf_counter() - began) / len(urls) < 50e-6
    assert found[5] == ("example.com/p35", "block") and found[-2] == ("example.com/p", "allow") and found[-1] is None


def test_long_urls_and_repeated_rows(spark):
    long = "http://" + "sub." * 5000 + "example.com/de" + "/seg" * 20_000
    pages = spark.createDataFrame([(long,)] * 3 + [("http://net/",)] * 2, "url string")
    for max_chars in (1 << 20, 0):
        rows = uf.judge_urls(pages, RULES, max_chars=max_chars).collect()
        assert [(r.rule, r.verdict) for r in sorted(rows, key=lambda r: r.rule)] == [("example.com/de", "block")] * 3 + [("net/", "block")] * 2


def test_a_hot_address_is_split(spark):
    """A third of the rows are null, another third one URL; the join with the long list is cut there."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        urls = [None] * 4000 + ["http://example.com/de/1"] * 4000 + [f"http://h{i}.org/fr/x" for i in range(4000)]
        pages = spark.createDataFrame([(u,) for u in urls], "url string").repartition(16)
        judged = uf.judge_urls(pages, RULES, max_chars=0)
        assert judged.filter("verdict = 'block'").count() == 8000
        judged.collect()
        assert "skew=true" in judged._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_empty_rules_and_pages(spark):
    pages = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert {r.verdict for r in uf.judge_urls(pages, []).collect()} == {"allow"}
    assert uf.judge_urls(pages.limit(0), RULES).count() == 0
