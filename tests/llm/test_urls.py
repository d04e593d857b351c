from __future__ import annotations

import re

import pytest
from fieldmill.llm import urls

CASES = [
    ("https://Blog.Example.NET/en/25#top", "blog.example.net", "/en/25", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://a.net?x=/y", "a.net", "", None, "allow"),
    ("//a.net/", "", "", None, "allow"),
    ("http://x.example.com/de/1?q", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("http://x.org/fr/cheap-pills", "x.org", "/fr/cheap-pills", "org/fr/", "allow"),
    ("https://www.cheap-pills.example.com/en/4", "www.cheap-pills.example.com", "/en/4", None, "block"),
    ("https://Spam-Farm.example.org/en/7?u=1", "spam-farm.example.org", "/en/7", None, "block"),
    ("https://a.example.org/spam/farm", "a.example.org", "/spam/farm", None, "allow"),
    ("https://xxx.example.org/", "xxx.example.org", "/", None, "block"),
    ("http://ÄÖ.net/é#/x", "ÄÖ.net", "/é", "net/", "block"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_parts_rules_and_verdicts(spark):
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)] + [(None, CASES[0][0], "x")], "page_id long, url string, host string")
    rows = urls.judge_urls(pages, ["page_id", "host"]).collect()
    assert len(rows) == len(CASES) + 1
    for r in rows:
        if r["doc"]["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == CASES[r["doc"]["page_id"]][1:], r
    assert urls.judge_urls(pages.limit(0), ["page_id"]).count() == 0


def test_the_index_finds_what_all_patterns_find(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in urls.judge_urls(pages, ["page_id", "url"]).collect():
        expected = [rule.name for rule in urls.PATTERN_RULES if re.search(rule.pattern, r["doc"]["url"])]
        assert sorted(r["patterns"]) == sorted(expected)


def test_rules_lie_under_their_rarest_token(spark):
    pages = spark.createDataFrame([("http://spam.a/",), ("http://spam.b/farm",), ("http://c/cheap",)], "url string")
    index = urls.token_index(pages, urls.PATTERN_RULES)
    assert "spam farm" in [r.name for r in index["farm"]] and "pills" in [r.name for r in index["pills"]]
    assert "" not in index and all(rule.tokens or rule.one_of for rule in urls.PATTERN_RULES)
    assert urls.token_index(pages, (urls.PatternRule("any", "a", ()),)) == {"": [urls.PatternRule("any", "a", ())]}
    with pytest.raises(ValueError, match="pattern rules"):
        urls.token_index(pages, urls.PATTERN_RULES * 2000)


SPELLINGS = {
    "pills": ["http://cheap-pills.a/", "http://x.cheap.pills.a/"],
    "pharmacy": [f"http://{place}" for w in ("online", "Cheap") for s in ("-", ".", "") for place in (f"{w}{s}pharmacy.a/", f"a.b/{w}{s}PHARMACY?x")],
    "spam farm": ["http://spam-farm.a/", "http://b.spam.farm/"],
    "casino": ["http://casino.a/", "http://my-casino.a/"],
    "poker": ["http://a.b/poker-x", "http://poker.a/", "http://a.b/poker/"],
    "adult": ["http://xxx.a/", "http://a.porn/"],
    "malware": [f"http://a.b/malware{s}{w}" for s in "-." for w in ("download", "host")],
    "warez": ["http://a.b/warez"],
    "tracker": [f"http://a.b/{s}{'0f' * 8}" for s in ("?click_id=", "?a&clickid=")],
    "session link": [f"http://a.b/x{s}jsessionid={'0f' * 4}" for s in "?&;"],
}


def test_the_index_finds_every_spelling(spark):
    both = "http://cheappharmacy.a/online-pharmacy/onlinepharmacy"
    cases = [(name, url) for name, found in SPELLINGS.items() for url in found] + [("pharmacy", both)]
    assert {*SPELLINGS} == {rule.name for rule in urls.PATTERN_RULES}
    for r in urls.judge_urls(spark.createDataFrame(cases, "name string, url string"), ["name", "url"]).collect():
        assert r["patterns"] == [r["doc"]["name"]] and r["verdict"] == "block", r
