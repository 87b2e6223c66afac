from __future__ import annotations

import re

import pytest
from helpers import by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from loadledger.llm import queries, url_filter

RULES = [url_filter.prefix_rule(h, p, v) for v, h, p in queries.PREFIX_RULES]


def brute(url):
    host, path = url_filter.split_url(url)
    best = None
    for verdict, h, p in queries.PREFIX_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    if best:
        return best
    for rule in url_filter.OWN_RULES:
        if re.match(rule.pattern, host + path, re.DOTALL):
            return None, rule.verdict
    return None, "allow"


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [(None, "", ""), ("", "", ""), ("www.a.com/x", "", ""), ("http://A.Com", "a.com", ""), ("x://H?q/z", "h", ""),
     ("http://É.net/fr/#a", "É.net", "/fr/"), ("a://b://c/d?e", "b:", "//c/d"), ("http:///en/", "", "/en/")],
)
def test_split(url, host, path):
    assert url_filter.split_url(url) == (host, path)


def test_table(spark):
    urls = ["http://www.example.com/en/1", "https://m.example.com/en/", "http://example.com/en", "http://x.com", "http://com/a",
            "http://notexample.com/en/x", "http://a.net/es/1", "http://net/fr/", "http://anet/fr/", "http://a.org/login/x",
            "http://ads.b.org/", "http://b.org/nologin/", None, "no scheme", "http://A.NET/FR/"]
    rows = [(n, u, "x", "y") for n, u in enumerate(urls)] + [(0, urls[0], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, token string, verdict string")
    judged = url_filter.judge_urls(pages, RULES)
    assert judged.count() == len(rows)
    found = by_id(judged, "page_id")
    assert {n: (found[n]["rule"], found[n]["verdict"]) for n in found} == {n: brute(u) for n, u in enumerate(urls)}
    assert url_filter.judge_urls(pages.limit(0), RULES).collect() == []


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from(["www", "example", "com", "net", "ads", "m", "a-b"]), min_size=1, max_size=4),
    st.lists(st.sampled_from(["en", "es", "fr", "login", "tracking", "x"]), max_size=3),
    st.sampled_from(["", "/", "?q=/es/", "#f"]),
)
def test_index_finds_what_running_every_rule_finds(labels, folders, tail):
    url = "http://" + ".".join(labels) + "".join(f"/{f}" for f in folders) + tail
    index = url_filter.RuleIndex(RULES, {"com": 9, "net": 5})
    own = url_filter.RuleIndex(url_filter.OWN_RULES, {})
    host, path = url_filter.split_url(url)
    name, verdict = index.judge(host, path)
    assert (name, verdict or own.judge(host, path)[1] or "allow") == brute(url)


def test_rules_are_filed_under_their_rarest_token():
    index = url_filter.RuleIndex(RULES, {"com": 9, "example": 7, "en": 1, "net": 5, "es": 8, "fr": 2, "www": 6})
    assert {t: [RULES[n].name for n in own] for t, own in index.by_token.items()} == {
        "com": ["com/"], "en": ["example.com/en/", "www.example.com/en/"], "net": ["net/es/"], "fr": ["net/fr/"]}
    assert index.always == []
    # a token that the rule's end could be part of is no token of the URL
    assert url_filter.prefix_rule("a.com", "/en", "block").literals == ("a", "com")


def test_very_many_rules_and_a_very_long_url(spark):
    rules = [url_filter.prefix_rule(f"site{n}.example.org", f"/part{n % 7}/", "block") for n in range(100_000)]
    urls = [f"https://www.site{n}.example.org/part{n % 7}/x" for n in range(0, 100_000, 997)]
    urls += [f"https://site5.example.org/part6/{'a/' * 200_000}", "https://site5.example.org/part5/" + "b" * 400_000, "no url"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    for n in range(0, 100_000, 997):
        assert found[n // 997]["rule"] == f"site{n}.example.org/part{n % 7}/"
    last = len(urls)
    assert [found[n]["rule"] for n in (last - 3, last - 2, last - 1)] == [None, "site5.example.org/part5/", None]
    index = url_filter.RuleIndex(rules, {"example": 10**6, "org": 10**6, **{f"part{n}": 10**4 for n in range(7)}})
    index.judge("site5.example.org", "/part5/")
    assert len(index.compiled) == 1  # of 100,000
