import re

import pytest

from reviewmill.llm.queries import URL_RULES
from reviewmill.llm.url_rules import judge_urls

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), v, h + p)
        for h, p, v in rules
        if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/", "http://a.b.www.example.com/en/x/y?z#q",
    "http://example.com", "http://example.com?/en/", "http://example.com/en", "http://notexample.com/en/",
    "ftp://x.net/es/a", "x.net/es/", "http://x.net/fr/#a", "http:///en/", "://net/es/", "http://com/", "a://b://c/d",
    "http://x.net//es/", "http://net/es/", "http://example.com:80/en/", "http://ex\nample.com/en/", "", None,
    "http://" + "a." * 3000 + "example.com/" + "en/" * 3000,
]


@pytest.mark.parametrize(
    "rules",
    [
        URL_RULES,
        [],
        [("a.com", "/x/", "allow"), ("b.a.com", "/", "block"), ("a.com", "/x/", "block"), (None, "/", "block")],
    ],
)
def test_same_as_brute_force(spark, rows, rules):
    urls = [*URLS, "http://b.a.com/x/", "http://a.com/x/y", "http://b.a.com/", URLS[0]]
    pages = spark.createDataFrame([(i, u, "h", "old") for i, u in enumerate(urls)], "page_id long, url string, digest string, rule string")
    got = judge_urls(pages, spark.createDataFrame(rules, RULES))
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == sorted(
        [(i, *brute(u, rules)) for i, u in enumerate(urls)], key=repr
    )
    assert "digest" in got.columns


def test_no_pages_and_bad_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, spark.createDataFrame(URL_RULES, RULES)).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, spark.createDataFrame([("a.com", "/x", "block")], RULES))


def test_columns_called_like_ours(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x/", "p", "q")], "page_id long, url string, judged_url string, judged_won string")
    got = judge_urls(pages, spark.createDataFrame([("a.com", "/x/", "block")], RULES)).collect()
    assert [(r.judged_url, r.judged_won, r.verdict) for r in got] == [("p", "q", "block")]
