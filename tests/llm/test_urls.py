"""URL rules against a plain loop over all rules."""

import re

import pytest

from tidemark.llm import urls
from tidemark.llm.queries import QUERIES, SQL, URL_RULES

ODD = [None, "", "example.com/en/", "https://EXAMPLE.com/en/x", "https://www.example.com/en/", "https://a.www.example.com/en/?q", "http://com", "http://com/", "ftp://x.net/es/1#f",
       "http://x.net/es", "http://.net/fr/", "http://example.com:80/en/", "http://u@example.com/en/", "a://b://example.com/en/", "http://éx.com/é/ü", "http://x.com?/en/", "http:///en/",
       "http://x.com\n/en/", "http://notexample.com/en/", "http://x..com/", "://net/fr/"]


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("max_bytes", [urls.MAX_BYTES, 0])
@pytest.mark.parametrize("rules", [URL_RULES, [("example.com", "", "block"), ("x.net", "/es", "allow"), ("net", "/es/1", "block"), ("éx.com", "/é/", "block")], []])
def test_odd_urls(spark, rules, max_bytes):
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(ODD * 2)], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, urls.RULE_COLUMNS)
    got = sorted(tuple(r) for r in urls.judge(pages, table, max_bytes=max_bytes).collect())
    assert got == sorted((k, *brute(u, rules)) for k, u in enumerate(ODD * 2))
    assert urls.judge(pages.limit(0), table).count() == 0


@pytest.mark.parametrize("max_bytes", [urls.MAX_BYTES, 0])
def test_rules_that_read_alike_stay_apart(spark, max_bytes):
    rules = [("example.com", "", "allow"), ("example.co", "m", "block"), ("1:a", "b", "block"), ("1:ab", "", "allow")]
    texts = ["http://example.com/x", "http://example.co/m", "http://example.comm", "http://1:ab/", "http://1:a/b", "http://b.example.com"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    got = sorted(tuple(r) for r in urls.judge(pages, spark.createDataFrame(rules, urls.RULE_COLUMNS), max_bytes=max_bytes).collect())
    assert got == [(k, *brute(u, rules)) for k, u in enumerate(texts)] and got[0][4] == "allow"


def test_many_ranges(spark, monkeypatch):
    """A list cut into many ranges gives what the shipped array gives; a hot host and repeated urls included."""
    monkeypatch.setattr(urls, "RANGE_BYTES", 64)
    rules = [(f"s{k}.com", "/a/" * (k % 3), "block" if k % 2 else "allow") for k in range(60)] + [("com", "/a", "block")]
    texts = [f"http://x.s{k % 80}.com/{'a/' * (k % 4)}{k}" for k in range(400)] + ["http://hot.com/a/b"] * 300
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    got = sorted(tuple(r) for r in urls.judge(pages, spark.createDataFrame(rules, urls.RULE_COLUMNS), max_bytes=0).collect())
    assert got == [(k, *brute(u, rules)) for k, u in enumerate(texts)]


def test_equal_digests_are_told_apart(tmp_path):
    import numpy as np
    import pyarrow as pa

    class Rows:
        def orderBy(self, *_):
            return self

        def toLocalIterator(self):
            class R:
                pass
            for key, verdict in (("a/", "block"), ("b/", "allow")):
                r = R()
                r.digest, r.key, r.verdict, r.host_length = 7, key, verdict, 1
                yield r
    urls.write_array(Rows(), str(tmp_path))
    array = urls.DigestArray(str(tmp_path))
    assert array.find(np.array([7, 7, 7, 8]), pa.array(["b/", "c/", "a/", "a/"])).tolist() == [1, -1, 0, -1]


def test_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.com/"), (None, "http://y.com/")], "page_id long, url string")
    rules = spark.createDataFrame([(None, "/", "block"), ("", "/", "block"), ("y.com", None, "block"), ("y.com", "", "allow")], urls.RULE_COLUMNS)
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in urls.judge(pages, rules).collect()) == [(0, "y.com", "block"), (1, None, "allow")]


def test_pages(spark):
    from oracle import compare, duck
    name, folder = "op4_url_filters", "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), folder, QUERIES[name], SQL[name]) is None
