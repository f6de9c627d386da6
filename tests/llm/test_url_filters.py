import pytest
from pyspark.sql import functions as F

from flowlake.llm import url_filters
from flowlake.llm.queries import RULES

FORMS = [
    ("HTTP://User:pw@WWW.Site.Example:8080//a///b/index.html?utm_source=x&b=2&a=1&&ref=y#top", "site.example/a/b?a=1&b=2"),
    ("https://site.example./a/b/", "site.example/a/b"),
    ("https://site.example", "site.example"),
    ("https://site.example/?", "site.example"),
    ("https://site.example/%7Eann/A%2Eb?q=https://x.y/z", "site.example/~ann/A.b?q=https://x.y/z"),
    ("https://site.example#a?b", "site.example"),
    ("ftp://site.example/x\ny?k", "site.example/x\ny?k"),
    ("https:///only/path", None), ("no scheme", None), ("", None), (None, None),
]


def test_canonical_forms(spark):
    frame = spark.createDataFrame([(u,) for u, _ in FORMS], "url string")
    got = [r["c"] for r in frame.select(url_filters.canonical(F.col("url")).alias("c")).collect()]
    assert got == [c for _, c in FORMS]


CASES = [
    ("https://a.net/x", "a.net", "/x", "net/", "block"),
    ("https://net/", "net", "/", "net/", "block"),
    ("https://anet/", "anet", "/", None, "allow"),
    ("https://a.net", "a.net", "", None, "allow"),
    ("https://Www.EXAMPLE.net/en/1?x#y", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("x://m.example.com/de/", "m.example.com", "/de/", "example.com/de/", "block"),
    ("https://a.org/fr/b://c", "a.org", "/fr/b://c", "org/fr/", "allow"),
    ("https://a.org?/fr/", "a.org", "", None, "allow"),
    ("a.net/x", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("https://bad.example.org/spam/1", "bad.example.org", "/spam/1", None, "block"),
    ("http://www.bad.example.org/spam/1/#z", "www.bad.example.org", "/spam/1/", None, "block"),
    ("https://bad.example.org/spam/2", "bad.example.org", "/spam/2", None, "allow"),
    ("https://bad.example.org/fr/1", "bad.example.org", "/fr/1", "org/fr/", "allow"),
]


@pytest.mark.parametrize("blocks", [1, 1 << 20])
def test_rules_then_list(spark, blocks):
    """With one block the filter is as good as full; the exact join still gives the same."""
    pages = spark.createDataFrame([(i, c[0], "h", "v") for i, c in enumerate(CASES)], "page_id int, url string, host string, verdict string")
    others = [(f"https://x{i}.example/{i}",) for i in range(300 if blocks == 1 else 3)]
    listed = spark.createDataFrame([("https://bad.example.org/spam/1/?ref=z",), ("https://bad.example.org/fr/1",), (None,), ("x",), *others], "url string")
    got = {r["page_id"]: r for r in url_filters.judge(pages, listed.union(listed), RULES, max_blocks=blocks).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(CASES))] == [c[1:] for c in CASES]
    assert [i for i in got if got[i]["listed"]] == [i for i, c in enumerate(CASES) if c[0] and ("spam/1" in c[0] or c[0].endswith("org/fr/1"))]
    assert sum(r["possible"] for r in got.values()) >= 3


def test_filter_passes_few_others(spark):
    listed = spark.range(20_000).select(F.format_string("https://l%d.example/", "id").alias("url"))
    pages = spark.range(20_000).select("id", F.format_string("https://p%d.example/", F.col("id") - 100).alias("url"))
    hits = spark.range(50).select("id", F.format_string("http://www.l%d.example", F.col("id")).alias("url"))
    got = url_filters.judge(pages.union(hits), listed, []).agg(F.sum(F.col("possible").cast("int")).alias("p"), F.sum(F.col("listed").cast("int")).alias("l")).first()
    assert got["l"] == 50 and 50 <= got["p"] < 50 + 200


def test_repeated_and_long_urls(spark):
    long = "https://bad.example/" + "a/" * 100_000 + "?" + "k=v&" * 50_000
    pages = spark.createDataFrame([("https://bad.example/x",)] * 500 + [(long,)] * 2 + [("https://" + "h." * 50_000 + "net/p",)], "url string")
    got = url_filters.judge(pages, spark.createDataFrame([("http://bad.example/x",), (long + "#f",)], "url string"), RULES)
    assert sorted(map(tuple, got.groupBy("rule", "verdict", "listed").count().collect()), key=str) == [("net/", "block", False, 1), (None, "block", True, 502)]


def test_empty_tables(spark):
    pages, none = spark.createDataFrame([("https://a.b/c",)], "url string"), spark.createDataFrame([], "url string")
    assert [r["verdict"] for r in url_filters.judge(pages, none, RULES).collect()] == ["allow"]
    assert url_filters.judge(none, pages, RULES).count() == 0


def test_ties_block_first(spark):
    rules = [url_filters.Rule("allow", "net", "/en/"), url_filters.Rule("block", "ab.net", "/"), url_filters.Rule("block", "net", "/")]
    pages = spark.createDataFrame([("https://ab.net/en/1",)], "url string")
    assert [(r["rule"], r["verdict"]) for r in url_filters.judge(pages, pages.limit(0), rules).collect()] == [("ab.net/", "block")]
