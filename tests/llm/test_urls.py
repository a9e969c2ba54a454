from tallybook.llm import urls
from tallybook.llm.queries import URL_RULES

CASES = [
    (1, "https://a.example.net/en/1", "example.net/en/", "allow"),
    (2, "https://EXAMPLE.NET/de/1", "net/", "block"),
    (3, "http://badexample.com/de/", None, "allow"),
    (4, "http://x.example.com/de/9?q=1", "example.com/de/", "block"),
    (5, "http://some.org/fr/#x", "org/fr/", "allow"),
    (6, "http://a.net", None, "allow"),  # no path, so no rule's path
    (7, None, None, "allow"),
    (8, "no scheme", None, "allow"),
    (9, "ftp://Listed.com/Page.html?x#y", None, "block"),
    (10, "http://www.listed.com/Page/", None, "block"),
    (11, "http://listed.com/page", None, "allow"),  # paths keep their case
    (12, "", None, "allow"),
    (1, "https://a.example.net/en/1", "example.net/en/", "allow"),
]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u, *_ in CASES], "page_id long, url string, host string")
    listed = spark.createDataFrame([("http://m.listed.com/Page",), (None,), ("http://m.listed.com/Page",)], "url string")
    got = urls.judge_urls(pages, URL_RULES, listed).collect()
    assert sorted((r["page_id"], r["rule"] or "", r["verdict"]) for r in got) == sorted(
        (i, rule or "", verdict) for i, _, rule, verdict in CASES
    )
    parts = {r["page_id"]: (r["host"], r["path"]) for r in got}
    assert parts[4] == ("x.example.com", "/de/9")
    assert parts[5] == ("some.org", "/fr/")
    assert parts[7] == parts[8] == ("", "")


def test_filter_has_no_false_negatives_and_the_join_no_false_positives(spark, monkeypatch):
    monkeypatch.setattr(urls, "BLOCKS", 2)  # so full that nearly all keys pass the filter
    rows = spark.range(2000).selectExpr("id", "concat('k', id) as key", "id as listed_before")
    listed = spark.range(0, 4000, 3).selectExpr("concat('k', id) as name")
    got = urls.listed_among(rows, "key", listed, "name").collect()
    assert len(got) == 2000
    assert all(r["listed"] == (r["id"] % 3 == 0) for r in got)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, URL_RULES, none).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge_urls(one, URL_RULES, none).collect()] == ["allow"]
