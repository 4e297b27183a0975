from trackloom.llm import urls

URLS = ["https://www.A.example.com/en/71?x=1#y", "http://a.example.com/en/8", "http://notexample.com/en/7", "https://b.example.net/de/80", "//no/scheme", None, "",
        "ftp://x.org", "http://x.org/es/", "http://h/a?utm_source=feed", "https://h/a/", "https://h/a.html#t", "https://h/a?page=2&ref=x", "http://h?q://r/z", "http://q.com", "http://Q.com/"]


def test_host_path_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, urls.repeated_addresses(pages)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("#")[0].split("?")[0]
        fit = [(r, v) for r, v in urls.RULES for d, _, p in [r.partition("/")] if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
        rule, verdict = max(fit, key=lambda x: len(x[0]), default=(None, None))
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict:
            assert r.verdict == verdict
    # three forms of one address are on the list; the one with another query is not
    assert [got[i].verdict for i in (9, 10, 11, 12)] == ["block", "block", "block", "allow"]
    assert [got[i].verdict for i in (4, 5, 6)] == ["allow"] * 3


def test_bloom_passes_all_listed_and_few_others(spark):
    listed = spark.range(2000).selectExpr("concat('h/', id) as canonical")
    asked = spark.range(1000, 9000).selectExpr("concat('h/', id) as canonical")
    rows = urls.mark_listed(asked, listed).collect()
    assert len(rows) == 8000
    assert {r.canonical for r in rows if r.listed} == {f"h/{i}" for i in range(1000, 2000)}
    # even a filter that is far too small loses nothing
    assert urls.mark_listed(asked, listed, blocks=1).where("listed").count() == 1000


def test_odd_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, urls.repeated_addresses(none)).count() == 0
    pages = spark.createDataFrame([(1, "http://h/a", "x", True)] * 2 + [(None, None, None, None)], "page_id long, url string, host string, listed boolean")
    rows = urls.judge(pages, urls.repeated_addresses(pages)).collect()
    assert sorted(r.verdict for r in rows) == ["allow", "block", "block"]
