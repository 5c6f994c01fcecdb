from practica.llm import url_filter as urls

URLS = [None, "", "no scheme", "http://", "http:///p", "HTTP://A.Example.ORG/es/x", "http://example.org/en/1",
        "http://example.org/en/2", "http://x.com/fr/", "http://x.com/de/?q", "http://bad.net/a/?utm_source=x#f",
        "https://www.bad.net:443/a", "http://bad.net/b", "http://com/de/a", "http://xcom/de/a", "http://org",
        "ftp://bad.net/a?utm_a=1&k=2", "http://É.net/ü", "http://bad.net/" + "z" * 50_000]


def pages(spark, extra=()):
    data = [(i, u, "<html>", "x") for i, u in enumerate([*URLS, *extra])]
    return spark.createDataFrame(data + data[5:8] + [(None, None, None, None)],
                                 "page_id long, url string, html string, rule string")


def test_rules_and_list(spark):
    listed = spark.createDataFrame([("http://bad.net/a",), (None,), ("nothing",), ("http://bad.net/a",)], "url string")
    got = urls.filter_urls(pages(spark), listed)
    assert got.count() == len(URLS) + 4
    by = {r.page_id: r for r in got.collect() if r.page_id is not None}
    assert (by[5].host, by[5].path, by[5].rule, by[5].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [by[i].rule for i in (6, 7, 8, 9, 13, 14, 15)] == [
        "example.org/en/1", "org/", "com/fr/", "com/de/", "com/de/", None, None]
    assert [by[i].verdict for i in (10, 11, 12, 16)] == ["block", "block", "allow", "allow"]
    assert all((by[i].host, by[i].path, by[i].verdict) == ("", "", "allow") for i in (0, 1, 2, 3))
    assert (by[4].host, by[4].path) == ("", "/p")


def test_the_filter_lets_no_listed_url_by_and_the_join_removes_the_rest(spark, monkeypatch):
    every = pages(spark, [f"http://h{i}.net/{i}" for i in range(2000)])
    listed = every.filter("page_id % 3 = 0").select("url")
    want = {r.page_id for r in every.collect() if r.page_id is not None and r.page_id >= len(URLS)
            and r.page_id % 3 == 0}
    for bits, limit in ((16, 1 << 20), (1, 0)):        # a good filter; a full one, joined by shuffle
        monkeypatch.setattr(urls, "BITS_PER_URL", bits)
        monkeypatch.setattr(urls, "BROADCAST_FILTER_BYTES", limit)
        got = urls.filter_urls(every, listed)
        assert {r.page_id for r in got.filter("listed").collect() if r.page_id >= len(URLS)} == want


def test_empty(spark):
    none = pages(spark).filter("false")
    assert urls.filter_urls(none, none.select("url")).count() == 0
    assert urls.filter_urls(pages(spark), none.select("url")).filter("listed").count() == 0


def test_without_the_exact_join_other_urls_would_be_blocked(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_URL", 4)
    every = pages(spark, [f"https://www.h{i}.net:443/{i}/?utm_source=x" for i in range(3000)])
    listed = spark.createDataFrame([(f"http://h{i}.net/{i}",) for i in range(0, 3000, 3)], "url string")
    known = listed.select(urls.canonical_of(listed["url"]).alias("canonical"))
    blocks = -(-1000 * 4 // 512)
    possible = {r.page_id for r in urls.possible_hits(every, urls.bloom_filter(known, "canonical", blocks), blocks)
                .filter("possible").collect()}
    found = {r.page_id for r in urls.filter_urls(every, listed).filter("listed").collect()}
    assert found == {len(URLS) + i for i in range(0, 3000, 3)}
    assert found < possible


def test_pages_are_read_once(spark, tmp_path):
    pages(spark).write.parquet(f"{tmp_path}/pages")
    stored, scanned = spark.read.parquet(f"{tmp_path}/pages"), []
    listed = spark.createDataFrame([("http://bad.net/a",)], "url string")
    made = urls.materialize
    urls.materialize = lambda df, name: (scanned.append(df._jdf.queryExecution().executedPlan().toString().count("/pages]")),
                                         made(df, name))[1]
    try:
        out = urls.filter_urls(stored, listed)
    finally:
        urls.materialize = made
    scanned.append(out._jdf.queryExecution().executedPlan().toString().count("/pages]"))
    assert sum(scanned) == 1
