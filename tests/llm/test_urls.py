import re

import duckdb

from sluiceway.llm import queries, url_templates

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), f"{h}{p}", said) for said, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


URLS = [
    "http://WWW.Example.com/en/1?x=/", "https://example.com/en/", "https://example.com/en", "http://a.net/fr/1#top", "http://net/es/x", "http://com/", "http://a.com", "http://ÄB.com/é",
    "noscheme.com/en/", "", None, "http://", "://x.net/es/1", "http://a.org/b/c/d/e/f/g", "http://a.org?x=http://b.net/fr/", "http://xexample.com/en/2", "http://a.net/fr/1#top",
]


def test_rules_against_plain_code(spark):
    rows = [(k, u, "clash") for k, u in enumerate(URLS)] + [(None, "http://a.net/es/9", "clash")]
    got = url_templates.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path, rule = plain(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None)
            assert r.verdict == (rule[1] if rule else "allow")


def test_impure_templates_are_rejected(spark, monkeypatch):
    """Variable segments become a wildcard, and unlabelled pages follow their template's labels."""
    monkeypatch.setattr(url_templates, "RULES", (("block", "x.org/spam/bad"), ("allow", "x.org/news/good")))
    urls = [f"http://x.org/spam/bad{'abcdefghijklmnopqrst'[k]}" for k in range(20)] + ["http://x.org/spam/zeta", "http://x.org/spam/yota"]
    urls += [f"http://x.org/news/good{'abcdefghijklmnopqrst'[k]}" for k in range(20)] + ["http://x.org/news/other", "http://y.org/spam/zeta"]
    got = {r.url: r for r in url_templates.judge_urls(spark.createDataFrame([(u, u) for u in urls], "page_id string, url string")).withColumnRenamed("page_id", "url").collect()}
    assert got["http://x.org/spam/zeta"].verdict == got["http://x.org/spam/yota"].verdict == "block"
    assert got["http://x.org/spam/zeta"].template == "/spam/*" and got["http://x.org/news/other"].verdict == got["http://y.org/spam/zeta"].verdict == "allow"


def test_query_against_plain_code(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.QUERIES["op5_url_filters"](spark, sf).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None) and r.verdict in ("allow", "block") and (not rule or r.verdict == rule[1])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    df = queries.QUERIES["op5_url_filters"](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES['op5_url_filters']})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def test_empty(spark):
    assert url_templates.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
