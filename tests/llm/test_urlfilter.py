import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import urlfilter

from .conftest import SF


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: f[:2], default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, urlfilter.rule_table(spark, rules)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


URLS = ["http://example.com/en/x", "https://WWW.Example.com/en/", "http://www.example.com/en", "http://a.www.example.com/en/1?x#y", "http://example.com",
        "http://notexample.com/en/", "ftp://x.net/fr/", "http://net/es/?a", "http://net.es/es/", "no scheme", None, "", "://", "http://com/", "http:///path",
        "http://u:p@h.com:80/en/", "x://y.com/z://w.net/es/", "http://é.com/é", "http://.com/", "http://com./", "http://example.com/en/\n/a", "http://a..com/"]


def test_listed_urls(spark):
    check(spark, URLS + URLS, list(urlfilter.RULES))


labels = st.lists(st.sampled_from(["a", "b", "ab", "com", "net", ""]), min_size=1, max_size=4).map(".".join)
paths = st.lists(st.sampled_from(["", "a", "ab", "b", "é", "\U0010ffff"]), max_size=3).map("/".join).map(lambda p: "/" + p)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), labels, paths), min_size=1, max_size=30, unique_by=lambda r: r[1:]),
       st.lists(st.tuples(labels, paths).map(lambda x: "http://" + "".join(x)), min_size=1, max_size=60))
def test_nested_rules(spark, rules, urls):
    check(spark, urls, rules)


def test_sql_agrees_on_the_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    got = urlfilter.judge(pages, urlfilter.rule_table(spark)).drop("url")
    names = sorted(got.columns)
    want = con.execute(f"select {', '.join(names)} from ({urlfilter.judge_sql()})").fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(want, key=key)


def test_edges(spark):
    clash = spark.createDataFrame([(1, "http://x.com/", "old", "old", "old"), (1, "http://x.com/", "old", "old", "old"), (None, None, None, None, None)],
                                  "page_id long, url string, host string, verdict string, key string")
    got = urlfilter.judge(clash, urlfilter.rule_table(spark))
    assert got.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"] and got.count() == 3
    assert [r.host for r in got.where("page_id = 1").collect()] == ["x.com"] * 2
    assert urlfilter.judge(clash.limit(0), urlfilter.rule_table(spark)).count() == 0
    none = urlfilter.judge(clash, urlfilter.rule_table(spark, [("block", None, "/"), ("block", "x.com", None)]))
    assert {r.verdict for r in none.collect()} == {"allow"}
