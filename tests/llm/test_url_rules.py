from pyspark.sql import functions as F

from scenequarry.llm import url_rules as U

RULES = (("net", "/", False), ("example.net", "/en/", True), ("example.com", "/de/", False), ("org", "/fr/", True))


def slow_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
    path = rest[k:]
    j = min([i for i, c in enumerate(path) if c in "?#"] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k]), path[:j]


def slow_rule(host, path):
    fits = [(len(h + p), -i, h + p, ok) for i, (h, p, ok) in enumerate(RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?q#f", "https://example.net", "https://example.net/", "https://xnet/", "https://net/a", "x://y://z.org/fr/1", "https://É.org/fr/", "http://a.org?x=/fr/", "https://www.example.com/de", "https://www.example.com/de/1#top", "ftp://b.example.com/\nde/", "https://a.net:80/en/"]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in U.judge_pages(df, spark.createDataFrame([], "url string, target string"), RULES).collect()}
    for i, u in rows:
        host, path = slow_split(u)
        rule, ok = slow_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, "block" if ok is False else "allow"), u


def test_aliases_take_block_decisions(spark):
    pages = [(1, "http://x.com/1", ""), (2, "http://y.com/2", '<LINK href="http://bad.net/9" rel=canonical>'), (3, "http://z.com/3", "<meta content='0; url=http://y.com/2' http-equiv='refresh'>"), (4, "http://w.com/4", None)]
    pages += [(5, "http://v.com/5", '<link rel="canonical" href="//bad.net/7">'), (6, "http://example.net/en/6", '<link rel="canonical" href="http://v.com/5">'), (7, "http://y.com/2#a", ""), (7, "http://y.com/2#a", ""), (8, None, "x"), (None, "http://y.com/2?utm_source=f", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = U.judge_pages(df, U.alias_links(df), RULES).collect()
    assert len(got) == len(pages)
    verdicts = {r.page_id: r.verdict for r in got}
    assert verdicts == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow", None: "block"}
    empty = U.judge_pages(df.limit(0), U.alias_links(df.limit(0)), RULES)
    assert empty.collect() == [] and "verdict" in empty.columns


LINKED = [
    ("http://a.com/x/y/page.html?k=1", '<link rel="canonical" href="../b">', "http://a.com/x/b"),
    ("http://a.com/x/page", '<link rel="canonical" href="story.html">', "http://a.com/x/story.html"),
    ("http://a.com/x/page?q=2#f", '<meta http-equiv="refresh" content="0; url=?p=1">', "http://a.com/x/page?p=1"),
    ("http://a.com", '<link rel=canonical href=./z/../../w/.>', "http://a.com/w/"),
    ("http://a.com/1", '<link rel="canonical" href="http://b.com/p?x=1&amp;y=2">', "http://b.com/p?x=1&y=2"),
    ("http://a.com/2", '<link rel="canonical" href="&#x2F;p?u=http://c.com/">', "http://a.com/p?u=http://c.com/"),
    ("http://a.com/3", '<!-- <link rel="canonical" href="http://bad.net/"> --><link rel="canonical" href="/seen">', "http://a.com/seen"),
    ("http://a.com/4", '<!-- <link rel="canonical" href="http://bad.net/">', None),
    ("http://a.com/5", """<script>var t = '<link rel="canonical" href="http://bad.net/">'</script>""", None),
    ("http://a.com/6", '<link rel="canonical" href="mailto:x@bad.net">', None),
    ("no address", '<link rel="canonical" href="/x">', None),
    ("https://a.com/7", '<link rel="canonical" href="//bad.net/../7">', "https://bad.net/7"),
]


def test_targets_of_links(spark):
    df = spark.createDataFrame([(u, h) for u, h, _ in LINKED], "url string, html string")
    got = {r.url: r.target for r in U.alias_links(df).filter("kind <> 'self'").collect()}
    assert got == {u: t for u, _, t in LINKED if t}


def test_canonical(spark):
    pairs = {"http://a.b/x/../../c/./d/..": "http://a.b/c/", "http://a.b/x..y/...": "http://a.b/x..y/...", "HTTP://A.b:80/x?utm_a=1&q=2#f": "http://a.b/x?q=2", "https://a.b/x?q=1&utm_b=2": "https://a.b/x?q=1", "https://a.b?utm_c": "https://a.b", "plain": "plain", "https://a:443/": "https://a/"}
    got = spark.createDataFrame([(u,) for u in pairs], "url string").select("url", U.canonical(F.col("url")).alias("c")).collect()
    assert {r.url: r.c for r in got} == pairs


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    from scenequarry.llm import queries as Q

    pages = [(i, u, h) for i, (u, h) in enumerate([("http://x.com/1", ""), ("http://y.com/2", '<LINK href="http://bad.net/9" rel=canonical>'), ("http://z.com/3", "<meta content='0; url=http://y.com/2' http-equiv='refresh'>"), ("http://v.com/5", '<link rel="canonical" href="//bad.net/7">'), ("http://example.net/en/6", '<link rel="canonical" href="http://v.com/5">'), (None, None)])]
    pages += [(200 + i, u, h) for i, (u, h, _) in enumerate(LINKED)] + [(300, "http://bad.net/c/../7", None), (301, "http://q.com/a/b", '<link rel="canonical" href="../../bad">'), (302, "http://q.com/bad", '<link rel="canonical" href="http://bad.net/?a=1&amp;b=2">')]
    pages += [(100 + i, u, "<p>x</p>") for i, u in enumerate(URLS)] + [(1, "http://y.com/2#a", ""), (2, "https://y.com:443/2?utm_a=1&q=2", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(str, (tuple(r) for r in Q.QUERIES["op3_url_filter"](spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(map(str, con.execute(Q.ORACLES["op3_url_filter"]).fetchall()))
