"""URL rules against DuckDB and against a direct reading of the rules."""

import duckdb
import pytest
from tripgauge.llm import queries, urls


def test_op3_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = {tuple(r) for r in con.sql(queries.OP3_SQL).fetchall()}
    out = queries.op3_url_filters(spark, sf)
    got = {tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == want and {r[4] for r in got} == {"allow", "block"}


@pytest.mark.parametrize("max_blocks", [1, 1 << 20])
def test_edge_urls_and_bloom_overload(spark, max_blocks):
    rules = [(f"h{i}.test", f"/{i % 7}/" * (i % 3), "block" if i % 2 else "allow") for i in range(500)] + [("net", "/", "block"), ("net", "/", "block")]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    texts = [None, "", "nohost", "http://", "HTTP://A.NET", "http://A.NET/", "x://b.net?q=/", "x://b.net/#f", "x://net/a?b", "x://anet/a", "x://a://b.net/",
             "x://y.h4.test/4//4/z", "x://h3.test", "x://h1.test/1/2", "x://h1.test/2", "x://.net/", "x://É.net/é"] * 2
    pages = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "page_id long, url string, rule string")
    out = {r.page_id: r for r in urls.judge_urls(pages, frame, max_blocks=max_blocks).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        rest = text.partition("://")[2] if text and "://" in text else ""
        host = rest
        for mark in "/?#":
            host = host.split(mark)[0]
        path = rest[len(host):]
        for mark in "?#":
            path = path.split(mark)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in set(rules) if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == (host, path, best[1], best[2]), text
    assert urls.judge_urls(pages.limit(0), frame).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, frame.limit(0)).collect()} == {"allow"}


def test_any_number_of_path_lengths_labels_and_copies(spark, monkeypatch):
    monkeypatch.setattr(urls, "HOT_ROWS", 20)
    path = "/" + "p" * 5000
    rules = [("a.test", path[:n], "block" if n % 2 else "allow") for n in range(1, 5001)] + [("test", "/p", "allow"), (".".join(["l"] * 300) + ".deep", "/", "block")]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    texts = [f"http://x.a.test{path}", f"http://a.test{path[:4200]}?q", f"http://a.test{path}pp", "http://b.test/p", "http://a.test", "http://" + ".".join(["k"] * 10_000) + ".test/pq",
             "http://" + ".".join(["l"] * 10_000) + ".deep/", "http://" + ".".join(["l"] * 200) + ".deep/"] + [None, "http://hot.a.test/ppp"] * 50
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    out = {r.page_id: (len(r.rule or ""), r.verdict) for r in urls.judge_urls(pages, frame).collect()}
    deep = 2 * 300 + 5
    assert [out[i] for i in range(8)] == [(5006, "allow"), (4206, "allow"), (5006, "allow"), (6, "allow"), (0, "allow"), (6, "allow"), (deep, "block"), (0, "allow")]
    assert len(out) == len(texts) and all(out[i] == ((0, "allow") if texts[i] is None else (10, "allow")) for i in range(8, len(texts)))
