"""Sitemaps in loops, too deep, sent on and broken, and when requests may start, against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from pagequarry.operators.ranking import schedule
from pagequarry.sources.sitemaps import walk


def test_walk(spark):
    index = lambda *locs: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs) + "</sitemapindex>"
    url = lambda *locs: "\n<?xml version='1.0'?><x:urlset>" + "".join(f"<x:url><x:lastmod>d</x:lastmod><x:loc>\n {x}\n</x:loc></x:url>" for x in locs) + "</x:urlset>"
    rows = [("a/", None, 200, index("b", "c", "a", "gone")), ("b", "b2", 200, index("a/", "d1")), ("b2", None, 200, url("never")), ("c", None, 200, url("b2", "http://x/n.XML.gz?q", "http://x/?a=1&amp;b=2", "p"))]
    rows += [("http://x/n.XML.gz?q", None, 200, "http://one\n\n http://two \r\n"), ("gone", None, 410, None)]
    rows += [(f"d{k}", None, 200, index(f"d{k + 1}")) for k in range(1, 9)] + [("alone", None, 200, url("no"))]
    visits, urls = walk(spark.createDataFrame(rows, "url string, final_url string, status int, body string"), spark.createDataFrame([("a",), ("a/",), ("html",), (None,), ("",)], "url string"))
    assert {r.sitemap: (r.depth, r.outcome) for r in visits.collect()} == {
        "a": (0, "index"), "html": (0, "not fetched"), "b": (1, "index"), "c": (1, "urlset"), "gone": (1, "HTTP 410"), "d1": (2, "index"), "http://x/n.XML.gz?q": (2, "txt"), "d2": (3, "index"), "d3": (4, "index"), "d4": (5, "index"), "d5": (6, "too deep"),
    }
    assert {(r.loc, r.lastmod, r.sitemap, r.depth) for r in urls.collect()} == {("b2", "d", "c", 1), ("http://x/?a=1&b=2", "d", "c", 1), ("p", "d", "c", 1), ("http://one", "", "http://x/n.XML.gz?q", 2), ("http://two", "", "http://x/n.XML.gz?q", 2)}
    visits, urls = walk(spark.createDataFrame([], "url string, final_url string, status int, body string"), spark.createDataFrame([], "url string"))
    assert visits.count() == urls.count() == 0


def test_schedule(spark):
    rng = np.random.default_rng(1)
    rows = [("hot" if k % 5 else f"h{k % 35}", int(x), k, bool(rng.random() < 0.1) if k % 50 else None) for k, x in enumerate(np.sort(rng.integers(0, 900_000, 900)))]
    asked = spark.createDataFrame(rows, "host string, at long, id long, blocked boolean").repartition(5)
    got = {r.id: r.starts for r in schedule(asked, "host", ["at", "id"], F.col("at"), F.col("blocked")).collect()}
    free, delay = {}, {}
    for host, at, ident, blocked in rows:
        start = max(at, free.get(host, 0))
        free[host] = start + delay.get(host, 400)
        if blocked:
            delay[host] = min(8000, delay.get(host, 400) * 2)
        assert got[ident] == start
    assert max(delay.values()) == 8000 and any(got[i] > at for _, at, i, _ in rows)
