"""Sitemaps that name sitemaps, walked a level at a time over documents that were fetched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

_ELEMENT = r"(?is)<(?:[\w-]+:)?({})\b[^>]*>(.*?)</(?:[\w-]+:)?\1\s*>"
_LOC, _LASTMOD = (rf"(?is)<(?:[\w-]+:)?{name}\b[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</" for name in ("loc", "lastmod"))
#: The character references that XML knows without a declaration.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def sitemap_kind(body: Column) -> Column:
    """index, urlset, txt, html or bad, by what the document begins with."""
    head = F.lower(F.left(F.ltrim(body, F.lit(" \t\r\n")), F.lit(2048)))
    root = F.regexp_extract(F.regexp_replace(head, r"(?s)^(\s*(<!--.*?-->|<[?!][^>]*>)\s*)+", ""), r"^\s*<(?:[\w-]+:)?([\w-]+)", 1)
    first = F.slice(F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x, F.lit(" \t\r"))), lambda x: x != ""), 1, 20)
    lines = (F.size(first) > 0) & F.forall(first, lambda x: x.rlike("^https?://"))
    unsafe = F.contains(head, F.lit("<!entity")) | (F.contains(head, F.lit("<!doctype")) & ~F.contains(head, F.lit("<!doctype html")))
    return (
        F.when(~F.startswith(head, F.lit("<")), F.when(lines, "txt").otherwise("bad"))
        .when(unsafe, "bad").when(root == "sitemapindex", "index").when(root == "urlset", "urlset")
        .when(F.contains(head, F.lit("<html")) | F.contains(head, F.lit("<!doctype html")), "html").otherwise("bad")
    )


def locations(body: Column, element: str) -> Column:
    """(loc, lastmod) of each element of this name that has a location."""

    def text(inner: Column, pattern: str) -> Column:
        return reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), REFERENCES, F.regexp_extract(inner, pattern, 1))

    inner = F.regexp_extract_all(F.regexp_replace(body, "(?s)<!--.*?-->", ""), F.lit(_ELEMENT.format(element)), F.lit(2))
    return F.filter(F.transform(inner, lambda e: F.struct(text(e, _LOC).alias("loc"), text(e, _LASTMOD).alias("lastmod"))), lambda e: e["loc"] != "")


def lines_of(body: Column) -> Column:
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x, F.lit(" \t\r"))), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(x.alias("loc"), F.lit("").alias("lastmod")))


def _key(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def walk(fetched: DataFrame, declared: DataFrame, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """What the declared sitemaps lead to: visits (sitemap, depth, outcome), and urls (loc, lastmod, sitemap, depth).

    fetched: (url, final_url, status, body), what each request was answered; declared: (url). An index leads to the
    sitemaps that it names, a list of URLs to those of its entries whose path ends like a sitemap's; all else in it is
    a page. Each is visited once, by the fewest steps, whether it was asked for or came to by being sent on; one
    `most` + 1 steps away is listed as "too deep" and not read. A page is told of by the sitemap with the fewest
    steps, the first in order on a tie. Each level joins the newest sitemaps alone with what was fetched and
    parses just those; levels are written to the shared folder.
    """
    spark = fetched.sparkSession
    asked = fetched.select(_key(F.col("url")).alias("key"), _key(F.coalesce("final_url", "url")).alias("final"), "status", "body")
    newest = written(declared.where("url != ''").groupBy(_key(F.col("url")).alias("key")).agg(F.min("url").alias("url")))
    seen, visits, urls = newest.select("key"), [], []
    for depth in range(most + 2):
        if newest.isEmpty():
            break
        if depth > most:
            visits.append(newest.select(F.col("url").alias("sitemap"), F.lit(depth).alias("depth"), F.lit("too deep").alias("outcome")))
            break
        met = newest.join(asked, "key", "left").withColumn("kind", F.when(F.col("status") == 200, sitemap_kind(F.col("body"))))
        entries = F.when(F.col("kind") == "index", locations(F.col("body"), "sitemap")).when(F.col("kind") == "urlset", locations(F.col("body"), "url")).when(F.col("kind") == "txt", lines_of(F.col("body")))
        outcome = F.coalesce("kind", F.concat(F.lit("HTTP "), "status"), F.lit("not fetched"))
        read = written(met.select("key", "url", "final", "kind", outcome.alias("outcome"), entries.alias("entries")))
        visits.append(read.select(F.col("url").alias("sitemap"), F.lit(depth).alias("depth"), "outcome"))
        seen = seen.union(read.select(F.col("final").alias("key")).where("key is not null"))
        each = read.select("url", "kind", F.inline("entries"))
        path = F.lower(F.regexp_extract("loc", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
        deeper = (F.col("kind") == "index") | ((F.col("kind") == "urlset") & path.rlike(r"\.xml(\.gz)?$"))
        urls.append(each.where(~deeper).select("loc", "lastmod", F.col("url").alias("sitemap"), F.lit(depth).alias("depth")))
        newest = written(each.where(deeper).groupBy(_key(F.col("loc")).alias("key")).agg(F.min("loc").alias("url")).join(seen, "key", "left_anti"))
        seen = written(seen.union(newest.select("key")).distinct())
    empty = spark.createDataFrame([], "sitemap string, depth int, outcome string"), spark.createDataFrame([], "loc string, lastmod string, sitemap string, depth int")
    found = reduce(DataFrame.union, urls, empty[1])
    first = found.groupBy("loc").agg(F.min(F.struct("depth", "sitemap", "lastmod")).alias("b")).select("loc", "b.lastmod", "b.sitemap", "b.depth")
    return reduce(DataFrame.union, visits, empty[0]), first
